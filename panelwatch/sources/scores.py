"""The keyed score table and the run log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.operators.series import _join_same, without_same
from panelwatch.operators.spine import PREVIOUS, score_date
from panelwatch.session import settle
from panelwatch.sources import commits
from panelwatch.sources.landing import MONTH, in_months, month_of, months_in

KEYS = ("series_key",)

# The column names of the stored run log.
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("features_if", T.ArrayType(T.StringType())),
        T.StructField("contamination", T.DoubleType()),
        T.StructField("n_estimators", T.IntegerType()),
        T.StructField("static_threshold", T.DoubleType()),
        T.StructField("rolling_percentile", T.DoubleType()),
        T.StructField("mean_risk_score", T.DoubleType()),
        T.StructField("anomaly_rate_static", T.DoubleType()),
        T.StructField("anomaly_rate_1y", T.DoubleType()),
    ]
)


def narrow(df: DataFrame, schema: T.StructType = S.SCORE_TABLE) -> DataFrame:
    """The stored columns in their stored types; columns the frame lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def merge(existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS, order: str = "date") -> DataFrame:
    """Insert or replace by (keys, order), nulls being equal; either side may lack columns of the other."""
    kept = without_same(existing, new, [*keys, order])
    return kept.unionByName(new, allowMissingColumns=True)


def upsert_scores(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    schema: T.StructType = S.SCORE_TABLE,
    keys: Sequence[str] = KEYS,
    order: str = "date",
) -> None:
    """Merge ``new`` into the table.

    Months in which it replaces stored rows are written anew; elsewhere its rows are added,
    so a daily run writes one day's rows.  All of the batch becomes visible in one step
    (``commits``): a run that stops before it leaves the old table.  ``commits.Conflict`` is
    raised, and nothing stored, if another batch came in between.
    Files written under an older schema read back with nulls in later columns.
    Rerunning the same batch leaves the same table.  Of several rows of one (keys,
    order) in a batch the greatest, column by column, is stored.  Null keys and dates
    are values like others, equal to each other; rows without a date lie in a month of their own.
    """
    new = narrow(new, schema)
    rest = [c for c in new.columns if c not in (*keys, order)]
    one = new.groupBy(*keys, order).agg(F.max(F.struct(*rest)).alias("__row"))
    one = one.select(*[c if c in (*keys, order) else F.col("__row")[c].alias(c) for c in new.columns])
    new = settle(one.withColumn(MONTH, month_of(order)))
    months = months_in(new)
    if not months:
        return
    base = commits.version(spark, path)
    there = commits.read(spark, path, schema, commits.in_folders(base, months))
    replaced = months_in(_join_same(new, there.select(*keys, order, MONTH), [*keys, order], "left_semi"))
    again = in_months(replaced)
    rows = merge(there.filter(again), new.filter(again), keys, order).unionByName(new.filter(~again)) if replaced else new
    commits.write(rows, path, base, replaced)


def drivers_to_text(drivers: Column) -> tuple[Column, Column]:
    """The two JSON texts of older tables: driver names, and their weights."""
    return F.to_json(drivers["feature"]), F.to_json(drivers["weight"])


def drivers_from_text(names: Column, weights: Column) -> Column:
    """Drivers of older tables as an array; null or unreadable text gives no drivers.

    A name without a weight has a null weight.
    """
    n, w = F.from_json(names, "array<string>"), F.from_json(weights, "array<double>")
    pairs = F.transform(n, lambda x, i: F.struct(x.alias("feature"), F.get(w, i).alias("weight")))
    return F.coalesce(pairs, F.array().cast("array<struct<feature: string, weight: double>>"))


def read_scores(
    spark: SparkSession, path: str, schema: T.StructType = S.SCORE_TABLE, number: int | None = None
) -> DataFrame:
    """The table, or an earlier version of it that has not been cleaned away."""
    at = commits.version(spark, path, number)
    return commits.read(spark, path, schema, at).drop(MONTH)


def rows_to_write(
    scored: DataFrame, last_session: str | DataFrame, backfill: bool, keys: Sequence[str] = KEYS
) -> DataFrame:
    """All rows up to the last session, or the one row per key that is due.

    With (keys, previous_session) each key has a last session of its own; without one none of its rows is due.
    """
    if not backfill:
        return scored.join(score_date(scored, last_session, keys), [*keys, "date"], "left_semi")
    if isinstance(last_session, DataFrame):
        last = last_session.select(*keys, F.col(PREVIOUS).alias("__last"))
        return _join_same(scored, last, keys).filter(F.col("date") <= F.col("__last")).drop("__last")
    return scored.filter(F.col("date") <= F.to_date(F.lit(last_session)))


def run_record(
    scored: DataFrame,
    run_id: str,
    features: Sequence[str],
    trees: int = S.FOREST_TREES,
    contamination: float = 0.05,
    static: float = S.STATIC_THRESHOLD,
    q: float = S.ROLLING_PERCENTILE,
) -> DataFrame:
    """One row: the run's settings, mean score and anomaly rates."""
    rate = lambda c: F.avg(F.col(c).cast("double"))
    return scored.agg(
        F.lit(run_id).alias("run_id"),
        F.array(*[F.lit(f) for f in features]).alias("features_if"),
        F.lit(contamination).alias("contamination"),
        F.lit(trees).alias("n_estimators"),
        F.lit(static).alias("static_threshold"),
        F.lit(q).alias("rolling_percentile"),
        F.avg("risk_score").alias("mean_risk_score"),
        rate("anomaly_static").alias("anomaly_rate_static"),
        rate("anomaly_1y").alias("anomaly_rate_1y"),
    )


def log_run(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)
