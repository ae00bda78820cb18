"""Group aggregates: all are partial (map-side) aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.operators.series import _join_same, last_rows
from panelwatch.session import settle

KEYS = ("series_key",)


def staleness(df: DataFrame, as_of: str, keys=KEYS, order: str = "date", limit: int = S.STALE_DAYS) -> DataFrame:
    """Days since the newest row per key, and whether that is more than ``limit``."""
    days = F.datediff(F.to_date(F.lit(as_of)), F.max(order))
    return (
        df.groupBy(*keys)
        .agg(days.alias("gpr_days_stale"))
        .withColumn("gpr_is_stale", F.col("gpr_days_stale") > limit)
    )


def null_rates(
    df: DataFrame, columns: Sequence[str], last: int = 60, keys=KEYS, order: str = "date"
) -> DataFrame:
    """Share of nulls per (key, column) over the newest ``last`` rows, one pass."""
    recent = last_rows(df.select(*keys, order, *[c for c in columns if c != order]), last, keys, order)
    wide = recent.groupBy(*keys).agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns]
    )
    return wide.unpivot(list(keys), list(columns), "column", "null_rate")


def correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Absolute Pearson correlation of every feature pair as rows (a, b, corr).

    Rows with a null feature are left out.  The matrix is summed up in two
    distributed passes and only its cells come back; a constant feature has no
    correlation (null).
    """
    features = list(features)
    vectors = VectorAssembler(inputCols=features, outputCol="v", handleInvalid="skip").transform(
        df.select(*features)
    )
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    cells = [
        (features[i], features[j], None if np.isnan(matrix[i, j]) else float(abs(matrix[i, j])))
        for i, j in combinations(range(len(features)), 2)
    ]
    return df.sparkSession.createDataFrame(cells, "a string, b string, corr double")


_LISTS = ("low", "high", "mean", "cross")


def _moments(features: Sequence[str], by: Sequence[str]):
    """Arrow function: per group and batch the number of rows, extremes, means and centred cross products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            table = pa.Table.from_batches([b])
            x = np.column_stack([table[f].to_numpy().astype(float) for f in features])
            keys = table.select(by)
            place = keys.append_column("__i", pa.array(np.arange(len(x)))).group_by(by).aggregate([("__i", "list")])
            out = {"n": [], "low": [], "high": [], "mean": [], "cross": []}
            for rows in place["__i_list"].to_pylist():
                own = x[rows]
                mean = own.mean(axis=0)
                off = own - mean
                for c, v in zip(out, (len(own), own.min(axis=0), own.max(axis=0), mean, (off.T @ off).ravel())):
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([*[place[c].combine_chunks() for c in by], *map(pa.array, out.values())], names=[*by, *out])

    return run


def _merged_moments(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Extremes and centred cross products of all parts together (Chan, Golub & LeVeque)."""
    n, mean = pdf["n"].to_numpy(float), np.stack(pdf["mean"])
    whole = (n[:, None] * mean).sum(axis=0) / n.sum()
    off = mean - whole
    cross = np.stack(pdf["cross"]).sum(axis=0).reshape(len(whole), -1) + (off * n[:, None]).T @ off
    return np.stack(pdf["low"]).min(axis=0), np.stack(pdf["high"]).max(axis=0), cross


def correlation_lists(df: DataFrame, features: Sequence[str], by: Sequence[str] = KEYS) -> DataFrame:
    """(by, corr) with the absolute Pearson correlations of all feature pairs, in ``combinations`` order.

    One pass: every batch gives one row of sums per group, which merge exactly as one would expect of
    sums, so no group's rows meet in one task.  Rows with a null feature are left out; a
    constant feature has no correlation (null); nulls in ``by`` make a group.
    """
    features, by = list(features), list(by)
    rows = df.select(*by, *features).dropna(subset=features)
    keys = T.StructType([df.schema[c] for c in by])
    sums = [T.StructField("n", T.LongType()), *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in _LISTS]]
    parts = rows.mapInArrow(_moments(features, by), T.StructType(keys.fields + sums))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high, cross = _merged_moments(pdf)
        size = np.sqrt(np.diag(cross))
        with np.errstate(all="ignore"):
            corr = np.abs(cross / np.outer(size, size))
        corr[low == high], corr[:, low == high] = np.nan, np.nan
        pairs = [corr[i, j] for i, j in combinations(range(len(features)), 2)]
        return pd.DataFrame([[*pdf.iloc[0][by], [None if np.isnan(v) else min(float(v), 1.0) for v in pairs]]], columns=[*by, "corr"])

    return parts.groupBy(*by).applyInPandas(merge, T.StructType([*keys.fields, T.StructField("corr", T.ArrayType(T.DoubleType()))]))


def prune_by(df: DataFrame, features: Sequence[str], by: Sequence[str] = KEYS, limit: float = S.CORR_LIMIT) -> DataFrame:
    """(by, kept): per group the features without a strong correlation to any earlier one, dropped or not."""
    features = list(features)
    at = {p: k for k, p in enumerate(combinations(range(len(features)), 2))}
    weak = lambda j: [F.coalesce(F.col("corr")[at[i, j]] <= limit, F.lit(True)) for i in range(j)]
    keep = [F.when(reduce(and_, weak(j), F.lit(True)), F.lit(f)) for j, f in enumerate(features)]
    found = settle(correlation_lists(df, features, by))
    return found.select(*by, F.array_compact(F.array(*keep)).alias("kept"))


def prune_features(df: DataFrame, features: Sequence[str], limit: float = S.CORR_LIMIT) -> list[str]:
    """Features without a strong correlation to any earlier one, dropped or not."""
    strong = correlations(df, features).filter(F.col("corr") > limit).select("b").distinct()
    dropped = {r["b"] for r in strong.collect()}  # at most one row per feature
    return [f for f in features if f not in dropped]


def weekly_last(df: DataFrame, columns: Sequence[str], keys=KEYS, order: str = "date") -> DataFrame:
    """Last non-null value per week, labelled with its Sunday; incomplete weeks go."""
    week_end = F.date_add(F.trunc(F.col(order), "week"), 6)
    return (
        df.groupBy(*keys, week_end.alias("week_end"))
        .agg(
            *[
                F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
                for c in columns
            ]
        )
        .dropna(subset=list(columns))
    )


def normalise_scores(df: DataFrame, column: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """(x - min) / population std, over the whole frame or per ``by`` group (nulls make one too).

    The statistics are one row per group; for the whole frame they come back to
    the driver as two numbers.
    """
    stats = [F.min(column).alias("__lo"), F.stddev_pop(column).alias("__sd")]
    scaled = F.try_divide(F.col(column) - F.col("__lo"), F.col("__sd"))
    if by:
        # Stored first, so that the join knows the statistics' size.
        joined = _join_same(df, settle(df.groupBy(*by).agg(*stats)), by)
        return joined.withColumn(name, scaled).drop("__lo", "__sd")
    lo, sd = df.agg(*stats).first()
    if not sd:
        return df.withColumn(name, F.lit(None).cast("double"))
    return df.withColumn(name, (F.col(column) - F.lit(lo)) / F.lit(sd))


def anomaly_rates(df: DataFrame, flags: Sequence[str], score: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(score).alias("mean_score"),
        *[F.avg(F.col(f).cast("double")).alias(f"rate_{f}") for f in flags],
    )


def date_range(df: DataFrame, keys: Sequence[str] = (), order: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(order).alias("first_date"), F.max(order).alias("last_date"))
