"""Landed source snapshots and the feature table, as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.functions.scalar import nan_to_null
from panelwatch.operators.aggregates import staleness
from panelwatch.operators.series import without_same
from panelwatch.session import settle
from panelwatch.sources import commits

RUN = "ingest_date"
AS_OF = "as_of"
MONTH = "month"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` under a declared schema; no table there gives no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e.getCondition()):
            raise
        return spark.createDataFrame([], schema)


def write_partitions(df: DataFrame, path: str, *parts: str) -> None:
    """Replace exactly the partitions ``df`` has rows for.

    Files are staged and moved in at commit, so a lost executor or a failed job
    leaves the old partitions.  The rebalance hint lets Spark merge small
    partitions and cut big ones, so a hot month does not become one task.
    """
    (
        df.hint("rebalance", *parts)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path)
    )


def append_partitions(df: DataFrame, path: str, *parts: str) -> None:
    """Add rows to partitions without touching what they hold; the caller knows the rows are new."""
    df.hint("rebalance", *parts).write.mode("append").partitionBy(*parts).parquet(path)


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(RUN, T.DateType())])


def write_snapshot(df: DataFrame, root: str, source: str, run_date: str) -> bool:
    """Land one snapshot per (source, run date); a rerun replaces it, no rows are skipped.

    A current table that has counted this run date, or a later one, is emptied first; the next
    ``merge_landed`` builds it anew.
    """
    if df.isEmpty():
        return False
    spark, merged = df.sparkSession, commits.version(df.sparkSession, current_path(root, source))
    if merged.notes.get(RUN, "") >= run_date:
        commits.commit(spark, current_path(root, source), commits.Version(merged.number + 1))
    write_partitions(df.withColumn(RUN, F.to_date(F.lit(run_date))), f"{root}/{source}", RUN)
    return True


def read_snapshot(
    spark: SparkSession, root: str, source: str, schema: T.StructType, run_date: str
) -> DataFrame:
    """One landed snapshot; the filter prunes all other run dates."""
    landed = read_parquet(spark, f"{root}/{source}", _with_run(schema))
    return landed.filter(F.col(RUN) == F.to_date(F.lit(run_date))).drop(RUN)


def current_path(root: str, source: str) -> str:
    return f"{root}/{source}_current"


def _newest(landed: DataFrame, schema: T.StructType, ids: Sequence[str]) -> DataFrame:
    """Per identity the row landed last, with its run date."""
    rest = [c for c in schema.names if c not in ids]
    newest = landed.groupBy(*ids).agg(F.max_by(F.struct(*rest, RUN), F.col(RUN)).alias("__row"))
    return newest.select(*[c if c in ids else F.col("__row")[c].alias(c) for c in (*schema.names, RUN)])


def merge_landed(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType,
    ids: Sequence[str],
    until: str | None = None,
    order: str = "date",
) -> list[str]:
    """Fold the snapshots landed since the last merge (up to ``until``) into the source's current table; their run dates.

    The table holds each identity's newest row with its run date, and notes the last run date it
    has counted.  Only new snapshots are opened, and of the table the months in which they have
    rows; those are written anew and become visible in one step.  ``order`` must be one of ``ids``,
    so that an identity stays in its month.
    """
    if order not in ids:
        raise ValueError(f"{order} is not among the ids {list(ids)}")
    path = current_path(root, source)
    base = commits.version(spark, path)
    done = base.notes.get(RUN, "")
    runs = [r for r in partitions(spark, f"{root}/{source}", RUN) if r > done and (until is None or r <= until)]
    if not runs:
        return []
    new = settle(read_runs(spark, root, source, schema, runs).withColumn(MONTH, month_of(order)))
    months = months_in(new)
    there = commits.read(spark, path, _with_run(schema), commits.in_folders(base, months))
    rows = _newest(there.drop(MONTH).unionByName(new.drop(MONTH)), schema, ids).withColumn(MONTH, month_of(order))
    commits.write(rows, path, base, months, {RUN: runs[-1]})
    return runs


def read_history(
    spark: SparkSession,
    root: str,
    source: str,
    schema: T.StructType,
    ids: Sequence[str],
    until: str | None = None,
    start: Column | None = None,
) -> DataFrame:
    """All landed snapshots as one history: per identity the newest landed row.

    Comes from the current table (``merge_landed``) and the snapshots it has not counted yet, so
    a read does not grow with the number of runs.  Without such a table, if it has counted runs
    after ``until``, or with a ``start`` it is made from the snapshots themselves.
    ``start`` leaves out runs before that date, which hold no later observation.
    """
    merged = commits.version(spark, current_path(root, source))
    done = merged.notes.get(RUN, "")
    if done and start is None and (until is None or done <= until):
        runs = [r for r in partitions(spark, f"{root}/{source}", RUN) if r > done and (until is None or r <= until)]
        current = commits.read(spark, current_path(root, source), _with_run(schema), merged).drop(MONTH)
        if not runs:
            return no_nan(current.drop(RUN))
        landed = current.unionByName(read_runs(spark, root, source, schema, runs))
    else:
        landed = read_parquet(spark, f"{root}/{source}", _with_run(schema))
        if until is not None:
            landed = landed.filter(F.col(RUN) <= F.to_date(F.lit(until)))
        if start is not None:
            landed = landed.filter(F.col(RUN) >= start)
    return no_nan(_newest(landed, schema, ids).drop(RUN))


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a partition column at ``path``, from the names of its folders alone."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root)]
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}="))


def read_runs(spark: SparkSession, root: str, source: str, schema: T.StructType, runs: Sequence[str]) -> DataFrame:
    """The snapshots of these run dates, with their run date; no other is opened or listed."""
    if not runs:
        return spark.createDataFrame([], _with_run(schema))
    base = f"{root}/{source}"
    return spark.read.schema(_with_run(schema)).option("basePath", base).parquet(*[f"{base}/{RUN}={r}" for r in runs])


def no_nan(df: DataFrame) -> DataFrame:
    """NaN in any double is a missing value: null."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: nan_to_null(c) for c in doubles})


def as_date(c: Column | str, zone: str | None = None) -> Column:
    """Any date-like column as a date.

    Text and local timestamps keep their written day; a zone in text is dropped, not
    converted.  An instant has a day only in a zone: pass the source's ``zone``, or the
    session's counts.
    """
    c = F.col(c) if isinstance(c, str) else c
    if zone is not None:
        return F.convert_timezone(F.current_timezone(), F.lit(zone), c.cast("timestamp_ntz")).cast("date")
    return c.cast("timestamp_ntz").cast("date")


class TooManyRejects(Exception):
    """More rows of a source could not be read than its caller allows."""


FAULTS = "__faults"


def read_geo_csv(
    spark: SparkSession,
    path: str,
    as_of: str,
    series_key: str = "all",
    rejects: str | None = None,
    limit: float = 0.01,
) -> DataFrame:
    """The geopolitical index file with its staleness as of a date.

    Columns are taken by the names in the header, wherever they stand; others are left
    out.  A missing column fails the read.  So does a value that is not a number or a date, unless
    ``rejects`` names a table: then rows with such a value, or without a date, go there under ``as_of``
    (a rerun replaces them) with all their cells as text, their ``__file`` and the columns at fault (``__faults``), and the
    read fails only if their share of the rows is above ``limit``.  The file is read once.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = [n for n in S.GEO_CSV.names if n not in raw.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    numbers = [n for n in S.GEO_CSV.names if n != "Date"]
    if rejects is None:
        number = lambda n: nan_to_null(F.trim(F.col(n)).cast("double")).alias(n)  # noqa: E731  (ANSI casts fail on other text)
        geo = raw.select(F.lit(series_key).alias("series_key"), as_date("Date").alias("date"), *[number(n) for n in numbers])
    else:
        geo = _without_rejects(raw, numbers, f"{rejects}/{AS_OF}={as_of}", limit).select(
            F.lit(series_key).alias("series_key"), F.col("__Date").alias("date"), *[F.col(f"__{n}").alias(n) for n in numbers]
        )
    return with_staleness(geo, as_of)


def _without_rejects(raw: DataFrame, numbers: Sequence[str], rejects: str, limit: float) -> DataFrame:
    """The readable rows, values under ``__name``; the others are stored at ``rejects``."""
    text = {n: F.trim(F.col(n)) for n in numbers}
    value = {"Date": F.trim("Date").try_cast("timestamp_ntz").cast("date"), **{n: t.try_cast("double") for n, t in text.items()}}
    wrong = [F.when(value["Date"].isNull(), F.lit("Date")), *[F.when((text[n] != "") & value[n].isNull(), F.lit(n)) for n in numbers]]
    cells = F.struct(*[F.col(f"`{c}`") for c in raw.columns]).alias("__cells")
    split = settle(
        raw.select(
            cells,
            F.col("_metadata.file_path").alias("__file"),
            F.array_compact(F.array(*wrong)).alias(FAULTS),
            *[(c if n == "Date" else nan_to_null(c)).alias(f"__{n}") for n, c in value.items()],
        )
    )
    bad = F.size(FAULTS) > 0
    rows, lost = split.agg(F.count(F.lit(1)), F.count_if(bad)).first()
    split.filter(bad).select("__cells.*", "__file", FAULTS).write.mode("overwrite").parquet(rejects)
    if lost > limit * rows:
        raise TooManyRejects(f"{lost} of {rows} rows cannot be read, kept in {rejects}")
    return split.filter(~bad)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """All stored rejects: cells as text, file, the columns at fault, and the date of the read."""
    return spark.read.option("mergeSchema", True).parquet(path)


def with_staleness(geo: DataFrame, as_of: str, keys: Sequence[str] = ("series_key",)) -> DataFrame:
    """Every row with its key's staleness; the one row per key is stored for its size."""
    return geo.join(settle(staleness(geo, as_of, keys)), list(keys))


def widen(
    long: DataFrame,
    names: Sequence[str],
    name_col: str,
    value_col: str,
    keys: Sequence[str] = ("series_key",),
    order: str = "date",
) -> DataFrame:
    """One column per name on the union of dates, in one shuffle; NaN counts as missing."""
    return (
        no_nan(long).select(*keys, order, name_col, value_col)
        .groupBy(*keys, order)
        .pivot(name_col, list(names))
        .agg(F.first(value_col, ignorenulls=True))
    )


def wide_prices(bars: DataFrame, tickers: Sequence[str] = S.TICKERS) -> DataFrame:
    """Daily bars (series_key, date, ticker, close) to one close column per ticker."""
    return widen(bars, tickers, "ticker", "close")


def wide_macro(long: DataFrame, names: Sequence[str] = S.MACRO_SERIES) -> DataFrame:
    return widen(long, names, "series", "value")


def look_back(
    df: DataFrame, as_of: str, backfill: bool, days: int = S.LOOKBACK_DAYS, start: str | None = None, order: str = "date"
) -> DataFrame:
    """Full history from ``start``, or the last ``days`` days up to ``as_of``."""
    if not backfill:
        end = F.to_date(F.lit(as_of))
        return df.filter((F.col(order) > F.date_sub(end, days)) & (F.col(order) <= end))
    return df if start is None else df.filter(F.col(order) >= F.to_date(F.lit(start)))


def _with_month(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(MONTH, T.StringType())])


def month_of(order: str = "date") -> Column:
    return F.date_format(order, "yyyy-MM")


def read_features(spark: SparkSession, path: str, schema: T.StructType = S.FEATURE_TABLE) -> DataFrame:
    return read_parquet(spark, path, _with_month(schema)).drop(MONTH)


def write_features(df: DataFrame, path: str, order: str = "date") -> None:
    """Replace the months ``df`` covers; pass every row of those months."""
    write_partitions(df.withColumn(MONTH, month_of(order)), path, MONTH)


def touched_months(table: DataFrame, new: DataFrame) -> DataFrame:
    """The table's rows in the months ``new`` has; the scan reads those partitions only.

    ``new`` should be a stored table.
    """
    return table.filter(in_months(months_in(new))).select(*new.columns)


def in_months(months: Sequence[str | None]) -> Column:
    """Whether a row's month is one of these; the month of a null date is null."""
    known = F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(False))
    return known | F.col(MONTH).isNull() if None in months else known


def months_in(df: DataFrame) -> list[str | None]:
    """The months of a frame with a month column; bounded by the calendar."""
    return [r[MONTH] for r in df.select(MONTH).distinct().collect()]


def append_features(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    schema: T.StructType = S.FEATURE_TABLE,
    keys: Sequence[str] = ("series_key",),
    order: str = "date",
) -> None:
    """Add the dates the table lacks; nothing stored is rewritten.

    Only keys and dates are read, of the months that ``df``, a stored table, has.  A run that
    was cut short is completed by the next: what it added counts as there.
    """
    new = df.select(*schema.names).withColumn(MONTH, month_of(order))
    there = touched_months(read_parquet(spark, path, _with_month(schema)), new)
    append_partitions(without_same(new, there, [*keys, order]), path, MONTH)
