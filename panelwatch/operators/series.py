"""Row-count windows over a panel, with every window partition bounded.

A *panel* has one row per (keys, order).  A daily panel is bounded by the
calendar, so ``Series.of`` puts one window partition per key.  An event-level
panel is not: one key may hold a third of all rows.  ``Series.split`` cuts such
keys into chunks of consecutive rows and copies into each chunk the ``lookback``
rows before it (the halo), so that frames reaching back at most ``lookback``
rows are exact and no task ever sees more than about a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from panelwatch import schemas as S
from panelwatch.functions import rolling as R
from panelwatch.session import settle, task_count

BUCKET, CHUNK, HALO = "__bucket", "__chunk", "__halo"
PART, POSITION = "__part", "__position"
ROWS_PER_CHUNK = 500_000
WIDE = 2  # from this many columns on, one Arrow pass beats per-column sliding frames


def _join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which nulls equal each other; ``right`` gives only its other columns."""
    renamed = right.withColumnsRenamed({c: f"__same_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__same_{c}")) for c in on]
    return left.join(renamed, reduce(and_, same), how).drop(*[f"__same_{c}" for c in on])


def without_same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``left`` that ``right`` lacks by ``on``; nulls equal each other."""
    return _join_same(left, right.select(*on), on, "left_anti")


class Series:
    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        part: Sequence[str],
        is_split: bool,
        tie: Sequence[str] = (),
    ):
        self.df, self.keys, self.order, self.tie = df, list(keys), order, list(tie)
        self.part, self.is_split = list(part), is_split

    # -- construction -------------------------------------------------------

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str] = ("series_key",),
        order: str = "date",
        tie: Sequence[str] = (),
    ) -> Series:
        """One window partition per key, for panels bounded by the calendar.

        The one shuffle by key happens here; all later windows and passes reuse it.
        """
        laid_out = df.repartition(task_count(df.sparkSession), *keys)
        return cls(laid_out, keys, order, keys, False, tie)

    @classmethod
    def split(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        lookback: int,
        rows_per_chunk: int = ROWS_PER_CHUNK,
        tie: Sequence[str] = (),
    ) -> Series:
        """Bounded partitions for panels whose keys may be arbitrarily long.

        ``tie`` orders rows that share an ``order`` value; together they must give
        a total order per key.

        Keys are counted first; if none exceeds a chunk nothing is cut.  Otherwise
        rows are dealt by ranges of (keys, order, tie) and stored, and the counts
        of the ranges give every row its position in its key.  Chunks are cut by
        position, so neither bursts nor ties nor nulls make one grow, and no row
        is lost: null keys are a key, null order values come first in it.
        """
        rows_per_chunk = max(rows_per_chunk, 2 * lookback, 2)
        keys = list(keys)
        longest, total = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
        if longest is None or longest <= rows_per_chunk:
            return cls.of(df, keys, order, tie)

        dealt = df.repartitionByRange(*keys, order, *tie).withColumn(PART, F.spark_partition_id())
        dealt = settle(dealt)
        past = W.partitionBy(*keys).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
        firsts = dealt.groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("__n"))
        firsts = settle(firsts.withColumn(POSITION, F.coalesce(F.sum("__n").over(past), F.lit(0))).drop("__n"))
        rank = F.row_number().over(W.partitionBy(*keys, PART).orderBy(order, *tie)) - 1
        at = dealt.withColumn("__rank", rank)
        at = _join_same(at, firsts, [*keys, PART]).withColumn(POSITION, F.col(POSITION) + F.col("__rank"))

        # The last ``lookback`` rows of a chunk are also sent to the next one.  A
        # bucket is a chunk's part before these rows, or these rows.
        own = F.floor(F.col(POSITION) / rows_per_chunk).cast("long")
        halo = (F.col(POSITION) % rows_per_chunk >= rows_per_chunk - lookback).cast("long")
        cut = (
            at.withColumns({"__own": own, "__shared": halo})
            .withColumn(BUCKET, 2 * F.col("__own") + F.col("__shared"))
            .withColumn(CHUNK, F.explode(F.sequence("__own", F.col("__own") + F.col("__shared"))))
            .withColumn(HALO, F.col(CHUNK) != F.col("__own"))
            .drop(PART, POSITION, "__rank", "__own", "__shared")
        )
        part = [*keys, CHUNK]
        n = max(task_count(df.sparkSession), -(-total // rows_per_chunk))
        return cls(cut.repartition(n, *part), keys, order, part, True, tie)

    # -- use ----------------------------------------------------------------

    @property
    def window(self) -> WindowSpec:
        return W.partitionBy(*self.part).orderBy(self.order, *self.tie)

    def _with(self, df: DataFrame) -> Series:
        return Series(df, self.keys, self.order, self.part, self.is_split, self.tie)

    def with_columns(self, build: Callable[[WindowSpec], dict[str, Column]]) -> Series:
        return self._with(self.df.withColumns(build(self.window)))

    def map_arrow(self, fn: Callable, columns: Sequence[str], new: Sequence[str]) -> Series:
        """Append double columns computed in one pass over each ordered partition.

        ``fn`` maps a pandas frame of ``columns`` (rows in order) to one of ``new``.
        All other columns travel through as Arrow buffers.
        """
        fields = self.df.schema.fields + [T.StructField(c, T.DoubleType()) for c in new]
        schema = T.StructType(fields)
        arrow_schema = to_arrow_schema(schema, prefers_large_types=False)
        columns, new = list(columns), list(new)
        order = [(c, "ascending") for c in (self.order, *self.tie)]

        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by(order)
            out = fn(table.select(columns).to_pandas())
            for c in new:
                table = table.append_column(c, pa.array(out[c], type=pa.float64(), from_pandas=True))
            return table.cast(arrow_schema) if table.schema != arrow_schema else table

        return self._with(self.df.groupBy(*self.part).applyInArrow(run, schema))

    def body(self) -> DataFrame:
        """The panel rows, each exactly once."""
        if not self.is_split:
            return self.df
        return self.df.filter(~F.col(HALO)).drop(BUCKET, CHUNK, HALO)


# -- operators on a series ----------------------------------------------------


def forward_fill(s: Series, columns: Sequence[str]) -> Series:
    """Last non-null value so far, however far back it lies."""
    filled = s.with_columns(lambda w: {c: R.ffill(c, w) for c in columns})
    if not s.is_split:
        return filled
    # Values from before a chunk's first row: last non-null per bucket, carried
    # forward over the buckets that end before the chunk (with its halo) begins.
    body = s.df.filter(~F.col(HALO))
    per_bucket = body.groupBy(*s.keys, BUCKET).agg(
        *[
            F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(s.order, *s.tie))).alias(c)
            for c in columns
        ]
    )
    starts = s.df.groupBy(*s.part).agg(F.min(BUCKET).alias(BUCKET))
    marks = per_bucket.withColumn("is_bucket", F.lit(1)).unionByName(
        starts.withColumn("is_bucket", F.lit(0)), allowMissingColumns=True
    )
    before = (
        W.partitionBy(*s.keys)
        .orderBy(BUCKET, "is_bucket")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    carry = (
        marks.select(
            *s.part,
            "is_bucket",
            *[F.last(c, ignorenulls=True).over(before).alias(f"__carry_{c}") for c in columns],
        )
        .filter("is_bucket = 0")
        .drop("is_bucket")
    )
    joined = _join_same(filled.df, carry, s.part, "left")
    joined = joined.withColumns({c: F.coalesce(c, f"__carry_{c}") for c in columns})
    return s._with(joined.drop(*[f"__carry_{c}" for c in columns]))


def rolling_zscores(
    s: Series, columns: Sequence[str], names: Sequence[str], window: int = S.Z_WINDOW, floor: float | None = None
) -> Series:
    """Rolling z-score of many columns on one sort.

    Each sliding-frame expression re-aggregates its frame row by row; for wide
    """
    if len(columns) < WIDE:
        return s.with_columns(
            lambda w: {n: R.rolling_z(c, window, w, floor) for c, n in zip(columns, names)}
        )

    def zscores(x):
        v = x.to_numpy(dtype=float)
        return pd.DataFrame({n: _zscore(v[:, i], window, floor) for i, n in enumerate(names)})

    return s.map_arrow(zscores, columns, names)


def rolling_moments(s: Series, wanted: dict[str, tuple[str, str, int, str | None]]) -> Series:
    """Rolling z-scores ("z") and sample deviations ("std") of several sources in one pass.

    ``wanted`` names (column, moment, rows, source flag); frames hold the rows of that
    source only, all rows without a flag, and a null in a frame leaves its result null.
    """
    columns = dict.fromkeys(c for column, _, _, flag in wanted.values() for c in (column, flag) if c)

    def moments(x):
        out = pd.DataFrame(index=x.index)
        for name, (column, moment, rows, flag) in wanted.items():
            own = np.ones(len(x), bool) if flag is None else x[flag].to_numpy(dtype=bool)
            v = np.full(len(x), np.nan)
            v[own] = (_zscore if moment == "z" else _deviation)(x[column].to_numpy(dtype=float)[own], rows)
            out[name] = v
        return out

    return s.map_arrow(moments, list(columns), list(wanted))


def _deviation(x: np.ndarray, window: int) -> np.ndarray:
    """Two-pass sample deviation of each full frame."""
    out = np.full(len(x), np.nan)
    if len(x) >= window:
        frames = np.lib.stride_tricks.sliding_window_view(x, window)
        for start in range(0, len(frames), 8192):
            f = frames[start : start + 8192]
            out[start + window - 1 : start + window - 1 + len(f)] = (f - f[:, -1:]).std(axis=1, ddof=1)
    return out


def _zscore(x: np.ndarray, window: int, floor: float | None = None) -> np.ndarray:
    """Two-pass z-score of each full frame, on distances from the frame's last row.

    Distances keep a constant frame at exactly 0 and lose no digits when a large
    value has just left the frame, as running sums would.
    """
    out = np.full(len(x), np.nan)
    if len(x) < window:
        return out
    frames = np.lib.stride_tricks.sliding_window_view(x, window)
    for start in range(0, len(frames), 8192):
        f = frames[start : start + 8192]
        d = f - f[:, -1:]
        mean = d.mean(axis=1)
        sigma = np.sqrt(((d - mean[:, None]) ** 2).sum(axis=1) / (window - 1))
        if floor is not None:
            sigma = np.maximum(sigma, floor)
        with np.errstate(divide="ignore", invalid="ignore"):
            z = -mean / sigma + 0.0
        z[sigma == 0] = np.nan
        out[start + window - 1 : start + window - 1 + len(f)] = z
    return out


def rolling_quantiles(
    s: Series, column: str, windows: dict[str, int], q: float = S.ROLLING_PERCENTILE
) -> Series:
    """One rolling quantile per (name, rows) in ``windows``; needs rows//2 values."""

    def quantiles(x):
        v = x[column].astype("float64")
        return x.assign(
            **{name: v.rolling(n, min_periods=n // 2).quantile(q) for name, n in windows.items()}
        )

    return s.map_arrow(quantiles, [column], list(windows))


def non_null_window(column: str, keys=("series_key",), order: str = "date") -> WindowSpec:
    """The series window over the non-null rows of ``column`` only.

    Null rows fall into a partition of their own, where the column is null
    throughout, so results land on the full spine without a filter and a join.
    """
    return W.partitionBy(*keys, F.col(column).isNotNull()).orderBy(order)


def last_rows(
    df: DataFrame, n: int, keys=("series_key",), order: str = "date", tie: Sequence[str] = ()
) -> DataFrame:
    """The newest ``n`` rows per key; of equal order values those with the greatest ``tie``.

    Filtering on row_number lets Spark cut every input partition to ``n`` rows
    per key before the shuffle, so a hot key never reaches one task whole.
    """
    w = W.partitionBy(*keys).orderBy(F.desc(order), *map(F.desc, tie))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def latest_row(
    df: DataFrame, keys=("series_key",), order: str = "date", tie: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key, as a partial aggregate (no sort); ``tie`` as in ``last_rows``."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *tie)).alias("__row"))
    return newest.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])
