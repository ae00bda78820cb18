"""Change points of weekly series: PELT (Killick et al. 2012) with an RBF kernel cost."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.operators.aggregates import weekly_last
from panelwatch.session import task_count

KEYS = ("series_key",)


def kernel_width(x: np.ndarray) -> float:
    """1 / median pairwise squared distance, or 1 if that median is 0.

    The middle distances are found by bisection on the sorted values, so memory
    stays linear in the series length.
    """
    x = np.sort(x)
    n = len(x)
    pairs = n * (n - 1) // 2
    if not pairs:
        return 1.0
    after = np.arange(1, n + 1)

    def at_most(d: float) -> int:
        return int((np.searchsorted(x, x + d, side="right") - after).clip(min=0).sum())

    def kth(k: int) -> float:
        lo, hi = 0.0, float(x[-1] - x[0])
        if at_most(lo) >= k:
            return 0.0
        while True:
            mid = (lo + hi) / 2
            if mid <= lo or mid >= hi:
                return hi
            lo, hi = (lo, mid) if at_most(mid) >= k else (mid, hi)

    a, b = kth((pairs + 1) // 2), kth(pairs // 2 + 1)
    median = (a * a + b * b) / 2
    return 1.0 / median if median else 1.0


def pelt_rbf(
    x: np.ndarray,
    penalty: float = S.CP_PENALTY,
    min_size: int = S.CP_MIN_SIZE,
    step: int = S.CP_STEP,
) -> list[int]:
    """Interior change points (index of the first row of each later segment).

    The cost of rows [s, t) is (t - s) - sum(Gram[s:t, s:t]) / (t - s).  The sums
    for all open starts are updated as t advances, so the Gram matrix is never held.
    """
    n = len(x)
    if n < min_size:
        return []
    gamma = kernel_width(x)
    ends = [t for t in range(0, n, step) if t >= min_size] + [n]
    best = {0: 0.0}
    previous: dict[int, int] = {}
    inside = np.zeros(n)  # inside[s] = sum of Gram over [s, done) x [s, done)
    done = 0
    starts: list[int] = []
    for t in ends:
        gram = np.exp(-np.clip((x[:t, None] - x[None, done:t]) ** 2 * gamma, 1e-2, 1e2))
        gram[np.arange(done, t), np.arange(t - done)] = 1.0
        old = gram[:done].sum(axis=1)[::-1].cumsum()[::-1]  # rows s..done against the new ones
        new = gram[done:]
        corner = new[::-1, ::-1].cumsum(axis=0).cumsum(axis=1)[::-1, ::-1]
        inside[:done] += 2 * old + new.sum()
        inside[done:t] = np.diagonal(corner)
        done = t

        start = (t - min_size) // step * step
        starts.append(start)
        s = np.array(starts)
        cost = (t - s) - inside[s] / (t - s)
        total = np.array([best[v] for v in starts]) + cost + penalty
        pick = int(total.argmin())
        best[t], previous[t] = float(total[pick]), starts[pick]
        starts = [v for v, c in zip(starts, total) if c <= best[t] + penalty]

    found, t = [], previous[n]
    while t > 0:
        found.append(t)
        t = previous[t]
    return found[::-1]


def changepoints(
    df: DataFrame,
    features: Sequence[str] = S.FEATURES,
    penalty: float = S.CP_PENALTY,
    keys=KEYS,
    order: str = "date",
) -> DataFrame:
    """(keys, feature, week_end) for every change point of the weekly series.

    Weekly rows are bounded by the calendar; each (key, feature) is one group.
    """
    keys = list(keys)
    weekly = weekly_last(df, features, keys, order)
    long = weekly.unpivot([*keys, "week_end"], list(features), "feature", "value")
    schema = T.StructType(
        [df.schema[k] for k in keys]
        + [T.StructField("feature", T.StringType()), T.StructField("week_end", T.DateType())]
    )
    columns = schema.names

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("week_end", ignore_index=True)
        hits = pelt_rbf(pdf["value"].to_numpy(dtype=float), penalty)
        return pdf.loc[hits, columns]

    long = long.repartition(task_count(df.sparkSession), *keys, "feature")
    return long.groupBy(*keys, "feature").applyInPandas(find, schema)


def changepoint_density(
    df: DataFrame, points: DataFrame, n_features: int, keys=KEYS, order: str = "date", name: str = "scores_cp"
) -> DataFrame:
    """Adds the share of features with a change point on the date; labels off the spine are lost."""
    hits = points.groupBy(*keys, F.col("week_end").alias(order)).agg(
        (F.count(F.lit(1)) / F.lit(float(n_features))).alias(name)
    )
    return df.join(hits, [*keys, order], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
