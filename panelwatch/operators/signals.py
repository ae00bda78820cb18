"""Anomaly signals, their blend, thresholds and attribution.

Scores, flags, thresholds and weights stay columns of one frame, so nothing is
ever re-aligned by date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import scalar as C
from panelwatch.operators.series import Series, rolling_quantiles, rolling_zscores


def zname(feature: str) -> str:
    return f"z_{feature}"


def zscore_signal(
    s: Series,
    blocks: dict[str, Sequence[str]] = S.BLOCKS,
    window: int = S.Z_WINDOW,
    floor: float = S.SIGMA_FLOOR,
    cap: float = 5.0,
) -> Series:
    """Adds ``z_<feature>`` columns and ``scores_z`` in [0, 1].

    Per block the largest magnitude, then the mean of the blocks, capped and
    scaled.  The z columns stay for the attribution.
    """
    features = [f for names in blocks.values() for f in names]
    s = rolling_zscores(s, features, [zname(f) for f in features], window, floor)
    tops = [C.max_abs([zname(f) for f in names]) for names in blocks.values()]
    return s._with(s.df.withColumn("scores_z", C.clip_upper_scaled(C.mean_of(tops), cap)))


def ensemble(
    df: DataFrame,
    w_if: float = S.WEIGHT_FOREST,
    w_z: float = S.WEIGHT_Z,
    w_cp: float = S.WEIGHT_CP,
) -> DataFrame:
    """Weighted blend; a missing z or change-point score counts as 0."""
    return df.withColumn(
        "risk_score",
        F.lit(w_if) * F.col("scores_if")
        + F.lit(w_z) * F.coalesce("scores_z", F.lit(0.0))
        + F.lit(w_cp) * F.coalesce("scores_cp", F.lit(0.0)),
    )


def anomaly_flags(
    s: Series,
    score: str = "risk_score",
    windows: dict[str, int] = S.ROLLING_WINDOWS,
    q: float = S.ROLLING_PERCENTILE,
    static: float = S.STATIC_THRESHOLD,
) -> Series:
    """Static and rolling-quantile thresholds; no threshold means no flag."""
    s = rolling_quantiles(s, score, {f"threshold_{n}": w for n, w in windows.items()}, q)
    df = s.df.withColumn("threshold_static", F.lit(float(static)))
    flags = {
        f"anomaly_{n}": F.coalesce(F.col(score) > F.col(f"threshold_{n}"), F.lit(False))
        for n in ("static", *windows)
    }
    return s._with(df.withColumns(flags))


def z_weights(features: Sequence[str], budget: float = S.WEIGHT_Z):
    """Per feature, its share of the row's absolute z-scores; 0 where undefined."""
    sizes = [F.abs(F.col(zname(f))) for f in features]
    return [F.coalesce(c, F.lit(0.0)) for c in C.shares(sizes, budget)]


def attribute(
    df: DataFrame,
    features: Sequence[str],
    forest_columns: Sequence[str] | None = None,
    k: int = 5,
    keep_all: bool = False,
) -> DataFrame:
    """Adds ``top_drivers``: forest plus z-score weights, the ``k`` heaviest.

    ``forest_columns`` are the absolute forest attributions in feature order;
    without them only the z part counts.  ``keep_all`` adds ``attribution`` with
    every feature in feature order.
    """
    z = z_weights(features)
    if forest_columns is None:
        parts = z
    else:
        forest = C.shares([F.col(c) for c in forest_columns], S.WEIGHT_FOREST)
        parts = [F.coalesce(a, F.lit(0.0)) + b for a, b in zip(forest, z)]
    # The weights become columns first, so the sort does not repeat their sums.
    names = [f"__w{i}" for i in range(len(features))]
    df = df.withColumns(dict(zip(names, parts)))
    df = df.withColumn("top_drivers", C.top_k({f: F.col(n) for f, n in zip(features, names)}, k))
    if keep_all:
        entries = [F.struct(F.lit(f).alias("feature"), F.col(n).alias("weight")) for f, n in zip(features, names)]
        df = df.withColumn("attribution", F.array(*entries))
    return df.drop(*names)
