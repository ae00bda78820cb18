"""The three feature sets and their alignment.

Inputs are wide daily panels keyed by (series_key, date).  Every feature is a
window on one key, so ``build_features`` stacks the sources, shuffles
once by key, folds them to one row per date, and runs all windows in that same
stage.  A source's windows must see its own rows only: they partition by the key
*and* by whether the row belongs to the source, which needs a sort but no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import rolling as R
from panelwatch.functions import scalar as C
from panelwatch.operators.series import Series, _join_same, non_null_window, rolling_moments
from panelwatch.operators.spine import reindex
from panelwatch.session import task_count

KEYS = ("series_key",)

# Column names of the price inputs inside the plan.
_PRICE = {"BZ=F": "p_brent", "CL=F": "p_wti", "NG=F": "p_ng", "XLE": "p_xle", "^OVX": "p_ovx", "^VIX": "p_vix"}


def _price_inputs(prices: DataFrame, on: Sequence[str]) -> DataFrame:
    return prices.select(*on, *[F.col(f"`{t}`").cast("double").alias(n) for t, n in _PRICE.items()])


def _with_price_features(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Adds the price features without rolling moments; ``m_brent`` is the macro Brent on price dates.

    Brent takes the futures close and falls back to the macro series, which was
    matched to price dates before it is filled: a macro value on a date without
    prices is lost.
    """
    df = df.withColumns({n: C.clip_lower(n) for n in _PRICE.values()})
    fallback = C.clip_lower(R.ffill("m_brent", w))
    df = df.withColumn("p_brent", F.coalesce(C.keep_above("p_brent"), fallback))
    return df.withColumns(
        {
            "brent_ret_1d": R.log_return("p_brent", 1, w),
            "brent_ret_5d": R.log_return("p_brent", 5, w),
            "wti_ret_1d": R.log_return("p_wti", 1, w),
            "brent_wti_spread": F.col("p_brent") - F.col("p_wti"),
            "ng_ret_1d": R.log_return("p_ng", 1, w),
            "xle_ret_1d": R.log_return("p_xle", 1, w),
            "xle_brent_ratio": C.ratio("p_xle", "p_brent"),
        }
    )


def _with_macro_features(df: DataFrame, w: WindowSpec, keys: Sequence[str], order: str) -> DataFrame:
    """Adds the macro features without rolling moments.

    Changes count all rows of the source; inflation and the dollar use their own
    non-null rows and are to be carried forward from there.
    """
    return df.withColumns(
        {
            "yield_curve_chg_20d": R.diff("yield_curve", 20, w),
            "hy_spread_chg_5d": R.diff("hy_spread", 5, w),
            "cpi_yoy": R.pct_change("cpi", 12, non_null_window("cpi", keys, order)),
            "has_dxy": F.col("dxy").isNotNull(),
        }
    )


def _with_geo_signal(df: DataFrame) -> DataFrame:
    """Adds the geopolitical signal.

    The weight follows the key's present staleness and applies to all its rows.
    The volatility z-score is the one of that very date, so a missing one leaves
    the signal missing even at weight 1.
    """
    weight = C.staleness_weight("gpr_days_stale")
    return df.withColumn("geo_signal", C.decayed_signal("GPR_AI", "ovx_zscore", weight))


# Features that are rolling moments: (column, moment, rows); frames hold the source's rows.
PRICE_MOMENTS = {
    "ovx_zscore": ("p_ovx", "z", S.Z_WINDOW),
    "vix_zscore": ("p_vix", "z", S.Z_WINDOW),
    "brent_vol_20d": ("brent_ret_1d", "std", 20),
}
DOLLAR_MOMENTS = {"dxy_zscore": ("dxy", "z", S.Z_WINDOW)}
GEO_MOMENTS = {"gpr_oil_zscore": ("GPR_OIL", "z", S.Z_WINDOW)}


def _flagged(moments: dict[str, tuple], flag: str | None) -> dict[str, tuple]:
    return {name: (*m, flag) for name, m in moments.items()}


def _moments(df: DataFrame, wanted: dict[str, tuple], keys: Sequence[str], order: str) -> DataFrame:
    """One Arrow pass for all rolling moments; rows are already together by key."""
    return rolling_moments(Series(df, keys, order, keys, False), wanted).df


def price_features(prices: DataFrame, macro: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """(keys, order) and the 10 price features on the price dates."""
    on = [*keys, order]
    both = reindex(_price_inputs(prices, on), macro.select(*on, F.col("brent").alias("m_brent")), keys, order)
    w = W.partitionBy(*keys).orderBy(order)
    rows = _moments(_with_price_features(both, w), _flagged(PRICE_MOMENTS, None), keys, order)
    return rows.select(*on, *S.PRICE_BLOCK)


def macro_features(macro: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """(keys, order) and the 7 macro features on the macro dates."""
    w = W.partitionBy(*keys).orderBy(order)
    rows = _moments(_with_macro_features(macro, w, keys, order), _flagged(DOLLAR_MOMENTS, "has_dxy"), keys, order)
    rows = rows.withColumns({c: R.ffill(c, w) for c in ("cpi_yoy", "dxy_zscore")})
    return rows.select(*keys, order, *S.MACRO_BLOCK)


def geo_features(geo: DataFrame, ovx: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """(keys, order) and the 2 geopolitical features on the index dates.

    ``ovx`` holds (keys, order, ovx_zscore); ``geo`` carries its staleness.
    """
    on = [*keys, order]
    both = reindex(geo, ovx.select(*on, "ovx_zscore"), keys, order)
    rows = _moments(_with_geo_signal(both), _flagged(GEO_MOMENTS, None), keys, order)
    return rows.select(*on, *S.GEO_BLOCK)


def stack(sources: dict[str, DataFrame], keys=KEYS, order: str = "date") -> DataFrame:
    """Full outer alignment of sources with distinct columns, on one shuffle by key.

    ``in_<source>`` tells whether the source has the date.
    """
    flagged = [df.withColumn(f"in_{name}", F.lit(True)) for name, df in sources.items()]
    both = flagged[0]
    for df in flagged[1:]:
        both = both.unionByName(df, allowMissingColumns=True)
    values = [c for c in both.columns if c not in (*keys, order)]
    # At most one row per source and date: max picks the one present value.
    laid_out = both.repartition(task_count(both.sparkSession), *keys)
    rows = laid_out.groupBy(*keys, order).agg(*[F.max(c).alias(c) for c in values])
    return rows.fillna(False, [f"in_{name}" for name in sources])


# The two parts of the last geopolitical signal, and the day up to which a key's seeds stand for its rows.
CARRIED = ("last_gpr", "last_ovx")
ZONE = "zone"


def _seeded(rows: DataFrame, seeds: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Features up to a key's zone give way to its seeds, ``__seed_<name>``, which later days carry forward."""
    names = [*S.FEATURES, *CARRIED]
    given = seeds.select(*keys, ZONE, *[F.col(c).alias(f"__seed_{c}") for c in names])
    rows = _join_same(rows, given, keys, "left")
    weight = C.staleness_weight("gpr_days_stale")
    signal = C.decayed_signal("__seed_last_gpr", "__seed_last_ovx", weight)
    known = F.col(ZONE).isNull() | (F.col(order) > F.col(ZONE))
    return rows.withColumns({c: F.when(known, F.col(c)) for c in names} | {"__seed_geo_signal": signal})


def build_features(
    prices: DataFrame,
    macro: DataFrame,
    geo: DataFrame,
    floor: str | None = S.DATE_FLOOR,
    keys=KEYS,
    order: str = "date",
    seeds: DataFrame | None = None,
    carry: bool = False,
) -> DataFrame:
    """All 19 features on the union of dates, plus the status columns.

    ``geo`` carries its staleness (``sources.landing.with_staleness``).  With ``seeds`` (keys,
    ``ZONE``, features, ``CARRIED``) the rows up to a key's zone serve windows only, and what the
    days after it carry forward from there are the seeds.  ``carry`` adds the ``CARRIED`` columns.
    """
    on = [*keys, order]
    macro_cols = [c for c in S.MACRO_SERIES if c != "brent"]
    rows = stack(
        {
            "price": _price_inputs(prices, on),
            "macro": macro.select(*on, *macro_cols, F.col("brent").alias("m_brent")),
            "geo": geo.select(*on, "GPR_AI", "GPR_OIL", "gpr_days_stale", "gpr_is_stale"),
        },
        keys,
        order,
    )
    within = {s: W.partitionBy(*keys, f"in_{s}").orderBy(order) for s in ("price", "macro")}
    rows = rows.withColumn("m_brent", F.when(F.col("in_price"), F.col("m_brent")))
    rows = _with_price_features(rows, within["price"])
    rows = _with_macro_features(rows, within["macro"], keys, order)
    rolled = _flagged(PRICE_MOMENTS, "in_price") | _flagged(DOLLAR_MOMENTS, "has_dxy") | _flagged(GEO_MOMENTS, "in_geo")
    rows = _with_geo_signal(_moments(rows, rolled, keys, order))
    if seeds is not None or carry:
        signal = F.col("geo_signal").isNotNull()
        rows = rows.withColumns(dict(zip(CARRIED, (F.when(signal, F.col("GPR_AI")), F.when(signal, F.col("ovx_zscore"))))))
    if seeds is not None:
        # every row of a key has its staleness before the seeds need it
        key_rows = W.partitionBy(*keys)
        rows = rows.withColumn("gpr_days_stale", F.max("gpr_days_stale").over(key_rows))
        rows = _seeded(rows, seeds, keys, order)
    w = W.partitionBy(*keys).orderBy(order)
    whole_key = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    stale = {c: F.max(c).over(whole_key) for c in ("gpr_is_stale", "gpr_days_stale")}
    filled = lambda c: R.ffill(c, w) if seeds is None else F.coalesce(R.ffill(c, w), F.col(f"__seed_{c}"))
    rows = rows.select(
        *on,
        *[filled(f).alias(f) for f in S.FEATURES],
        F.lit(True).alias("is_trading_day"),
        F.lit(1.0).alias("data_quality_score"),
        F.lit("").alias("data_quality_flags"),
        *[c.alias(n) for n, c in stale.items()],
        *[filled(c).alias(c) for c in CARRIED if carry],
    )
    # The floor comes after the fill, so that older values seed the first rows.
    return rows if floor is None else rows.filter(F.col(order) >= F.to_date(F.lit(floor)))
