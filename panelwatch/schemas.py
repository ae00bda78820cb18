"""Table schemas and the fixed names and numbers every stage agrees on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Results and stored column names depend on them.
# ---------------------------------------------------------------------------

TICKERS = ("BZ=F", "CL=F", "NG=F", "XLE", "XOP", "^OVX", "^VIX")

MACRO_SERIES = ("fed_rate", "yield_curve", "dxy", "hy_spread", "cpi", "brent")

PRICE_BLOCK = (
    "brent_ret_1d",
    "brent_ret_5d",
    "wti_ret_1d",
    "brent_wti_spread",
    "brent_vol_20d",
    "ng_ret_1d",
    "xle_ret_1d",
    "xle_brent_ratio",
    "ovx_zscore",
    "vix_zscore",
)
MACRO_BLOCK = (
    "yield_curve",
    "yield_curve_chg_20d",
    "dxy_zscore",
    "hy_spread",
    "hy_spread_chg_5d",
    "fed_rate",
    "cpi_yoy",
)
GEO_BLOCK = ("geo_signal", "gpr_oil_zscore")

FEATURE_LABELS = {
    "brent_ret_1d": "Brent crude daily move",
    "brent_ret_5d": "Brent crude weekly move",
    "wti_ret_1d": "WTI crude daily move",
    "brent_wti_spread": "Brent-WTI spread widening",
    "brent_vol_20d": "Oil price volatility",
    "ng_ret_1d": "Natural gas price move",
    "xle_ret_1d": "Energy equities move",
    "xle_brent_ratio": "Equities-to-oil divergence",
    "ovx_zscore": "Oil volatility spike",
    "vix_zscore": "Broad market fear spike",
    "yield_curve": "Yield curve inversion",
    "yield_curve_chg_20d": "Yield curve rapid shift",
    "dxy_zscore": "Dollar strength spike",
    "hy_spread": "Credit market stress",
    "hy_spread_chg_5d": "Credit stress acceleration",
    "fed_rate": "Elevated interest rates",
    "cpi_yoy": "Inflation pressure",
    "geo_signal": "Geopolitical risk",
    "gpr_oil_zscore": "Oil-specific geopolitical risk",
    "gpr_is_stale": "Geopolitical data delay",
    "gpr_days_stale": "Geopolitical data lag",
}

ROLLING_WINDOWS = {"5y": 1260, "1y": 252, "qtr": 63}
STATIC_THRESHOLD = 1.53
ROLLING_PERCENTILE = 0.95
Z_WINDOW = 60
SIGMA_FLOOR = 1e-6
PRICE_FLOOR = 1e-6
WEIGHT_FOREST, WEIGHT_Z, WEIGHT_CP = 0.4, 0.35, 0.25
FOREST_TREES, FOREST_SAMPLE, FOREST_SEED = 200, 256, 42
CP_PENALTY, CP_MIN_SIZE, CP_STEP = 10.0, 2, 5
CORR_LIMIT = 0.85
STALE_DAYS = 10
STALE_DECAY, NEUTRAL_LEVEL, FALLBACK_SCALE = 0.95, 100.0, 30.0
DATE_FLOOR = "2007-01-01"
LOOKBACK_DAYS = 5

# ---------------------------------------------------------------------------
# Derived names
# ---------------------------------------------------------------------------

FEATURES = PRICE_BLOCK + MACRO_BLOCK + GEO_BLOCK
BLOCKS = {"price": PRICE_BLOCK, "macro": MACRO_BLOCK, "geo": GEO_BLOCK}
EXPECTED_COLUMNS = FEATURES + ("gpr_is_stale", "gpr_days_stale")
STATUS_COLUMNS = (
    "is_trading_day",
    "data_quality_score",
    "data_quality_flags",
    "gpr_is_stale",
    "gpr_days_stale",
)
THRESHOLD_NAMES = ("static",) + tuple(ROLLING_WINDOWS)

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

KEY = T.StructField("series_key", T.StringType(), False)
DATE = T.StructField("date", T.DateType(), False)


def _doubles(names):
    return [T.StructField(n, T.DoubleType(), True) for n in names]


PRICES_RAW = T.StructType(
    [KEY, DATE, T.StructField("ticker", T.StringType()), T.StructField("close", T.DoubleType())]
)
MACRO_RAW = T.StructType(
    [KEY, DATE, T.StructField("series", T.StringType()), T.StructField("value", T.DoubleType())]
)
GEO_CSV = T.StructType(
    [T.StructField("Date", T.StringType()), *_doubles(("GPR_AI", "GPR_OIL"))]
)
GEO_RAW = T.StructType(
    [
        KEY,
        DATE,
        *_doubles(("GPR_AI", "GPR_OIL")),
        T.StructField("gpr_days_stale", T.IntegerType()),
        T.StructField("gpr_is_stale", T.BooleanType()),
    ]
)
FEATURE_TABLE = T.StructType(
    [
        KEY,
        DATE,
        *_doubles(FEATURES),
        T.StructField("is_trading_day", T.BooleanType()),
        T.StructField("data_quality_score", T.DoubleType()),
        T.StructField("data_quality_flags", T.StringType()),
        T.StructField("gpr_is_stale", T.BooleanType()),
        T.StructField("gpr_days_stale", T.IntegerType()),
    ]
)
DRIVERS = T.ArrayType(
    T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("weight", T.DoubleType())]
    )
)
SCORE_TABLE = T.StructType(
    [
        KEY,
        DATE,
        T.StructField("risk_score", T.FloatType()),
        *[T.StructField(f"anomaly_{n}", T.BooleanType()) for n in THRESHOLD_NAMES],
        *[T.StructField(f"threshold_{n}", T.FloatType()) for n in THRESHOLD_NAMES],
        T.StructField("scores_if", T.FloatType()),
        T.StructField("scores_z", T.FloatType()),
        T.StructField("scores_cp", T.FloatType()),
        T.StructField("top_drivers", DRIVERS),
        T.StructField("data_quality_flags", T.StringType()),
        T.StructField("gpr_is_stale", T.BooleanType()),
        T.StructField("model_version", T.StringType()),
    ]
)
