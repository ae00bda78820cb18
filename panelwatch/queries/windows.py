"""Row-count windows: W1-W10, and the rolling-threshold flagship."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import rolling as R
from panelwatch.operators import series as X
from panelwatch.operators.series import Series
from panelwatch.queries import sqltext as Q
from panelwatch.queries.panels import EVT, EVT_ORDER, ORD, SHIP, evt, ord_, ship
from panelwatch.queries.registry import query, r6, r6_sql, text, with_


def day():
    return W.partitionBy("series_key").orderBy("date")


EVENT_ID = ("series_key", "event_id")


def events(spark, sf, lookback: int, rows_per_chunk: int = X.ROWS_PER_CHUNK) -> Series:
    return Series.split(evt(spark, sf), ["series_key"], "ts", lookback, rows_per_chunk, tie=["event_id"])


@query(
    "zscore_anomalies",
    with_(
        SHIP,
        f"zed AS (SELECT *, {Q.zscore('value')} AS z FROM ship)",
        f"thr AS (SELECT *, {Q.quantile('z', 63)} AS threshold FROM zed)",
    )
    + f"""
SELECT series_key, CAST(date AS VARCHAR) AS date, value, {r6_sql('z', 'z')}, {r6_sql('threshold', 'threshold')},
       coalesce(z > threshold, false) AS anomaly FROM thr""",
)
def zscore_anomalies(spark, sf):
    """Shipped value per nation and day: rolling z, rolling 95 % threshold, flag."""
    z = X.rolling_zscores(Series.of(ship(spark, sf)), ["value"], ["z"])
    out = X.rolling_quantiles(z, "z", {"threshold": 63}).df
    return out.select(
        "series_key",
        text(),
        "value",
        r6("z"),
        r6("threshold"),
        F.coalesce(F.col("z") > F.col("threshold"), F.lit(False)).alias("anomaly"),
    )


@query(
    "log_returns",
    with_(SHIP)
    + f"""
SELECT series_key, CAST(date AS VARCHAR) AS date, {r6_sql(Q.log_return('value', 1), 'ret_1d')},
       {r6_sql(Q.log_return('value', 5), 'ret_5d')} FROM ship""",
)
def log_returns(spark, sf):
    return ship(spark, sf).select(
        "series_key", text(), r6(R.log_return("value", 1, day()), "ret_1d"), r6(R.log_return("value", 5, day()), "ret_5d")
    )


@query(
    "diff_n",
    with_(ORD)
    + f"""
SELECT series_key, CAST(date AS VARCHAR) AS date, {r6_sql('value - ' + Q.lag('value', 5), 'diff_5')},
       {r6_sql('value - ' + Q.lag('value', 20), 'diff_20')} FROM ord""",
)
def diff_n(spark, sf):
    return ord_(spark, sf).select(
        "series_key", text(), r6(R.diff("value", 5, day()), "diff_5"), r6(R.diff("value", 20, day()), "diff_20")
    )


SPARSE = "sparse AS (SELECT series_key, date, CASE WHEN value > 300000 THEN value END AS value FROM ord)"


@query(
    "pct_change_compact",
    with_(
        ORD,
        SPARSE,
        f"own AS (SELECT series_key, date, (value / nullif({Q.lag('value', 12)}, 0) - 1.0::DOUBLE) * 100.0::DOUBLE AS pct"
        " FROM sparse WHERE value IS NOT NULL)",
    )
    + f"""
SELECT s.series_key, CAST(s.date AS VARCHAR) AS date, {r6_sql(Q.ffill('o.pct', 's.series_key', 's.date'), 'pct')}
FROM sparse s LEFT JOIN own o ON s.series_key = o.series_key AND s.date = o.date""",
)
def pct_change_compact(spark, sf):
    """Change over 12 non-null rows, carried forward over the full spine."""
    sparse = ord_(spark, sf).withColumn("value", F.when(F.col("value") > 300000, F.col("value")))
    own = sparse.withColumn("pct", R.pct_change("value", 12, X.non_null_window("value")))
    return own.select("series_key", text(), r6(R.ffill("pct", day()), "pct"))


@query(
    "rolling_std_20",
    with_(SHIP, f"r AS (SELECT *, {Q.log_return('value', 1)} AS ret FROM ship)")
    + f"""
SELECT series_key, CAST(date AS VARCHAR) AS date, {r6_sql(Q.std('ret', 20), 'vol')} FROM r""",
)
def rolling_std_20(spark, sf):
    r = ship(spark, sf).withColumn("ret", R.log_return("value", 1, day()))
    return r.select("series_key", text(), r6(R.rolling_std("ret", 20, day()), "vol"))


@query(
    "rolling_mean_60",
    with_(EVT)
    + f"""
SELECT series_key, event_id, {r6_sql(Q.guard('value', 60, 'avg(value) ' + Q.over(rows=60, **EVT_ORDER), None, **EVT_ORDER), 'mean')} FROM evt""",
)
def rolling_mean_60(spark, sf):
    s = events(spark, sf, 59).with_columns(lambda w: {"mean": R.rolling_mean("value", 60, w)})
    return s.body().select(*EVENT_ID, r6("mean"))


@query(
    "rolling_z_60",
    with_(EVT) + f"\nSELECT series_key, event_id, {r6_sql(Q.zscore('value', 60, None, **EVT_ORDER), 'z')} FROM evt",
)
def rolling_z_60(spark, sf):
    return X.rolling_zscores(events(spark, sf, 59), ["value"], ["z"]).body().select(*EVENT_ID, r6("z"))


@query(
    "rolling_z_floor",
    with_(EVT, "f AS (SELECT *, CASE WHEN value > 100 THEN 100.0::DOUBLE ELSE value END AS capped FROM evt)")
    + f"\nSELECT series_key, event_id, {r6_sql(Q.zscore('capped', 60, '1e-6', **EVT_ORDER), 'z')} FROM f",
)
def rolling_z_floor(spark, sf):
    capped = F.when(F.col("value") > 100, F.lit(100.0)).otherwise(F.col("value"))
    s = events(spark, sf, 59)
    s = s._with(s.df.withColumn("capped", capped))
    return X.rolling_zscores(s, ["capped"], ["z"], floor=S.SIGMA_FLOOR).body().select(*EVENT_ID, r6("z"))


FLAT = "f AS (SELECT *, least(value, 1.0::DOUBLE) + (event_id // 500 % 2) * (event_id % 2) * 1e-7::DOUBLE AS flat FROM evt)"


@query(
    "rolling_z_floor_flat",
    with_(EVT, FLAT) + f"\nSELECT series_key, event_id, {r6_sql(Q.zscore('flat', 60, '1e-6', **EVT_ORDER), 'z')} FROM f",
)
def rolling_z_floor_flat(spark, sf):
    """Values that hardly move: most frames are constant or spread less than the floor."""
    flat = F.expr("least(value, 1.0d) + (floor(event_id / 500) % 2) * (event_id % 2) * 1e-7d")
    s = events(spark, sf, 59)
    s = s._with(s.df.withColumn("flat", flat))
    return X.rolling_zscores(s, ["flat"], ["z"], floor=S.SIGMA_FLOOR).body().select(*EVENT_ID, r6("z"))


@query(
    "rolling_q95",
    with_(EVT)
    + "\nSELECT series_key, event_id, "
    + ", ".join(r6_sql(Q.quantile("value", n, 0.95, **EVT_ORDER), f"q_{k}") for k, n in S.ROLLING_WINDOWS.items())
    + " FROM evt",
)
def rolling_q95(spark, sf):
    names = {f"q_{k}": n for k, n in S.ROLLING_WINDOWS.items()}
    s = X.rolling_quantiles(events(spark, sf, max(names.values()) - 1), "value", names)
    return s.body().select(*EVENT_ID, *[r6(c) for c in names])


@query(
    "rolling_q95_short",
    with_(SHIP)
    + f"\nSELECT series_key, CAST(date AS VARCHAR) AS date, {r6_sql(Q.quantile('value', 63), 'q_qtr')} FROM ship",
)
def rolling_q95_short(spark, sf):
    """The same as a plain window expression, for one short frame."""
    return ship(spark, sf).select(
        "series_key", text(), r6(R.rolling_quantile("value", 63, 0.95, day()), "q_qtr")
    )


ONE = "one AS (SELECT 'all' AS series_key, ts, event_id, value FROM events)"


@query(
    "rolling_std_halo",
    with_(ONE) + f"\nSELECT event_id, {r6_sql(Q.std('value', 60, **EVT_ORDER), 'std')} FROM one",
)
def rolling_std_halo(spark, sf):
    """All events as a single series, cut into chunks with a halo."""
    one = evt(spark, sf).withColumn("series_key", F.lit("all"))
    s = Series.split(one, ["series_key"], "ts", 59, rows_per_chunk=2_000, tie=["event_id"])
    return s.with_columns(lambda w: {"std": R.rolling_std("value", 60, w)}).body().select("event_id", r6("std"))


TIED = "tied AS (SELECT 'all' AS series_key, CAST(ts AS DATE) AS ts, event_id, value FROM events)"


@query(
    "rolling_std_ties",
    with_(TIED) + f"\nSELECT event_id, {r6_sql(Q.std('value', 60, **EVT_ORDER), 'std')} FROM tied",
)
def rolling_std_ties(spark, sf):
    """One series in chunks that cut through days, whose rows all share an order value."""
    tied = evt(spark, sf).withColumns({"series_key": F.lit("all"), "ts": F.col("ts").cast("date")})
    s = Series.split(tied, ["series_key"], "ts", 59, rows_per_chunk=500, tie=["event_id"])
    return s.with_columns(lambda w: {"std": R.rolling_std("value", 60, w)}).body().select("event_id", r6("std"))


HOLED = """
holed AS (SELECT nullif(event_type, (SELECT min(event_type) FROM events)) AS series_key,
                 CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, event_id, value FROM events)"""


@query(
    "rolling_std_nulls",
    with_(HOLED)
    + f"\nSELECT event_id, {r6_sql(Q.std('value', 60, part='series_key', order='ts NULLS FIRST, event_id'), 'std')} FROM holed",
)
def rolling_std_nulls(spark, sf):
    """Null keys are a series and null order values come first in theirs, also when cut."""
    rows = evt(spark, sf)
    least = rows.agg(F.min("series_key")).first()[0]
    holed = rows.withColumns(
        {
            "series_key": F.when(F.col("series_key") != F.lit(least), F.col("series_key")),
            "ts": F.when(F.col("event_id") % 7 != 0, F.col("ts")),
        }
    )
    s = Series.split(holed, ["series_key"], "ts", 59, rows_per_chunk=500, tie=["event_id"])
    return s.with_columns(lambda w: {"std": R.rolling_std("value", 60, w)}).body().select("event_id", r6("std"))


GAPS = "gaps AS (SELECT 'all' AS series_key, ts, event_id, CASE WHEN value > 200 THEN value END AS value FROM events)"


@query(
    "forward_fill_halo",
    with_(GAPS) + f"\nSELECT event_id, {Q.ffill('value', **EVT_ORDER)} AS value FROM gaps",
)
def forward_fill_halo(spark, sf):
    """Forward fill across chunks of one series, however far back the last value lies."""
    gaps = evt(spark, sf).select(
        F.lit("all").alias("series_key"), "ts", "event_id", F.when(F.col("value") > 200, F.col("value")).alias("value")
    )
    s = Series.split(gaps, ["series_key"], "ts", 1, rows_per_chunk=2_000, tie=["event_id"])
    return X.forward_fill(s, ["value"]).body().select("event_id", "value")


@query(
    "last_n_rows",
    with_(EVT, "r AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts DESC) AS rn FROM evt)")
    + "\nSELECT series_key, event_id, value FROM r WHERE rn <= 60",
)
def last_n_rows(spark, sf):
    return X.last_rows(evt(spark, sf), 60, order="ts").select("series_key", "event_id", "value")


@query(
    "latest_row",
    with_(EVT, "r AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ts DESC) AS rn FROM evt)")
    + "\nSELECT series_key, event_id, value FROM r WHERE rn = 1",
)
def latest_row(spark, sf):
    return X.latest_row(evt(spark, sf), order="ts").select("series_key", "event_id", "value")
