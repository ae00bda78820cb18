"""Projections, joins on the date spine, feature sets, quality gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import scalar as C
from panelwatch.operators import aggregates as A
from panelwatch.operators import quality as G
from panelwatch.operators import spine as J
from panelwatch.operators.series import Series, forward_fill
from panelwatch.plans.features import build_features
from panelwatch.queries import panels as P
from panelwatch.queries import sqltext as Q
from panelwatch.queries.registry import query, r6, r6_sql, staged, text, with_
from panelwatch.session import settle
from panelwatch.sources import landing as L

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
D = "CAST(date AS VARCHAR) AS date"


@staged("shipments")
def shipments(spark, sf):
    return P.shipments(spark, sf)


@staged("features")
def features(spark, sf):
    """The feature table of the regional market; each fact table is read once."""
    shipped = shipments(spark, sf)
    return build_features(P.prices_of(shipped), P.macro(spark, sf), P.geo_of(shipped), P.FLOOR)


@query(
    "series_pivot",
    with_(P.ORD)
    + f"""
SELECT {D}, {", ".join(f"max(CASE WHEN series_key = '{p}' THEN value END) AS p{p[0]}" for p in PRIORITIES)}
FROM ord GROUP BY date""",
)
def series_pivot(spark, sf):
    wide = L.widen(P.ord_(spark, sf), PRIORITIES, "series_key", "value", keys=())
    return wide.select(text(), *[F.col(f"`{p}`").alias(f"p{p[0]}") for p in PRIORITIES])


@query(
    "lookback_slice",
    with_(P.SHIP)
    + f"""
SELECT 'recent' AS part, series_key, {D}, value FROM ship WHERE date > DATE '2001-06-25' AND date <= DATE '2001-06-30'
UNION ALL
SELECT 'history', series_key, {D}, value FROM ship WHERE date >= DATE '2001-01-01'""",
)
def lookback_slice(spark, sf):
    """The daily look-back beside the history from a fixed start."""
    daily = P.ship(spark, sf)
    recent = L.look_back(daily, "2001-06-30", backfill=False)
    since = L.look_back(daily, "2001-06-30", backfill=True, start="2001-01-01")
    both = recent.withColumn("part", F.lit("recent")).unionByName(since.withColumn("part", F.lit("history")))
    return both.select("part", "series_key", text(), "value")


@query(
    "clip_mask_coalesce",
    with_(P.SHIP, "x AS (SELECT *, value - 100000 AS v FROM ship)")
    + f"""
SELECT series_key, {D}, round(CASE WHEN v < 1e-6 THEN 1e-6 ELSE v END, 6) AS clipped,
       round(CASE WHEN v > 1e-6 THEN v END, 6) AS kept, {r6_sql('least(v / 50000.0::DOUBLE, 5.0::DOUBLE) / 5.0::DOUBLE', 'scaled')},
       round(coalesce(CASE WHEN v > 1e-6 THEN v END, value), 6) AS first_of FROM x""",
)
def clip_mask_coalesce(spark, sf):
    x = P.ship(spark, sf).withColumn("v", F.col("value") - 100000)
    return x.select(
        "series_key",
        text(),
        F.round(C.clip_lower("v"), 6).alias("clipped"),
        F.round(C.keep_above("v"), 6).alias("kept"),
        r6(C.clip_upper_scaled(F.col("v") / F.lit(50000.0)), "scaled"),
        F.round(F.coalesce(C.keep_above("v"), F.col("value")), 6).alias("first_of"),
    )


@query(
    "spread_ratio",
    with_(P.MARKET)
    + f"""
SELECT series_key, {D}, {r6_sql('bz - cl', 'spread')}, {r6_sql('xle / nullif(bz, 0)', 'ratio')}, cl AS level FROM shipments""",
)
def spread_ratio(spark, sf):
    x = P.shipments(spark, sf)
    return x.select(
        "series_key",
        text(),
        r6(F.col("`BZ=F`") - F.col("`CL=F`"), "spread"),
        r6(C.ratio("XLE", F.col("`BZ=F`")), "ratio"),
        F.col("`CL=F`").alias("level"),
    )


@query(
    "staleness_decay",
    with_(
        P.ORD,
        "s AS (SELECT series_key, datediff('day', max(date), DATE '2001-08-09') AS days FROM ord GROUP BY 1)",
    )
    + f"""
SELECT series_key, CAST(days AS BIGINT) AS gpr_days_stale, days > 10 AS gpr_is_stale, {r6_sql('pow(0.95::DOUBLE, days)', 'weight')} FROM s""",
)
def staleness_decay(spark, sf):
    s = A.staleness(P.ord_(spark, sf), "2001-08-09")
    return s.select(
        "series_key",
        F.col("gpr_days_stale").cast("long").alias("gpr_days_stale"),
        "gpr_is_stale",
        r6(C.staleness_weight("gpr_days_stale"), "weight"),
    )


MEASURES = ("shipped", "units", "ordered")
TWO = (
    P.MARKET.strip()
    + """,
a AS (SELECT series_key, date, bz AS shipped, gpr_ai AS units FROM shipments),
b AS (SELECT series_key, date, yield_curve AS ordered FROM macro)"""
)


def _two(spark, sf):
    a = P.shipments(spark, sf).select("series_key", "date", F.col("`BZ=F`").alias("shipped"), F.col("GPR_AI").alias("units"))
    b = P.macro(spark, sf).select("series_key", "date", F.col("yield_curve").alias("ordered"))
    return a, b


@query(
    "align_ffill",
    with_(TWO, f"""f AS (SELECT series_key, date, {", ".join(f"{Q.ffill(m)} AS {m}" for m in MEASURES)}
  FROM a FULL JOIN b USING (series_key, date))""")
    + f"\nSELECT series_key, {D}, {', '.join(MEASURES)} FROM f WHERE date >= DATE '{P.FLOOR}'",
)
def align_ffill(spark, sf):
    rows = J.align(_two(spark, sf), MEASURES, P.FLOOR)
    return rows.select("series_key", text(), *MEASURES)


@query(
    "reindex_left_ffill",
    with_(TWO)
    + f"""
SELECT a.series_key, CAST(a.date AS VARCHAR) AS date, a.shipped, {Q.ffill('b.ordered', 'a.series_key', 'a.date')} AS ordered
FROM a LEFT JOIN b ON a.series_key = b.series_key AND a.date = b.date""",
)
def reindex_left_ffill(spark, sf):
    a, b = _two(spark, sf)
    out = forward_fill(Series.of(J.reindex(a, b)), ["ordered"]).df
    return out.select("series_key", text(), "shipped", "ordered")


@query(
    "append_new_dates",
    with_(P.SHIP)
    + f"""
SELECT series_key, {D}, CASE WHEN date < DATE '2000-01-01' AND value > 100000 THEN value ELSE value * 2 END AS value FROM ship""",
)
def append_new_dates(spark, sf):
    """Revised values arrive for all dates; dates already present keep theirs."""
    daily = settle(P.ship(spark, sf))
    existing = daily.filter((F.col("date") < "2000-01-01") & (F.col("value") > 100000))
    revised = daily.withColumn("value", F.col("value") * 2)
    return J.append_new(existing, revised).select("series_key", text(), "value")


@query(
    "new_date_keys",
    with_(TWO)
    + f"\nSELECT series_key, {D} FROM (SELECT series_key, date FROM a EXCEPT SELECT series_key, date FROM b)",
)
def new_date_keys(spark, sf):
    a, b = _two(spark, sf)
    return J.new_keys(a, b).select("series_key", text())


SESSIONS = "sessions AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT')"


def sessions(spark, sf):
    orders = P.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return orders.select(F.col("o_orderdate").cast("date").alias("date")).distinct()


CALENDAR = "CASE WHEN series_key = 0 THEN 'none' WHEN series_key % 2 = 0 THEN '2-HIGH' ELSE '1-URGENT' END"


@query(
    "sessions_by_calendar",
    with_(
        P.SHIP,
        f"keyed AS (SELECT *, {CALENDAR} AS calendar FROM ship)",
        """sessions AS (SELECT DISTINCT o_orderpriority AS calendar, CAST(o_orderdate AS DATE) AS date FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND (dayofyear(CAST(o_orderdate AS DATE)) % 3) <> 0)""",
        "asked AS (SELECT DISTINCT calendar, date FROM keyed)",
        """before AS (SELECT a.calendar, a.date, max(s.date) AS previous FROM asked a
  LEFT JOIN sessions s ON s.calendar = a.calendar AND s.date < a.date GROUP BY 1, 2)""",
        """last AS (SELECT k.series_key, (SELECT max(s.date) FROM sessions s WHERE s.calendar = k.calendar AND s.date < DATE '2001-07-01') AS d
  FROM (SELECT DISTINCT series_key, calendar FROM keyed) k)""",
        """due AS (SELECT k.series_key, coalesce(max(CASE WHEN k.date = l.d THEN k.date END), max(k.date)) AS date
  FROM keyed k JOIN last l ON k.series_key = l.series_key WHERE l.d IS NOT NULL GROUP BY 1)""",
    )
    + """
SELECT k.series_key, CAST(k.date AS VARCHAR) AS date, k.calendar, CAST(b.previous AS VARCHAR) AS previous_session,
       d.date IS NOT NULL AS is_due
FROM keyed k JOIN before b ON b.calendar = k.calendar AND b.date = k.date
LEFT JOIN due d ON d.series_key = k.series_key AND d.date = k.date""",
)
def sessions_by_calendar(spark, sf):
    """Each shipping day with the last session before it in its nation's calendar, and the day due in 2001.

    Two calendars miss every third day; the third has no session.
    """
    keyed = settle(P.ship(spark, sf).withColumn("calendar", F.expr(CALENDAR)))
    orders = P.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("calendar"), F.col("o_orderdate").cast("date").alias("date"))
    held = F.col("calendar").isin("1-URGENT", "2-HIGH") & (F.dayofyear("date") % 3 != 0)
    calendar = settle(orders.filter(held).distinct())
    state = J.session_state(calendar, "2001-07-01", keyed)
    due = J.score_date(keyed, state).withColumn("__due", F.lit(True))
    rows = J.session_before(keyed, calendar, ["calendar"]).join(due, ["series_key", "date"], "left")
    return rows.select(
        "series_key", text(), "calendar", text("previous_session"), F.coalesce("__due", F.lit(False)).alias("is_due")
    )


@query(
    "sessions_prev",
    with_(
        P.SHIP,
        SESSIONS,
        "prev AS (SELECT max(date) AS d FROM sessions WHERE date < DATE '2001-07-01')",
        """due AS (SELECT series_key, coalesce(max(CASE WHEN date = (SELECT d FROM prev) THEN date END), max(date)) AS date
  FROM ship GROUP BY 1)""",
    )
    + """
SELECT due.series_key, CAST(due.date AS VARCHAR) AS date, CAST((SELECT d FROM prev) AS VARCHAR) AS previous_session,
       s.date IS NOT NULL AS is_session
FROM due LEFT JOIN sessions s ON due.date = s.date""",
)
def sessions_prev(spark, sf):
    """The date each nation would be scored for, given a calendar."""
    calendar = settle(sessions(spark, sf))  # bounded by the calendar
    previous = J.previous_session(calendar, "2001-07-01")
    due = J.score_date(P.ship(spark, sf), str(previous))
    return J.mark_sessions(due, calendar).select(
        "series_key", text(), F.lit(str(previous)).alias("previous_session"), "is_session"
    )


STATUS = "is_trading_day, data_quality_score, data_quality_flags, gpr_is_stale, CAST(gpr_days_stale AS BIGINT) AS gpr_days_stale"


@query(
    "feature_sets",
    with_(Q.FEATURES_SQL) + f"\nSELECT series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES)}, {STATUS} FROM features",
)
def feature_sets(spark, sf):
    out = features(spark, sf).withColumn("gpr_days_stale", F.col("gpr_days_stale").cast("long"))
    return out.select("series_key", text(), *[r6(f) for f in S.FEATURES], *S.STATUS_COLUMNS)


@query(
    "complete_cases",
    with_(Q.TRAIN_SQL) + f"\nSELECT series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES)} FROM train",
)
def complete_cases(spark, sf):
    return features(spark, sf).dropna(subset=list(S.FEATURES)).select(
        "series_key", text(), *[r6(f) for f in S.FEATURES]
    )


_GAPPED = {"dxy_zscore": ("<=", 1.0), "xle_brent_ratio": (">", 0.05)}


@query(
    "complete_cases_gaps",
    with_(Q.FEATURES_SQL)
    + f"\nSELECT series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES)} FROM features WHERE "
    + " AND ".join([f"{f} IS NOT NULL" for f in S.FEATURES] + [f"{f} {op} {v}" for f, (op, v) in _GAPPED.items()]),
)
def complete_cases_gaps(spark, sf):
    """Features that are missing on some days: these days are not complete."""
    gaps = {f: F.when(F.expr(f"{f} {op} {v}"), F.col(f)) for f, (op, v) in _GAPPED.items()}
    return features(spark, sf).withColumns(gaps).dropna(subset=list(S.FEATURES)).select(
        "series_key", text(), *[r6(f) for f in S.FEATURES]
    )


RECENT = "recent AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS rn FROM features)"


@query(
    "null_rates",
    with_(
        P.MARKET,
        f"""w AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS rn FROM
  (SELECT series_key, date, {", ".join(f"{c}" for c in ("bz", "gpr_ai", "yield_curve", "cpi", "fed_rate"))}
   FROM shipments FULL JOIN macro USING (series_key, date)))""",
    )
    + " UNION ALL ".join(
        f"\nSELECT series_key, '{c}' AS \"column\", {r6_sql(f'avg(({c} IS NULL)::INT)', 'null_rate')} FROM w WHERE rn <= 60 GROUP BY 1"
        for c in ("bz", "gpr_ai", "yield_curve", "cpi", "fed_rate")
    ),
)
def null_rates(spark, sf):
    shipped = P.shipments(spark, sf).select("series_key", "date", F.col("`BZ=F`").alias("bz"), F.col("GPR_AI").alias("gpr_ai"))
    wide = J.outer_align([shipped, P.macro(spark, sf).select("series_key", "date", "yield_curve", "cpi", "fed_rate")])
    rates = A.null_rates(wide, ["bz", "gpr_ai", "yield_curve", "cpi", "fed_rate"])
    return rates.select("series_key", "column", r6("null_rate"))


# -- quality gate -----------------------------------------------------------------

PREV = "2001-11-30"


def _gate_frame(spark, sf):
    """A feature table with a late key, gaps in some columns and a large last move."""
    f = features(spark, sf)
    late = F.col("date") <= "2001-11-01"
    return f.filter((F.col("series_key") != 4) | late).withColumns(
        {
            "hy_spread": F.when(F.col("hy_spread") > 150000, F.col("hy_spread")),
            "ng_ret_1d": F.when((F.col("series_key") != 2) | late, F.col("ng_ret_1d")),
            "brent_ret_1d": F.when((F.col("series_key") != 2) | late, F.col("brent_ret_1d")),
            "wti_ret_1d": F.when((F.col("series_key") != 2) | late, F.col("wti_ret_1d")),
            "gpr_days_stale": F.col("gpr_days_stale") + F.col("series_key") * 4,
        }
    ).drop("cpi_yoy")


_LATE = "(series_key <> 2 OR date <= DATE '2001-11-01')"
_CHANGED = {
    "hy_spread": "CASE WHEN hy_spread > 150000 THEN hy_spread END",
    **{c: f"CASE WHEN {_LATE} THEN {c} END" for c in ("ng_ret_1d", "brent_ret_1d", "wti_ret_1d")},
    "gpr_days_stale": "gpr_days_stale + series_key * 4",
}
def gate_sql(changed: dict[str, str], where: str, missing: str | None) -> str:
    """The findings of a changed feature table that may lack one column."""
    watched = [c for c in (*S.FEATURES, *S.STATUS_COLUMNS) if c != missing]
    nulls = " UNION ALL ".join(
        f"""SELECT series_key, 'WARNING' AS severity, 'NULLS' AS "check",
  'NULLS: {c} is ' || CAST(CAST(round_even(avg(({c} IS NULL)::INT) * 100, 0) AS BIGINT) AS VARCHAR) || '% null in last 60 rows' AS message, {10 + i} AS position
  FROM recent WHERE rn <= 60 GROUP BY 1 HAVING avg(({c} IS NULL)::INT) > 0.05"""
        for i, c in enumerate(watched)
    )
    return (
        Q.FEATURES_SQL
        + f""",
gate AS (SELECT series_key, date, {", ".join(f"{changed.get(c, c)} AS {c}" for c in watched)} FROM features WHERE {where}),
recent AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY date DESC) AS rn FROM gate),
last AS (SELECT * FROM recent WHERE rn = 1),
found AS (
  SELECT series_key, 'CRITICAL' AS severity, 'SCHEMA' AS "check", 'SCHEMA: missing columns [''{missing}'']' AS message, 0 AS position
  FROM last WHERE {str(missing is not None).lower()}
  UNION ALL
  SELECT series_key, 'CRITICAL', 'GAP', 'GAP: last date is ' || CAST(date AS VARCHAR) || ', expected {PREV}', 1
  FROM last WHERE datediff('day', date, DATE '{PREV}') > 1
  UNION ALL
  SELECT series_key, 'CRITICAL', 'CROSS_SOURCE',
         'CROSS_SOURCE: Brent moved ' || printf('%.1f', round_even(abs(brent_ret_1d) * 100, 1)) || '% but vol indices flat', 2
  FROM last WHERE abs(brent_ret_1d) > 0.10 AND abs(ovx_zscore) < 1 AND abs(vix_zscore) < 1
  UNION ALL
  SELECT series_key, 'WARNING', 'GPR_STALE', 'GPR_STALE: ' || CAST(gpr_days_stale AS VARCHAR) || ' days stale — OVX fallback active', 3
  FROM last WHERE gpr_days_stale > 10
  UNION ALL {nulls}
  UNION ALL
  SELECT series_key, 'WARNING', 'SOURCE_MISSING', 'SOURCE_MISSING: all price features null today', 99
  FROM last WHERE brent_ret_1d IS NULL AND wti_ret_1d IS NULL AND ng_ret_1d IS NULL
)"""
    )


GATE_SQL = gate_sql(_CHANGED, "series_key <> 4 OR date <= DATE '2001-11-01'", "cpi_yoy")


def _previous(spark):
    import datetime

    return datetime.date.fromisoformat(PREV)


@query("quality_findings", with_(GATE_SQL) + '\nSELECT series_key, severity, "check", message FROM found')
def quality_findings(spark, sf):
    found = G.findings(settle(_gate_frame(spark, sf)), _previous(spark), True)
    return found.select("series_key", "severity", "check", "message")


# The last move large for some keys, calm or not; one day in ten, or in thirty, without a value.
_MOVED = {
    "brent_ret_1d": "CASE WHEN series_key <> 0 THEN 0.11 + series_key / 1000.0 ELSE 0.09 END",
    "ovx_zscore": "CASE WHEN series_key <> 1 THEN 0.5 ELSE 1.5 END",
    "vix_zscore": "CASE WHEN series_key <> 2 THEN -0.5 END",
    "hy_spread": "CASE WHEN datediff(DATE '2002-01-01', date) % 10 <> series_key THEN hy_spread END",
    "fed_rate": "CASE WHEN datediff(DATE '2002-01-01', date) % 30 <> 0 THEN fed_rate END",
}


@query(
    "quality_findings_moves",
    with_(gate_sql({c: x.replace("datediff(DATE '2002-01-01', date)", "datediff('day', date, DATE '2002-01-01')") + "::DOUBLE" for c, x in _MOVED.items()}, "true", None))
    + '\nSELECT series_key, severity, "check", message FROM found',
)
def quality_findings_moves(spark, sf):
    """Large moves beside calm, lively and missing volatility; columns with many and with few nulls."""
    frame = features(spark, sf).withColumns({c: F.expr(x).cast("double") for c, x in _MOVED.items()})
    found = G.findings(settle(frame), _previous(spark), True)
    return found.select("series_key", "severity", "check", "message")


@query(
    "quality_stamp",
    with_(
        GATE_SQL,
        """q AS (SELECT series_key, greatest(0.0::DOUBLE, 1.0::DOUBLE - count(*) * 0.1::DOUBLE) AS score,
  string_agg(message, '|' ORDER BY position) AS flags FROM found WHERE severity = 'WARNING' GROUP BY 1)""",
    )
    + f"""
SELECT g.series_key, CAST(g.date AS VARCHAR) AS date, {r6_sql('coalesce(q.score, 1.0::DOUBLE)', 'data_quality_score')},
       coalesce(q.flags, '') AS data_quality_flags, true AS is_trading_day
FROM gate g LEFT JOIN q ON g.series_key = q.series_key""",
)
def quality_stamp(spark, sf):
    frame = settle(_gate_frame(spark, sf))
    out = G.stamp(frame, G.findings(frame, _previous(spark), True), True)
    return out.select("series_key", text(), r6("data_quality_score"), "data_quality_flags", "is_trading_day")
