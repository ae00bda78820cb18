"""Sources and sinks: each query writes to the shared folder and reads back."""

from __future__ import annotations

import datetime

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.operators import aggregates as A
from panelwatch.operators import quality as Quality
from panelwatch.operators import signals as G
from panelwatch.plans import daily
from panelwatch.queries import panels as P
from panelwatch.queries import sqltext as Q
from panelwatch.queries.registry import query, r6, r6_sql, staged, text, with_
from panelwatch.queries.scoring import scored
from panelwatch.queries.shapes import features
from panelwatch.session import scratch_path, settle
from panelwatch.sources import landing as L
from panelwatch.sources import scores as K

D = "CAST(date AS VARCHAR) AS date"
PANEL = T.StructType(
    [T.StructField("series_key", T.StringType()), T.StructField("date", T.DateType()), T.StructField("value", T.DoubleType())]
)


@query(
    "snapshot_roundtrip",
    with_(P.ORD)
    + f"""
SELECT 'rerun' AS snapshot, series_key, {D}, value * 2 AS value FROM ord
UNION ALL SELECT 'old', series_key, {D}, value FROM ord WHERE date < DATE '2000-01-01'
UNION ALL SELECT 'newest', series_key, {D}, value * 2 FROM ord
UNION ALL SELECT 'merged', series_key, {D}, value * CASE WHEN date >= DATE '2001-01-01' THEN 3 ELSE 2 END FROM ord""",
)
def snapshot_roundtrip(spark, sf):
    """Two run dates, the second landed twice; one snapshot, a missing one, and all as history.

    Then the history through the current table: merged, a third run landed and merged, which
    has the last months only.
    """
    root = scratch_path(spark, "landed")
    orders = settle(P.ord_(spark, sf))
    L.write_snapshot(orders.filter(F.col("date") < "2000-01-01"), root, "orders", "2001-08-01")
    L.write_snapshot(orders, root, "orders", "2001-08-02")
    L.write_snapshot(orders.withColumn("value", F.col("value") * 2), root, "orders", "2001-08-02")
    L.write_snapshot(orders.limit(0), root, "orders", "2001-08-03")

    def one(name, df):
        return df.select(F.lit(name).alias("snapshot"), "series_key", text(), "value")

    def snap(day):
        return L.read_snapshot(spark, root, "orders", PANEL, day)

    ids = ["series_key", "date"]
    whole = settle(L.read_history(spark, root, "orders", PANEL, ids))
    L.merge_landed(spark, root, "orders", PANEL, ids)
    late = orders.filter(F.col("date") >= "2001-01-01").withColumn("value", F.col("value") * 3)
    L.write_snapshot(late, root, "orders", "2001-08-04")
    L.merge_landed(spark, root, "orders", PANEL, ids)
    return (
        one("rerun", snap("2001-08-02"))
        .unionByName(one("old", snap("2001-08-01")))
        .unionByName(one("missing", snap("2001-08-03")))
        .unionByName(one("newest", whole))
        .unionByName(one("merged", L.read_history(spark, root, "orders", PANEL, ids)))
    )


@query(
    "csv_source",
    with_(P.ORD, "g AS (SELECT date, sum(CAST(value AS DECIMAL(18,2))) AS v, count(*) AS n FROM ord GROUP BY 1)")
    + f"""
SELECT {D}, round(CAST(v AS DOUBLE), 2) AS "GPR_AI", CAST(n AS DOUBLE) AS "GPR_OIL",
       CAST(datediff('day', (SELECT max(date) FROM g), DATE '2001-08-20') AS BIGINT) AS gpr_days_stale,
       datediff('day', (SELECT max(date) FROM g), DATE '2001-08-20') > 10 AS gpr_is_stale
FROM g""",
)
def csv_source(spark, sf):
    """A daily index written as CSV and read through the CSV source."""
    path = scratch_path(spark, "geo")
    daily = P.ord_(spark, sf).groupBy(F.date_format("date", "yyyy-MM-dd").alias("Date")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("GPR_AI"), F.count(F.lit(1)).alias("GPR_OIL")
    )
    daily.write.option("header", True).csv(path)
    geo = L.read_geo_csv(spark, path, "2001-08-20")
    return geo.select(
        text(),
        F.round("GPR_AI", 2).alias("GPR_AI"),
        "GPR_OIL",
        F.col("gpr_days_stale").cast("long").alias("gpr_days_stale"),
        "gpr_is_stale",
    )


BAD_DAYS = """g AS (SELECT date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v, count(*) AS n FROM ord GROUP BY 1),
cells AS (SELECT CASE WHEN extract('day' FROM date) = 31 THEN 'day ' || CAST(date AS VARCHAR) ELSE CAST(date AS VARCHAR) END AS "Date",
  CASE WHEN extract('day' FROM date) IN (7, 31) THEN 'n/a' WHEN extract('day' FROM date) = 8 THEN 'NaN' ELSE 'v' END AS kind,
  CASE WHEN extract('day' FROM date) = 9 THEN NULL ELSE n END AS n, v, extract('day' FROM date) AS d FROM g)"""


@query(
    "csv_rejects",
    with_(P.ORD, BAD_DAYS)
    + """
SELECT 'kept' AS part, "Date" AS date, CASE WHEN kind = 'v' THEN round(v, 2) + 0.0 END AS "GPR_AI", CAST(n AS DOUBLE) AS "GPR_OIL", NULL AS reasons
FROM cells WHERE d NOT IN (7, 31)
UNION ALL
SELECT 'rejected', "Date", NULL, CAST(n AS DOUBLE), CASE WHEN d = 31 THEN 'Date,GPR_AI' ELSE 'GPR_AI' END
FROM cells WHERE d IN (7, 31)""",
)
def csv_rejects(spark, sf):
    """A daily index as CSV with bad dates and numbers, NaN and empty cells: the rows that are read, and those that are kept aside."""
    path, aside = scratch_path(spark, "geo"), scratch_path(spark, "rejects")
    day = F.dayofmonth("date")
    daily = P.ord_(spark, sf).groupBy("date").agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("v"), F.count(F.lit(1)).alias("n"))
    daily.select(
        F.when(day == 31, F.concat(F.lit("day "), text())).otherwise(text()).alias("Date"),
        F.when(day.isin(7, 31), "n/a").when(day == 8, "NaN").otherwise(F.col("v").cast("string")).alias("GPR_AI"),
        F.when(day != 9, F.col("n").cast("string")).alias("GPR_OIL"),
    ).write.option("header", True).csv(path)
    kept = L.read_geo_csv(spark, path, "2001-08-20", rejects=aside, limit=0.2)
    rejected = L.read_rejects(spark, aside)
    number = F.lit(None).cast("double")
    return kept.select(
        F.lit("kept").alias("part"), text(), r6(F.round("GPR_AI", 2), "GPR_AI"), "GPR_OIL", F.lit(None).cast("string").alias("reasons")
    ).unionByName(
        rejected.select(
            F.lit("rejected").alias("part"),
            F.col("Date").alias("date"),
            number.alias("GPR_AI"),
            F.col("GPR_OIL").cast("double").alias("GPR_OIL"),
            F.array_join("__faults", ",").alias("reasons"),
        )
    )


def stored_scores(spark, sf):
    """The scored panel after a trip through the score table."""
    rows = G.attribute(scored(spark, sf), S.FEATURES)
    path = scratch_path(spark, "scores")
    K.upsert_scores(spark, path, rows.withColumn("model_version", F.lit("v1")))
    return K.read_scores(spark, path)


kept_scores = staged("scores")(stored_scores)


SCORE_COLUMNS = ["risk_score", "scores_if", "scores_z", *[f"threshold_{k}" for k in S.THRESHOLD_NAMES]]
FLAG_COLUMNS = [f"anomaly_{k}" for k in S.THRESHOLD_NAMES]


@query(
    "score_table",
    with_(Q.SCORES_SQL)
    + f"""
SELECT CAST(series_key AS VARCHAR) AS series_key, {D}, {', '.join(r6_sql(f'CAST({c} AS DOUBLE)', c) for c in SCORE_COLUMNS)},
       {', '.join(FLAG_COLUMNS)}, 'v1' AS model_version FROM scores""",
)
def score_table(spark, sf):
    return stored_scores(spark, sf).select(
        "series_key", text(), *[r6(F.col(c).cast("double"), c) for c in SCORE_COLUMNS], *FLAG_COLUMNS, "model_version"
    )


@query(
    "score_upsert",
    with_(P.ORD)
    + f"""
SELECT series_key, {D}, {r6_sql('CAST(CAST(value * CASE WHEN date >= DATE $$2001-01-01$$ THEN 2 ELSE 1 END AS FLOAT) AS DOUBLE)'.replace('$$', "'"), 'risk_score')},
       CASE WHEN date >= DATE '2001-01-01' THEN 'v2' ELSE 'v1' END AS model_version,
       CASE WHEN date >= DATE '2001-01-01' THEN 7.0::DOUBLE END AS threshold_qtr
FROM ord""",
)
def score_upsert(spark, sf):
    """A backfill under an older schema, then a batch with a later column, upserted twice."""
    path = scratch_path(spark, "scores")
    orders = settle(P.ord_(spark, sf)).withColumnRenamed("value", "risk_score")
    later = [f for f in S.SCORE_TABLE.fields if f.name.startswith("threshold_")]
    old_schema = T.StructType([f for f in S.SCORE_TABLE.fields if f not in later])
    K.upsert_scores(spark, path, K.rows_to_write(orders.withColumn("model_version", F.lit("v1")), "2001-12-31", True), old_schema)
    batch = orders.filter(F.col("date") >= "2001-01-01").select(
        "series_key",
        "date",
        (F.col("risk_score") * 2).alias("risk_score"),
        F.lit("v2").alias("model_version"),
        F.lit(7.0).alias("threshold_qtr"),
    )
    for _ in range(2):
        K.upsert_scores(spark, path, batch)
    return K.read_scores(spark, path).select(
        "series_key",
        text(),
        r6(F.col("risk_score").cast("double"), "risk_score"),
        "model_version",
        F.col("threshold_qtr").cast("double").alias("threshold_qtr"),
    )


@query(
    "latest_only_write",
    with_(
        P.ORD,
        "due AS (SELECT series_key, coalesce(max(CASE WHEN date = DATE '2001-07-15' THEN date END), max(date)) AS date FROM ord GROUP BY 1)",
    )
    + """
SELECT o.series_key, CAST(o.date AS VARCHAR) AS date, o.value FROM ord o JOIN due d ON o.series_key = d.series_key AND o.date = d.date""",
)
def latest_only_write(spark, sf):
    return K.rows_to_write(settle(P.ord_(spark, sf)), "2001-07-15", False).select("series_key", text(), "value")


@query(
    "feature_table_append",
    with_(Q.FEATURES_SQL)
    + f"\nSELECT CAST(series_key AS VARCHAR) AS series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES)} FROM features",
)
def feature_table_append(spark, sf):
    """A table stopped in mid-month, then all dates offered again: old rows stay, new come."""
    path = scratch_path(spark, "features")
    whole = features(spark, sf)
    schema = T.StructType([f if f.name != "series_key" else whole.schema["series_key"] for f in S.FEATURE_TABLE.fields])
    L.write_features(whole.filter(F.col("date") <= "2001-05-17"), path)
    L.append_features(spark, whole, path, schema)
    return L.read_features(spark, path, schema).select(
        F.col("series_key").cast("string").alias("series_key"), text(), *[r6(f) for f in S.FEATURES]
    )


@query(
    "driver_texts",
    with_(Q.SCORES_SQL)
    + f"\nSELECT series_key, {D}, CAST(place AS BIGINT) AS place, feature, {r6_sql('weight', 'weight')} FROM drivers",
)
def driver_texts(spark, sf):
    """Top drivers stored as two JSON texts and read back, as older score tables hold them."""
    path = scratch_path(spark, "drivers")
    names, weights = K.drivers_to_text(F.col("top_drivers"))
    G.attribute(scored(spark, sf), S.FEATURES).select("series_key", "date", names.alias("names"), weights.alias("weights")).write.parquet(path)
    read = spark.read.parquet(path).withColumn("d", K.drivers_from_text(F.col("names"), F.col("weights")))
    return read.select("series_key", text(), F.posexplode("d").alias("at", "d")).select(
        "series_key", "date", (F.col("at") + 1).cast("long").alias("place"), "d.feature", r6(F.col("d.weight"), "weight")
    )


LATE = "2001-12-20"


@query(
    "findings_stored",
    with_(P.ORD)
    + f"""
SELECT series_key, 'CRITICAL' AS severity, 'GAP' AS "check",
       'GAP: last date is ' || max(date) || ', expected {LATE}' AS message
FROM ord GROUP BY 1 HAVING datediff('day', max(date), DATE '{LATE}') > 1""",
)
def findings_stored(spark, sf):
    """Critical findings of a halted gate, read back from where they were kept."""
    path = scratch_path(spark, "findings")
    panel = P.ord_(spark, sf).withColumn("series_key", F.col("series_key").cast("string"))
    found = Quality.findings(settle(panel), datetime.date.fromisoformat(LATE), True, expected=["series_key", "date", "value"])
    try:
        Quality.enforce(found.filter("check = 'GAP'"), path)
    except Quality.GateFailed:
        pass
    schema = "series_key string, severity string, `check` string, message string, position int"
    return L.read_parquet(spark, path, T.StructType.fromDDL(schema)).select("series_key", "severity", "check", "message")


LAST_OLD = "2001-05-17"


def landed_sources(spark, sf):
    """The regional market as the three long sources."""
    shipped, orders = settle(P.shipments(spark, sf)), settle(P.macro(spark, sf))
    key = F.col("series_key").cast("string").alias("series_key")

    def long(wide, names, name, value):
        cells = F.explode(F.array(*[F.struct(F.lit(n).alias(name), F.col(f"`{n}`").cast("double").alias(value)) for n in names]))
        return wide.select(key, "date", cells.alias("c")).select("series_key", "date", f"c.{name}", f"c.{value}")

    return {
        "prices": long(shipped, S.TICKERS, "ticker", "close"),
        "macro": long(orders, S.MACRO_SERIES, "series", "value"),
        "geo": shipped.filter(F.col("GPR_AI").isNotNull()).select(
            key, "date", F.col("GPR_AI").cast("double"), F.col("GPR_OIL").cast("double")
        ),
    }


@query(
    "incremental_features",
    with_(Q.FEATURES_SQL)
    + f"""
SELECT CAST(series_key AS VARCHAR) AS series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES if f != 'geo_signal')},
       CASE WHEN date > DATE '{LAST_OLD}' THEN round(geo_signal, 6) + 0.0 END AS geo_signal FROM features""",
)
def incremental_features(spark, sf):
    """The feature table built up to a date, then the later dates added from their halo.

    Stored days keep the staleness weight of their own run, so their geo signal is not compared.
    """
    t = daily.Tables(scratch_path(spark, "job"))
    sources = landed_sources(spark, sf)
    for run, since in ((LAST_OLD, None), (P.AS_OF, "2001-05-18")):
        for name, rows in sources.items():
            known = rows if since else rows.filter(F.col("date") <= run)
            L.write_snapshot(known, t.landed, name, run)
        daily.update_features(spark, t, run, P.FLOOR, since, halo_days=200)
    new = F.col("date") > LAST_OLD
    return L.read_features(spark, t.features).select(
        "series_key",
        text(),
        *[r6(f) for f in S.FEATURES if f != "geo_signal"],
        F.when(new, r6("geo_signal")).alias("geo_signal"),
    )


NEVER = "2100-01-01"


@query(
    "quality_zero_rows",
    with_(P.ORD)
    + f"""
SELECT CAST(NULL AS VARCHAR) AS series_key, 'CRITICAL' AS severity, 'SCHEMA' AS "check", 'SCHEMA: missing columns [''close'']' AS message
UNION ALL SELECT NULL, 'CRITICAL', 'COMPLETENESS', 'COMPLETENESS: zero rows' WHERE NOT EXISTS (SELECT 1 FROM ord WHERE date > DATE '{NEVER}')""",
)
def quality_zero_rows(spark, sf):
    """A table without rows: the checks of the whole frame speak under a null key."""
    panel = P.ord_(spark, sf).withColumn("series_key", F.col("series_key").cast("string")).filter(F.col("date") > NEVER)
    found = Quality.findings(settle(panel), datetime.date.fromisoformat(LATE), True, expected=["series_key", "date", "value", "close"])
    return found.select("series_key", "severity", "check", "message")


@query(
    "empty_source_keeps",
    with_(P.ORD) + f"\nSELECT 'empty' AS source, series_key, {D}, value FROM ord UNION ALL SELECT 'landed', series_key, {D}, value * 2 FROM ord",
)
def empty_source_keeps(spark, sf):
    """The table stays if the source is empty, and gives way to a source with rows."""
    old = settle(P.ord_(spark, sf))
    sources = {"empty": old.filter(F.col("date") > NEVER), "landed": old.withColumn("value", F.col("value") * 2)}
    kept = None
    for name, source in sources.items():
        stays = Quality.on_empty_source(source, old)
        rows = (source if stays is None else stays).select(F.lit(name).alias("source"), "series_key", text(), "value")
        kept = rows if kept is None else kept.unionByName(rows)
    return kept


@query(
    "findings_by_day",
    with_(P.ORD)
    + """
SELECT '2001-12-20' AS as_of, series_key, 'GAP' AS "check" FROM ord GROUP BY 2 HAVING datediff('day', max(date), DATE '2001-12-20') > 1
UNION ALL
SELECT '2002-06-03', series_key, 'GAP' FROM ord GROUP BY 2 HAVING datediff('day', max(date), DATE '2002-06-03') > 1""",
)
def findings_by_day(spark, sf):
    """Findings of two halted days, one of them run twice, each under its date."""
    path = scratch_path(spark, "findings")
    panel = settle(P.ord_(spark, sf).withColumn("series_key", F.col("series_key").cast("string")))
    for day in (LATE, "2002-06-03", LATE):
        found = Quality.findings(panel, datetime.date.fromisoformat(day), True, expected=["series_key", "date", "value"])
        try:
            Quality.enforce(found.filter("check = 'GAP'"), path, day)
        except Quality.GateFailed:
            pass
    schema = "series_key string, severity string, `check` string, message string, position int, as_of date"
    return L.read_parquet(spark, path, T.StructType.fromDDL(schema)).select(text("as_of"), "series_key", "check")


STEPS = ((LAST_OLD, None), ("2001-07-01", "2001-05-18"), (P.AS_OF, "2001-07-02"))


@query(
    "incremental_features_sparse",
    with_(Q.SPARSE_FEATURES_SQL)
    + f"""
SELECT CAST(series_key AS VARCHAR) AS series_key, {D}, {', '.join(r6_sql(f, f) for f in S.FEATURES if f != 'geo_signal')},
       CASE WHEN date >= DATE '{STEPS[-1][1]}' THEN round(geo_signal, 6) + 0.0 END AS geo_signal FROM features""",
)
def incremental_features_sparse(spark, sf):
    """A backfill, then two runs that open their state and the newest snapshot, which has five days before it too.

    One ticker has been silent for two years and cpi has a value a month, so most of what the new days
    need of them is long past.
    """
    t = daily.Tables(scratch_path(spark, "job"))
    sources = landed_sources(spark, sf)
    sources["prices"] = sources["prices"].filter((F.col("ticker") != "^OVX") | (F.col("date") < Q.QUIET))
    monthly = F.col("date") == F.min("date").over(W.partitionBy("series_key", "series", F.trunc("date", "month")))
    sources["macro"] = sources["macro"].withColumn("__first", monthly).filter((F.col("series") != "cpi") | F.col("__first")).drop("__first")
    sources = {name: settle(rows) for name, rows in sources.items()}
    before = None
    for run, since in STEPS:
        for name, rows in sources.items():
            known = rows.filter(F.col("date") <= run)
            if before is not None:
                known = known.filter(F.col("date") > F.date_sub(F.to_date(F.lit(before)), S.LOOKBACK_DAYS))
            L.write_snapshot(known, t.landed, name, run)
        daily.update_features(spark, t, run, P.FLOOR, since)
        before = run
    new = F.col("date") >= STEPS[-1][1]
    return L.read_features(spark, t.features).select(
        "series_key",
        text(),
        *[r6(f) for f in S.FEATURES if f != "geo_signal"],
        F.when(new, r6("geo_signal")).alias("geo_signal"),
    )


@query(
    "run_record",
    with_(Q.SCORES_SQL)
    + f"""
SELECT 'r1' AS run_id, {len(S.FEATURES)}::BIGINT AS n_features, 0.05::DOUBLE AS contamination, 200::BIGINT AS n_estimators,
       1.53::DOUBLE AS static_threshold, 0.95::DOUBLE AS rolling_percentile, {r6_sql('avg(risk_score)', 'mean_risk_score')},
       {r6_sql('avg(anomaly_static::INT)', 'anomaly_rate_static')}, {r6_sql('avg(anomaly_1y::INT)', 'anomaly_rate_1y')}
FROM flagged""",
)
def run_record(spark, sf):
    path = scratch_path(spark, "runs")
    K.log_run(K.run_record(scored(spark, sf), "r1", S.FEATURES), path)
    return L.read_parquet(spark, path, K.RUN_LOG).select(
        "run_id",
        F.size("features_if").cast("long").alias("n_features"),
        "contamination",
        F.col("n_estimators").cast("long").alias("n_estimators"),
        "static_threshold",
        "rolling_percentile",
        *[r6(c) for c in ("mean_risk_score", "anomaly_rate_static", "anomaly_rate_1y")],
    )


@query(
    "table_dates",
    with_(P.ORD) + "\nSELECT series_key, CAST(min(date) AS VARCHAR) AS first_date, CAST(max(date) AS VARCHAR) AS last_date FROM ord GROUP BY 1",
)
def table_dates(spark, sf):
    return A.date_range(P.ord_(spark, sf), ["series_key"]).select("series_key", text("first_date"), text("last_date"))
