"""Report queries over a stored score table."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.plans import reports as R
from panelwatch.queries import sqltext as Q
from panelwatch.queries.registry import query, r6, r6_sql, text, with_
from panelwatch.queries.stores import kept_scores
from panelwatch.session import settle

D = "CAST(date AS VARCHAR) AS date"
KEY = "CAST(series_key AS VARCHAR) AS series_key"
STORED = "st AS (SELECT * FROM scores)"
NEWEST = "newest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY date DESC) = 1)"
STATUS_SQL = "status AS (" + " UNION ALL ".join(
    f"SELECT series_key, date, risk_score AS score, '{label}' AS win, threshold_{n} AS threshold, anomaly_{n} AS flagged FROM newest"
    for label, n in R.REPORT_WINDOWS.items()
) + ")"
MONTHS = {"Quarter": "INTERVAL 3 MONTH", "1-year": "INTERVAL 12 MONTH", "5-year": "INTERVAL 60 MONTH"}
RANKS_SQL = "ranks AS (" + " UNION ALL ".join(
    f"""SELECT s.series_key, '{label}' AS win,
  round_even(avg(coalesce(s.risk_score < n.risk_score, false)::INT) * 100, 1) AS pct,
  round_even(avg(coalesce(s.risk_score < n.threshold_{n}, false)::INT) * 100, 1) AS threshold_pct
  FROM scores s JOIN newest n ON s.series_key = n.series_key
  {f"WHERE s.date >= n.date - {MONTHS[label]}" if label in MONTHS else ""} GROUP BY 1"""
    for label, n in R.REPORT_WINDOWS.items()
) + ")"


@query(
    "report_latest",
    with_(Q.SCORES_SQL, NEWEST, STATUS_SQL)
    + f"""
SELECT {KEY}, {D}, {r6_sql('CAST(score AS DOUBLE)', 'score')}, win AS "window",
       {r6_sql('CAST(threshold AS DOUBLE)', 'threshold')}, flagged FROM status""",
)
def report_latest(spark, sf):
    out = R.latest_status(kept_scores(spark, sf))
    return out.select("series_key", text(), r6("score"), "window", r6("threshold"), "flagged")


@query(
    "report_percentiles",
    with_(Q.SCORES_SQL, NEWEST, RANKS_SQL)
    + f'\nSELECT {KEY}, win AS "window", {r6_sql("pct", "pct")}, {r6_sql("threshold_pct", "threshold_pct")} FROM ranks',
)
def report_percentiles(spark, sf):
    return R.percentiles(kept_scores(spark, sf)).select("series_key", "window", r6("pct"), r6("threshold_pct"))


_BAND = """WHEN threshold_pct - pct <= threshold_pct * 0.1::DOUBLE THEN 'orange'
  WHEN threshold_pct - pct <= threshold_pct * 0.3::DOUBLE THEN 'yellow' ELSE 'green' END"""
SEVERITY_SQL = with_(
    NEWEST,
    STATUS_SQL,
    RANKS_SQL,
    """breach AS (SELECT series_key, coalesce(string_agg(win, ', ' ORDER BY
  CASE win WHEN 'Quarter' THEN 1 WHEN '1-year' THEN 2 WHEN '5-year' THEN 3 ELSE 4 END) FILTER (flagged), '') AS breached
  FROM status GROUP BY 1)""",
).removeprefix("WITH ")
SEVERITY = f"""
SELECT CAST(r.series_key AS VARCHAR) AS series_key, r.win AS "window", {r6_sql('pct', 'pct')}, {r6_sql('threshold_pct', 'threshold_pct')},
       flagged, CASE WHEN pct >= threshold_pct THEN 'red' {_BAND} AS gauge, CASE WHEN flagged THEN 'red' {_BAND} AS tab, breached
FROM ranks r JOIN status s ON r.series_key = s.series_key AND r.win = s.win JOIN breach b ON r.series_key = b.series_key"""
SEVERITY_COLUMNS = ["flagged", "gauge", "tab", "breached"]


@query("report_severity", with_(Q.SCORES_SQL, SEVERITY_SQL) + SEVERITY)
def report_severity(spark, sf):
    out = R.severities(kept_scores(spark, sf))
    return out.select("series_key", "window", r6("pct"), r6("threshold_pct"), *SEVERITY_COLUMNS)


# Each key's history ends on the day of one of its highest scores: the first, the 151st, ...
CUT = """ordered AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY risk_score DESC, date) AS place FROM scores),
ends_at AS (SELECT series_key, date AS stop FROM ordered WHERE place = 1 + 150 * series_key),
cut AS (SELECT s.* FROM scores s JOIN ends_at e ON s.series_key = e.series_key AND s.date <= e.stop)"""


@query("report_severity_bands", with_(Q.SCORES_SQL, CUT, SEVERITY_SQL.replace("FROM scores", "FROM cut")) + SEVERITY)
def report_severity_bands(spark, sf):
    """The severities as of days with high scores, so that every band occurs."""
    scores = kept_scores(spark, sf)
    high = W.partitionBy("series_key").orderBy(F.desc("risk_score"), "date")
    stops = scores.select("series_key", "risk_score", "date").withColumn("at", F.row_number().over(high))
    stops = stops.filter(F.col("at") == 1 + 150 * F.col("series_key").cast("int")).select("series_key", F.col("date").alias("stop"))
    cut = scores.join(settle(stops), "series_key").filter(F.col("date") <= F.col("stop")).drop("stop")
    out = R.severities(settle(cut))
    return out.select("series_key", "window", r6("pct"), r6("threshold_pct"), *SEVERITY_COLUMNS)


LABELS = "labels_(code, label) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in S.FEATURE_LABELS.items()) + ")"
LABELLED = """named AS (
  SELECT d.*, coalesce(l.label, d.feature) AS label, sum(weight) OVER (PARTITION BY series_key, date) AS total
  FROM drivers d LEFT JOIN labels_ l ON d.feature = l.code)"""


@query(
    "report_driver_shares",
    with_(
        Q.SCORES_SQL,
        NEWEST,
        LABELS,
        LABELLED,
        """top AS (SELECT n.series_key, n.date, label AS feature, round_even(weight / total * 100, 1) AS importance
  FROM named n JOIN newest w ON n.series_key = w.series_key AND n.date = w.date WHERE place <= 4)""",
    )
    + f"""
SELECT {KEY}, {D}, feature, {r6_sql('importance', 'importance')} FROM top
UNION ALL
SELECT {KEY}, {D}, 'Others', {r6_sql('round_even(100 - sum(importance), 1)', 'importance')} FROM top GROUP BY series_key, date""",
)
def report_driver_shares(spark, sf):
    return R.driver_shares(kept_scores(spark, sf)).select("series_key", text(), "feature", r6("importance"))


ENDS = "ends AS (SELECT series_key, max(date) AS stop FROM scores GROUP BY 1)"


@query(
    "report_history",
    with_(Q.SCORES_SQL, ENDS)
    + f"""
SELECT '1y' AS slice, CAST(s.series_key AS VARCHAR) AS series_key, {D}, {r6_sql('CAST(risk_score AS DOUBLE)', 'risk_score')}
FROM scores s JOIN ends e ON s.series_key = e.series_key WHERE date >= stop - 365
UNION ALL
SELECT '3m', CAST(series_key AS VARCHAR), {D}, {r6_sql('CAST(risk_score AS DOUBLE)', 'risk_score')}
FROM scores WHERE date BETWEEN DATE '2000-06-30' - 90 AND DATE '2000-06-30'
UNION ALL
SELECT 'points', CAST(series_key AS VARCHAR), {D}, {r6_sql('CAST(risk_score AS DOUBLE)', 'risk_score')} FROM scores WHERE anomaly_static""",
)
def report_history(spark, sf):
    scores = kept_scores(spark, sf)

    def part(name, df):
        return df.select(
            F.lit(name).alias("slice"), "series_key", text(), r6(F.col("risk_score").cast("double"), "risk_score")
        )

    return (
        part("1y", R.history(scores, "1y"))
        .unionByName(part("3m", R.history(scores, "3m", "2000-06-30")))
        .unionByName(part("points", R.anomaly_points(R.history(scores, "All"))))
    )


@query(
    "report_anomaly_log",
    with_(
        Q.SCORES_SQL,
        LABELS,
        LABELLED,
        """lines AS (SELECT series_key, date,
  string_agg(label || ' (' || CAST(CAST(round_even(weight / total * 100, 0) AS BIGINT) AS VARCHAR) || '%)', ' · ' ORDER BY place) AS top_drivers
  FROM named WHERE place <= 3 AND total > 0 GROUP BY 1, 2)""",
    )
    + f"""
SELECT CAST(s.series_key AS VARCHAR) AS series_key, CAST(s.date AS VARCHAR) AS date,
       CAST(round_even(CAST(risk_score AS DOUBLE), 2) AS VARCHAR) AS stress_score, coalesce(top_drivers, '') AS top_drivers
FROM scores s LEFT JOIN lines l ON s.series_key = l.series_key AND s.date = l.date WHERE anomaly_static""",
)
def report_anomaly_log(spark, sf):
    return R.anomaly_log(kept_scores(spark, sf))
