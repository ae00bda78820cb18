"""Correlation pruning, signals, blend, thresholds, attribution, forest, change points."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import scalar as C
from panelwatch.operators import aggregates as A
from panelwatch.operators import signals as G
from panelwatch.operators.changepoint import changepoint_density, changepoints
from panelwatch.operators.forest import fit_forest, fit_forests, forest_attribution, score_forest, score_forests
from panelwatch.operators.series import Series
from panelwatch.plans import daily
from panelwatch.queries import panels as P
from panelwatch.queries import sqltext as Q
from panelwatch.queries.registry import query, r6, r6_sql, recursive, staged, text, with_
from panelwatch.queries.shapes import features
from panelwatch.session import settle

D = "CAST(date AS VARCHAR) AS date"
F_COLS = ", ".join(S.FEATURES)


def train(spark, sf):
    return features(spark, sf).dropna(subset=list(S.FEATURES))


@query("corr_pairs", with_(Q.TRAIN_SQL, f"pairs AS ({Q.PAIRS_SQL})") + f"\nSELECT a, b, {r6_sql('corr', 'corr')} FROM pairs")
def corr_pairs(spark, sf):
    return A.correlations(train(spark, sf), S.FEATURES).select("a", "b", r6("corr"))


@query(
    "feature_prune",
    with_(Q.TRAIN_SQL, f"pairs AS ({Q.PAIRS_SQL})", "names AS (SELECT a AS feature FROM pairs UNION SELECT b FROM pairs)")
    + "\nSELECT feature FROM names WHERE feature NOT IN (SELECT b FROM pairs WHERE corr > 0.3)",
)
def feature_prune(spark, sf):
    """With a low limit, so that something is dropped on this data."""
    kept = A.prune_features(train(spark, sf), S.FEATURES, limit=0.3)
    return spark.createDataFrame([(f,) for f in kept], "feature string")


@query(
    "feature_prune_by_key",
    with_(Q.TRAIN_SQL, f"pairs AS ({Q.KEYED_PAIRS_SQL})", "names AS (SELECT series_key, a AS feature FROM pairs UNION SELECT series_key, b FROM pairs)")
    + """
SELECT n.series_key, feature FROM names n
WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.series_key = n.series_key AND p.b = n.feature AND corr > 0.3)""",
)
def feature_prune_by_key(spark, sf):
    """Every series set keeps features of its own."""
    kept = A.prune_by(train(spark, sf), S.FEATURES, limit=0.3)
    return kept.select("series_key", F.explode("kept").alias("feature"))


WEEK = "CAST(date_trunc('week', date) AS DATE) + 6"


@query(
    "weekly_last",
    with_(
        P.MARKET,
        f"""w AS (SELECT series_key, {WEEK} AS week_end, {", ".join(f"arg_max({c}, date) FILTER ({c} IS NOT NULL) AS {c}" for c in ("yield_curve", "cpi", "brent"))}
  FROM macro GROUP BY 1, 2)""",
    )
    + """
SELECT series_key, CAST(CAST(week_end AS DATE) AS VARCHAR) AS week_end, yield_curve, cpi, brent FROM w
WHERE yield_curve IS NOT NULL AND cpi IS NOT NULL AND brent IS NOT NULL""",
)
def weekly_last(spark, sf):
    cols = ["yield_curve", "cpi", "brent"]
    return A.weekly_last(P.macro(spark, sf), cols).select("series_key", text("week_end"), *cols)


@query(
    "score_normalise",
    with_(P.EVT)
    + f"""
SELECT series_key, event_id,
       {r6_sql('(value - min(value) OVER ()) / stddev_pop(value) OVER ()', 'overall')},
       {r6_sql('(value - min(value) OVER (PARTITION BY series_key)) / stddev_pop(value) OVER (PARTITION BY series_key)', 'by_key')}
FROM evt""",
)
def score_normalise(spark, sf):
    x = A.normalise_scores(P.evt(spark, sf), "value", "overall")
    return A.normalise_scores(x, "value", "by_key", ["series_key"]).select(
        "series_key", "event_id", r6("overall"), r6("by_key")
    )


def _signal(spark, sf):
    return G.zscore_signal(Series.of(train(spark, sf)))


@query(
    "zscore_signal",
    with_(Q.SIGNAL_SQL)
    + f"\nSELECT series_key, {D}, {', '.join(r6_sql(f'z_{f}', f'z_{f}') for f in S.FEATURES)}, {r6_sql('scores_z', 'scores_z')} FROM signal",
)
def zscore_signal(spark, sf):
    return _signal(spark, sf).df.select(
        "series_key", text(), *[r6(G.zname(f)) for f in S.FEATURES], r6("scores_z")
    )


@staged("scored")
def scored(spark, sf):
    """A scored panel whose forest part is the normalised peak |z|, which SQL can make too."""
    z = _signal(spark, sf)
    peak = C.max_abs([G.zname(f) for f in S.FEATURES])
    rows = z.df.withColumn("peak", F.coalesce(peak, F.lit(0.0)))  # warm-up rows are scored with z = 0
    rows = A.normalise_scores(settle(rows), "peak", "scores_if").withColumn("scores_cp", F.lit(0.0))
    return G.anomaly_flags(z._with(G.ensemble(rows))).df


@query(
    "ensemble_score",
    with_(Q.SCORES_SQL)
    + f"\nSELECT series_key, {D}, {', '.join(r6_sql(c, c) for c in ('scores_if', 'scores_z', 'risk_score'))} FROM blend",
)
def ensemble_score(spark, sf):
    return scored(spark, sf).select("series_key", text(), *[r6(c) for c in ("scores_if", "scores_z", "risk_score")])


@query(
    "thresholds_flags",
    with_(Q.SCORES_SQL)
    + f"""
SELECT series_key, {D}, {', '.join(r6_sql(f'threshold_{k}', f'threshold_{k}') for k in S.THRESHOLD_NAMES)},
       {', '.join(f'anomaly_{k}' for k in S.THRESHOLD_NAMES)} FROM flagged""",
)
def thresholds_flags(spark, sf):
    return scored(spark, sf).select(
        "series_key",
        text(),
        *[r6(f"threshold_{k}") for k in S.THRESHOLD_NAMES],
        *[f"anomaly_{k}" for k in S.THRESHOLD_NAMES],
    )


@query(
    "anomaly_rates",
    with_(Q.SCORES_SQL)
    + f"""
SELECT series_key, {r6_sql('avg(risk_score)', 'mean_score')},
       {', '.join(r6_sql(f'avg(anomaly_{k}::INT)', f'rate_anomaly_{k}') for k in S.THRESHOLD_NAMES)}
FROM flagged GROUP BY 1""",
)
def anomaly_rates(spark, sf):
    flags = [f"anomaly_{k}" for k in S.THRESHOLD_NAMES]
    out = A.anomaly_rates(scored(spark, sf), flags, "risk_score", ["series_key"])
    return out.select("series_key", r6("mean_score"), *[r6(f"rate_{f}") for f in flags])


@query(
    "z_attribution_top5",
    with_(Q.SCORES_SQL)
    + f"\nSELECT series_key, {D}, CAST(place AS BIGINT) AS place, feature, {r6_sql('weight', 'weight')} FROM drivers",
)
def z_attribution_top5(spark, sf):
    top = G.attribute(scored(spark, sf), S.FEATURES)
    return top.select("series_key", text(), F.posexplode("top_drivers").alias("at", "d")).select(
        "series_key", "date", (F.col("at") + 1).cast("long").alias("place"), "d.feature", r6(F.col("d.weight"), "weight")
    )


@query(
    "change_density",
    with_(
        P.SHIP,
        f"hits AS (SELECT series_key, {WEEK} AS date, count(*) AS n FROM ship WHERE value > 200000 GROUP BY 1, 2)",
    )
    + f"""
SELECT s.series_key, CAST(s.date AS VARCHAR) AS date, {r6_sql("CASE WHEN h.date IS NULL THEN 0.0::DOUBLE ELSE n::DOUBLE / 19.0::DOUBLE END", 'scores_cp')}
FROM ship s LEFT JOIN hits h ON s.series_key = h.series_key AND s.date = h.date""",
)
def change_density(spark, sf):
    """The density step alone, on points that SQL can name: weeks with large days, one point for each."""
    daily_ = settle(P.ship(spark, sf))
    points = (
        daily_.filter(F.col("value") > 200000)
        .select("series_key", F.date_add(F.trunc("date", "week"), 6).alias("week_end"))
    )
    return changepoint_density(daily_, points, len(S.FEATURES)).select("series_key", text(), r6("scores_cp"))


@query(
    "changepoints",
    recursive(Q.TRAIN_SQL, Q.CHANGES_SQL) + "\nSELECT series_key, feature, CAST(CAST(week_end AS DATE) AS VARCHAR) AS week_end FROM changes",
)
def changepoints_(spark, sf):
    return changepoints(train(spark, sf)).select("series_key", "feature", text("week_end"))


@query(
    "iforest_scores",
    with_(Q.FOREST_SQL) + f"\nSELECT series_key, {D}, {r6_sql('raw', 'raw')}, {r6_sql('scores_if', 'scores_if')} FROM forest_scores",
)
def iforest_scores(spark, sf):
    rows = settle(train(spark, sf))
    names = A.prune_features(rows, S.FEATURES)
    raw = settle(score_forest(rows, fit_forest(rows, names), "raw"))
    out = A.normalise_scores(raw, "raw", "scores_if")
    return out.select("series_key", text(), r6("raw"), r6("scores_if"))


@query("iforest_attribution")
def iforest_attribution(spark, sf):
    """Forest plus z attribution for every complete row; top five drivers."""
    rows = settle(_signal(spark, sf).df)
    names = A.prune_features(rows, S.FEATURES)
    wide, shap = forest_attribution(rows, fit_forest(rows, names))
    top = G.attribute(wide, names, shap)
    return top.select("series_key", text(), F.posexplode("top_drivers").alias("at", "d")).select(
        "series_key", "date", (F.col("at") + 1).cast("long").alias("place"), "d.feature", r6(F.col("d.weight"), "weight")
    )


def small_forest(rows):
    forest = fit_forest(rows, S.FEATURES, trees=Q.TREES, sample=Q.SAMPLE)
    forest.nodes = settle(forest.nodes)
    return forest


@query(
    "iforest_small",
    with_(Q.SMALL_FOREST_SQL)
    + f"""
SELECT series_key, {D}, {r6_sql('raw', 'raw')}, {r6_sql('(raw - min(raw) OVER ()) / nullif(stddev_pop(raw) OVER (), 0)', 'scores_if')}
FROM forest_raw""",
)
def iforest_small(spark, sf):
    """A forest of few small trees over all rows, which SQL can draw, grow and read too."""
    rows = settle(train(spark, sf))
    raw = settle(score_forest(rows, small_forest(rows), "raw"))
    return A.normalise_scores(raw, "raw", "scores_if").select("series_key", text(), r6("raw"), r6("scores_if"))


@query(
    "iforest_small_by_key",
    with_(Q.KEYED_FOREST_SQL)
    + f"""
SELECT series_key, {D}, {r6_sql('raw', 'raw')},
       {r6_sql('(raw - min(raw) OVER (PARTITION BY series_key)) / nullif(stddev_pop(raw) OVER (PARTITION BY series_key), 0)', 'scores_if')}
FROM forest_raw""",
)
def iforest_small_by_key(spark, sf):
    """A small forest for each series set, whose rows are scored beside it."""
    rows = settle(train(spark, sf))
    forests = fit_forests(rows, S.FEATURES, trees=Q.TREES, sample=Q.SAMPLE)
    raw = settle(score_forests(rows, forests, "raw", sample=Q.SAMPLE))
    out = A.normalise_scores(raw, "raw", "scores_if", ["series_key"])
    return out.select("series_key", text(), r6("raw"), r6("scores_if"))


@query(
    "iforest_small_attribution",
    with_(Q.SHAPLEY_SQL)
    + f"\nSELECT series_key, {D}, CAST(place AS BIGINT) AS place, feature, {r6_sql('weight', 'weight')} FROM forest_drivers WHERE place <= 5",
)
def iforest_small_attribution(spark, sf):
    """The small forest's Shapley values and the z weights together: top five drivers of every row."""
    rows = settle(_signal(spark, sf).df)
    wide, shap = forest_attribution(rows, small_forest(rows))
    top = G.attribute(wide, S.FEATURES, shap)
    return top.select("series_key", text(), F.posexplode("top_drivers").alias("at", "d")).select(
        "series_key", "date", (F.col("at") + 1).cast("long").alias("place"), "d.feature", r6(F.col("d.weight"), "weight")
    )


@query(
    "risk_scores",
    recursive(Q.FOREST_SQL, Q.CHANGES_SQL, Q.RISK_SQL)
    + f"""
SELECT series_key, {D}, {', '.join(r6_sql(c, c) for c in ('risk_score', 'scores_if', 'scores_z', 'scores_cp'))},
       {', '.join(r6_sql(f'threshold_{k}', f'threshold_{k}') for k in S.THRESHOLD_NAMES)},
       {', '.join(f'coalesce(risk_score > threshold_{k}, false) AS anomaly_{k}' for k in S.THRESHOLD_NAMES)} FROM limits""",
)
def risk_scores(spark, sf):
    """The whole scoring chain with the real forest and change points."""
    out, _, _ = daily.score(train(spark, sf))
    return out.select(
        "series_key",
        text(),
        *[r6(c) for c in ("risk_score", "scores_if", "scores_z", "scores_cp")],
        *[r6(f"threshold_{k}") for k in S.THRESHOLD_NAMES],
        *[f"anomaly_{k}" for k in S.THRESHOLD_NAMES],
    )
