"""The daily job: land -> features -> gate -> score -> store.

Three tables lie between the steps (landed snapshots, feature table, score
table), so a lost run restarts at the step it lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from panelwatch import schemas as S
from panelwatch.operators import aggregates as A
from panelwatch.operators import quality as Q
from panelwatch.operators import signals as G
from panelwatch.operators.changepoint import changepoint_density, changepoints
from panelwatch.operators.forest import (
    Forest,
    Forests,
    fit_forest,
    fit_forests,
    forest_attribution,
    forests_attribution,
    score_forest,
    score_forests,
)
from panelwatch.operators.series import Series, _join_same, forward_fill, latest_row
from panelwatch.operators.spine import PREVIOUS, is_session, previous_session, session_state
from panelwatch.plans import lookback
from panelwatch.plans.features import build_features
from panelwatch.session import settle
from panelwatch.sources import landing as L
from panelwatch.sources import scores as T

KEYS = ("series_key",)


@dataclass
class Tables:
    root: str
    landed: str = field(init=False)
    features: str = field(init=False)
    scores: str = field(init=False)
    runs: str = field(init=False)
    findings: str = field(init=False)
    stamps: str = field(init=False)
    lookback: str = field(init=False)

    def __post_init__(self):
        for name in ("landed", "features", "scores", "runs", "findings", "stamps", "lookback"):
            setattr(self, name, f"{self.root}/{name}")


def merge_sources(spark: SparkSession, t: Tables, as_of: str) -> None:
    """Fold what has landed up to a run date into the sources' current tables, for later reads of the whole history."""
    for source, (schema, ids, _, _) in lookback.SOURCES.items():
        L.merge_landed(spark, t.landed, source, schema, ids, as_of)


def update_features(
    spark: SparkSession,
    t: Tables,
    as_of: str,
    floor: str | None = S.DATE_FLOOR,
    since: str | None = None,
    halo_days: int = lookback.ZONE_DAYS,
) -> None:
    """Add the dates the feature table lacks, from landed values, and leave a state for the next run.

    Without ``since`` the whole landed history is read.  With it only dates from ``since`` are
    added, from the newest state of an earlier run date (``plans.lookback``) and the snapshots landed
    after it, and they equal those of a backfill.  The whole history is read if there is no
    such state, if ``since`` is ``halo_days`` before that state's run date or more, or if a
    newly landed snapshot changes a value as old as that.  A snapshot replaced under a run date
    that a state has already counted needs a run without ``since``.
    """
    values, seeds = lookback.history(spark, t.landed, t.lookback, as_of, since)
    bars, macro, geo = lookback.sources_of(values)
    table = L.read_features(spark, t.features)
    if Q.on_empty_source(macro, table) is not None:
        return
    if bars.isEmpty() or geo.isEmpty():
        raise Q.GateFailed("no landed prices or geopolitical data")
    wide = L.wide_prices(bars), L.wide_macro(macro), L.with_staleness(geo, as_of)
    built = settle(build_features(*wide, None, seeds=seeds, carry=True))
    first = since or floor
    L.append_features(spark, built if first is None else built.filter(F.col("date") >= F.to_date(F.lit(first))), t.features)
    lookback.write_state(values, built, t.lookback, as_of, halo_days)


AS_OF = "as_of"
STAMP_TABLE = StructType([f for f in S.FEATURE_TABLE.fields if f.name in (*KEYS, *Q.STAMPS)] + [StructField(AS_OF, DateType())])


def gate_features(
    spark: SparkSession, t: Tables, sessions: DataFrame, as_of: str, calendars: DataFrame | None = None
) -> DataFrame:
    """Check the feature table, halt on anything critical, else store the keys' stamps of the day.

    With ``calendars`` (series_key, calendar) each key is checked by its own, and ``sessions`` has
    (calendar, date).  The day's findings are kept under its date, also where nothing is critical.  One row per key is written, however long the history; ``stamped_features`` joins it.
    """
    features = L.read_features(spark, t.features)
    if calendars is None:
        session_day = is_session(sessions, as_of)
        found = settle(Q.findings(features, previous_session(sessions, as_of), session_day))
    else:
        session_day = settle(session_state(sessions, as_of, calendars))
        found = settle(Q.findings(features, session_day))
    Q.enforce(found, t.findings, as_of)
    stamps = Q.stamps(features, found, session_day).withColumn(AS_OF, F.to_date(F.lit(as_of)))
    L.write_partitions(stamps, t.stamps, AS_OF)
    return found


def stamped_features(spark: SparkSession, t: Tables) -> DataFrame:
    """The feature table with the newest stamp of each key on all its rows."""
    stamps = L.read_parquet(spark, t.stamps, STAMP_TABLE)
    newest = settle(latest_row(stamps, KEYS, AS_OF).drop(AS_OF))
    return Q.with_stamps(L.read_features(spark, t.features), newest)


def training_rows(features: DataFrame, names=S.FEATURES, keys=KEYS) -> DataFrame:
    """Forward-filled rows with every feature present."""
    return forward_fill(Series.of(features, keys), names).df.dropna(subset=list(names))


def score(
    train: DataFrame,
    names=S.FEATURES,
    blocks=S.BLOCKS,
    keys=KEYS,
    trees: int = S.FOREST_TREES,
    sample: int = S.FOREST_SAMPLE,
    static: float = S.STATIC_THRESHOLD,
    windows=S.ROLLING_WINDOWS,
    weight: str | None = None,
    by: Sequence[str] = (),
) -> tuple[DataFrame, list[str] | DataFrame, Forest | Forests]:
    """Scores, thresholds and flags for complete rows; (frame, pruned features, forest).

    The z and forest columns stay on the frame for the attribution.  With ``by`` (some of
    ``keys``) each group of series has a pruning, a forest and score statistics of its own, as
    if scored alone; the features come as (by, kept).  A group without rows of positive
    weight has no forest, and null scores.
    """
    train = settle(train)
    ids = [*keys, "date"]
    if by:
        reduced = settle(A.prune_by(train, names, by))
        forest = fit_forests(train, names, by, ids, trees, sample, weight=weight, kept=reduced)
        raw = settle(score_forests(train, forest, "__raw", sample))
    else:
        reduced = A.prune_features(train, names)
        forest = fit_forest(train, reduced, ids, trees, sample, weight=weight)
        forest.nodes = settle(forest.nodes)
        raw = settle(score_forest(train, forest, "__raw"))
    scored = A.normalise_scores(raw, "__raw", "scores_if", by).drop("__raw")
    points = changepoints(train, names, keys=keys)
    scored = changepoint_density(scored, points, len(names), keys)
    z = G.zscore_signal(Series.of(scored, keys), blocks)
    blended = G.ensemble(z.df)
    flagged = G.anomaly_flags(z._with(blended), windows=windows, static=static)
    return flagged.df, reduced, forest


def drivers_of(due: DataFrame, reduced: list[str] | DataFrame, forest: Forest | Forests) -> DataFrame:
    """Rows with ``top_drivers``, from the features that their own forest saw."""
    if isinstance(forest, Forest):
        wide, shap = forest_attribution(due, forest)
        return G.attribute(wide, reduced, shap)
    wide, shap = forests_attribution(due, forest)
    wide = _join_same(wide, reduced.withColumnRenamed("kept", "__kept"), forest.by, "left")
    own = {G.zname(f): F.when(F.array_contains("__kept", f), F.col(G.zname(f))) for f in forest.features}
    return G.attribute(wide.withColumns(own), forest.features, shap).drop("__kept")


def train_and_score(
    spark: SparkSession,
    t: Tables,
    sessions: DataFrame,
    as_of: str,
    backfill: bool = False,
    run_id: str | None = None,
    calendars: DataFrame | None = None,
    **settings,
) -> str:
    """Fit on the whole feature table, weighted by data quality, and upsert the due rows of the score table.

    ``by=["series_key"]`` among the settings gives each series set a model of its own.  With ``calendars``
    each key is due by its own last session; a key without one is scored but not due.
    """
    run_id = run_id or uuid.uuid4().hex
    if calendars is None:
        last = previous_session(sessions, as_of)
        none = last is None
        last_session = str(last)
    else:
        last_session = settle(session_state(sessions, as_of, calendars))
        none = last_session.filter(F.col(PREVIOUS).isNotNull()).isEmpty()
    if none:
        raise ValueError(f"the calendar has no session before {as_of}")
    features = stamped_features(spark, t)
    settings = {"weight": "data_quality_score"} | settings
    scored, reduced, forest = score(training_rows(features), **settings)
    scored = settle(scored.withColumn("model_version", F.lit(run_id)))
    due = T.rows_to_write(scored, last_session, backfill)
    T.upsert_scores(spark, t.scores, drivers_of(due, reduced, forest))  # only rows that are stored are attributed
    if isinstance(reduced, DataFrame):  # features that some group keeps
        some = {r["f"] for r in reduced.select(F.explode("kept").alias("f")).distinct().collect()}
        reduced = [f for f in forest.features if f in some]
    T.log_run(T.run_record(scored, run_id, reduced), t.runs)
    return run_id
