"""Report tables over the score table; every one is a DataFrame per series key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.functions import scalar as C
from panelwatch.operators.series import latest_row
from panelwatch.session import settle

KEYS = ("series_key",)

# Report window labels, their stored columns, and their lengths.
REPORT_WINDOWS = {"Quarter": "qtr", "1-year": "1y", "5-year": "5y", "Historical": "static"}
REPORT_MONTHS = {"Quarter": 3, "1-year": 12, "5-year": 60, "Historical": None}
HISTORY_DAYS = {"3m": 90, "1y": 365, "5y": 1825, "All": None}
OTHERS = "Others"


def label_of(code: Column) -> Column:
    """The feature's label; unknown codes pass through.  A fixed map of 21 entries."""
    table = F.create_map(*[F.lit(v) for pair in S.FEATURE_LABELS.items() for v in pair])
    return F.coalesce(F.try_element_at(table, code), code)


def latest_status(scores: DataFrame, keys=KEYS) -> DataFrame:
    """(keys, date, score, window, threshold, flagged): four rows per key."""
    cols = ["date", "risk_score"] + [f"{p}_{n}" for p in ("threshold", "anomaly") for n in S.THRESHOLD_NAMES]
    now = latest_row(scores.select(*keys, *cols), keys)
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("window"),
                F.col(f"threshold_{n}").cast("double").alias("threshold"),
                F.col(f"anomaly_{n}").alias("flagged"),
            )
            for label, n in REPORT_WINDOWS.items()
        ]
    )
    return now.select(
        *keys, "date", F.col("risk_score").cast("double").alias("score"), F.explode(rows).alias("r")
    ).select(*keys, "date", "score", "r.window", "r.threshold", "r.flagged")


def percentiles(scores: DataFrame, keys=KEYS) -> DataFrame:
    """Rank of the newest score and of its stored threshold within each window.

    (keys, window, pct, threshold_pct): the share of scores strictly below, in
    percent to one decimal.  One pass for all windows: the join brings one row
    per key (stored first, so that its size is known) and the ranks are partial
    aggregates.
    """
    names = REPORT_WINDOWS
    now = latest_row(
        scores.select(*keys, "date", "risk_score", *[f"threshold_{n}" for n in names.values()]), keys
    ).select(
        *keys,
        F.col("date").alias("__end"),
        F.col("risk_score").alias("__score"),
        *[F.col(f"threshold_{n}").alias(f"__thr_{n}") for n in names.values()],
    )
    joined = scores.select(*keys, "date", "risk_score").join(settle(now), list(keys))
    below = lambda bound: F.coalesce(F.col("risk_score") < bound, F.lit(False)).cast("double")
    aggs = []
    for label, n in names.items():
        months = REPORT_MONTHS[label]
        inside = F.lit(True) if months is None else F.col("date") >= C.months_before("__end", months)
        aggs.append(F.avg(F.when(inside, below(F.col("__score")))).alias(f"p_{n}"))
        aggs.append(F.avg(F.when(inside, below(F.col(f"__thr_{n}")))).alias(f"t_{n}"))
    ranks = joined.groupBy(*keys).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("window"),
                F.bround(F.col(f"p_{n}") * 100.0, 1).alias("pct"),
                F.bround(F.col(f"t_{n}") * 100.0, 1).alias("threshold_pct"),
            )
            for label, n in names.items()
        ]
    )
    return ranks.select(*keys, F.explode(rows).alias("r")).select(
        *keys, "r.window", "r.pct", "r.threshold_pct"
    )


def severities(scores: DataFrame, keys=KEYS) -> DataFrame:
    """Percentiles with the gauge band, the tab band and the key's breached windows."""
    status = latest_status(scores, keys).select(*keys, "window", "flagged")
    both = percentiles(scores, keys).join(status, [*keys, "window"])
    order = F.array_position(F.array(*[F.lit(x) for x in REPORT_WINDOWS]), F.col("window"))
    entry = F.when(F.col("flagged"), F.struct(order.alias("at"), F.col("window").alias("window")))
    breached = both.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(entry))["window"], ", ").alias("breached")
    )
    return both.join(breached, list(keys)).select(
        *keys,
        "window",
        "pct",
        "threshold_pct",
        "flagged",
        C.severity("pct", "threshold_pct").alias("gauge"),
        C.severity("pct", "threshold_pct", "flagged").alias("tab"),
        "breached",
    )


def driver_shares(scores: DataFrame, keys=KEYS, top: int = 4) -> DataFrame:
    """The newest row's drivers as labelled shares plus the rest, smallest first per key."""
    now = latest_row(scores.select(*keys, "date", "top_drivers"), keys)
    now = now.withColumn("__total", C.driver_total("top_drivers"))
    shown = F.transform(
        F.slice("top_drivers", 1, top),
        lambda d: F.struct(
            label_of(d["feature"]).alias("feature"),
            F.bround(F.try_divide(d["weight"], F.col("__total")) * 100.0, 1).alias("importance"),
        ),
    )
    now = now.withColumn("__shown", shown)
    rest = F.bround(
        F.lit(100.0) - F.aggregate("__shown", F.lit(0.0), lambda a, d: a + d["importance"]), 1
    )
    rows = F.concat("__shown", F.array(F.struct(F.lit(OTHERS).alias("feature"), rest.alias("importance"))))
    out = now.select(*keys, "date", F.explode(rows).alias("r")).select(
        *keys, "date", "r.feature", "r.importance"
    )
    return out.orderBy(*keys, "importance")


def history(scores: DataFrame, window: str = "1y", end: str | None = None, keys=KEYS) -> DataFrame:
    """Scores of the window's days up to ``end`` (default: the key's newest), both ends included."""
    days = HISTORY_DAYS[window]
    if days is None:
        return scores
    if end is not None:
        stop = F.to_date(F.lit(end))
        return scores.filter(F.col("date").between(F.date_sub(stop, days), stop))
    stop = settle(scores.groupBy(*keys).agg(F.max("date").alias("__end")))
    return (
        scores.join(stop, list(keys))
        .filter(F.col("date") >= F.date_sub("__end", days))
        .drop("__end")
    )


def anomaly_points(slice_: DataFrame, keys=KEYS) -> DataFrame:
    return slice_.filter(F.col("anomaly_static")).select(*keys, "date", "risk_score")


def anomaly_log(scores: DataFrame, keys=KEYS, top: int = 3) -> DataFrame:
    """Statically flagged rows, newest first, with their leading drivers as text."""
    share = lambda d: F.bround(F.try_divide(d["weight"], C.driver_total("top_drivers")) * 100.0, 0)
    parts = F.transform(
        F.slice("top_drivers", 1, top),
        lambda d: F.concat(label_of(d["feature"]), F.lit(" ("), share(d).cast("int").cast("string"), F.lit("%)")),
    )
    rounded = F.bround(F.col("risk_score").cast("double"), 2)
    return (
        scores.filter(F.col("anomaly_static"))
        .select(
            *keys,
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            rounded.cast("string").alias("stress_score"),
            F.coalesce(F.array_join(parts, " · "), F.lit("")).alias("top_drivers"),
        )
        .orderBy(F.desc("date"), *keys)
    )
