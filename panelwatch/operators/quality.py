"""Data-quality gate: findings per series, a score, and the halt."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwatch import schemas as S
from panelwatch.functions.scalar import percent_text
from panelwatch.operators.series import _join_same, last_rows
from panelwatch.operators.spine import PREVIOUS, SESSION_DAY
from panelwatch.session import settle

KEYS = ("series_key",)
CRITICAL, WARNING = "CRITICAL", "WARNING"

# Check names, limits and message texts as stored in the quality flags.
NULL_LIMIT, NULL_ROWS = 0.05, 60
MOVE_LIMIT, CALM_LIMIT = 0.10, 1.0
MOVE, CALM = "brent_ret_1d", ("ovx_zscore", "vix_zscore")
PRICE_PROBES = ("brent_ret_1d", "wti_ret_1d", "ng_ret_1d")


class GateFailed(RuntimeError):
    """A critical check failed; nothing may be written."""


EXAMPLES = 5  # messages in the error text; the findings table has all


def _finding(severity: str, check: str, when: Column, message: Column) -> Column:
    entry = F.struct(
        F.lit(severity).alias("severity"), F.lit(check).alias("check"), message.alias("message")
    )
    return F.when(F.coalesce(when, F.lit(False)), entry)


def schema_findings(df: DataFrame, expected: Sequence[str] = S.EXPECTED_COLUMNS) -> list[str]:
    missing = [c for c in expected if c not in df.columns]
    return [f"SCHEMA: missing columns {missing}"] if missing else []


def findings(
    df: DataFrame,
    previous_session: datetime.date | DataFrame | None = None,
    session_day: bool = True,
    expected: Sequence[str] = S.EXPECTED_COLUMNS,
    keys=KEYS,
    order: str = "date",
) -> DataFrame:
    """(keys, severity, check, message, position) in rule order.

    All row checks come from one pass: the newest rows per key are cut before
    the shuffle and aggregated to one row per key.  The checks of a session day
    know one calendar, or with a frame of ``spine.session_state`` that of each key;
    a key that it lacks has no session.
    """
    keys = list(keys)
    spark = df.sparkSession
    have = set(df.columns)
    probes = [c for c in (MOVE, *CALM, *PRICE_PROBES, "gpr_days_stale") if c in have]
    probes = list(dict.fromkeys(probes))
    watched = [c for c in df.columns if c not in (*keys, order)]
    per_key = (
        last_rows(df, NULL_ROWS, keys, order)
        .groupBy(*keys)
        .agg(
            F.max(order).alias("last"),
            F.max_by(F.struct(order, *probes), F.col(order)).alias("row"),
            F.struct(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in watched]).alias("nulls"),
        )
    )

    if isinstance(previous_session, DataFrame):
        state = previous_session.select(*keys, F.col(PREVIOUS).alias("__previous"), F.col(SESSION_DAY).alias("__day"))
        per_key = _join_same(per_key, state, keys, "left")
        on_day, want, session_day = F.coalesce("__day", F.lit(False)), F.col("__previous"), True
    else:
        on_day, want = F.lit(True), F.lit(previous_session).cast("date")

    def probe(c: str) -> Column:
        return F.abs(F.col("row")[c]) if c in have else F.lit(0.0)

    rules = [
        _finding(CRITICAL, "SCHEMA", F.lit(True), F.lit(m)) for m in schema_findings(df, expected)
    ]
    if session_day and previous_session is not None:
        rules.append(
            _finding(
                CRITICAL,
                "GAP",
                on_day & (F.datediff(want, "last") > 1),
                F.format_string(
                    "GAP: last date is %s, expected %s", F.col("last").cast("string"), want.cast("string")
                ),
            )
        )
    if session_day:
        calm = [probe(c) < CALM_LIMIT for c in CALM]
        rules.append(
            _finding(
                CRITICAL,
                "CROSS_SOURCE",
                on_day & (probe(MOVE) > MOVE_LIMIT) & calm[0] & calm[1],
                F.concat(
                    F.lit("CROSS_SOURCE: Brent moved "), percent_text(probe(MOVE), 1), F.lit(" but vol indices flat")
                ),
            )
        )
    if "gpr_days_stale" in have:
        days = F.col("row")["gpr_days_stale"]
        rules.append(
            _finding(
                WARNING,
                "GPR_STALE",
                days > S.STALE_DAYS,
                F.format_string("GPR_STALE: %d days stale — OVX fallback active", days),
            )
        )
    for c in watched:
        share = F.col("nulls")[c]
        rules.append(
            _finding(
                WARNING,
                "NULLS",
                share > NULL_LIMIT,
                F.concat(
                    F.lit(f"NULLS: {c} is "), percent_text(share, 0), F.lit(f" null in last {NULL_ROWS} rows")
                ),
            )
        )
    if have.issuperset(PRICE_PROBES):
        gone = [F.col("row")[c].isNull() for c in PRICE_PROBES]
        rules.append(
            _finding(
                WARNING,
                "SOURCE_MISSING",
                gone[0] & gone[1] & gone[2],
                F.lit("SOURCE_MISSING: all price features null today"),
            )
        )

    rows = per_key.select(*keys, F.posexplode(F.array(*rules)).alias("position", "f"))
    out = rows.filter(F.col("f").isNotNull()).select(
        *keys, "f.severity", "f.check", "f.message", "position"
    )
    if not df.isEmpty():
        return out
    # No rows at all: the frame-level checks still speak, under a null key.
    texts = schema_findings(df, expected) + ["COMPLETENESS: zero rows"]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema.fields])
    data = [
        (*[None] * len(keys), CRITICAL, t.split(":")[0], t, i) for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(data, schema)


def quality_scores(found: DataFrame, keys=KEYS) -> DataFrame:
    """(keys, data_quality_score, data_quality_flags) for keys with warnings."""
    warnings = found.filter(F.col("severity") == WARNING)
    ordered = F.array_sort(F.collect_list(F.struct("position", "message")))  # one entry per rule
    n = F.count(F.lit(1)).cast("double")
    return warnings.groupBy(*keys).agg(
        F.greatest(F.lit(0.0), F.lit(1.0) - n * F.lit(0.1)).alias("data_quality_score"),
        F.array_join(ordered["message"], "|").alias("data_quality_flags"),
    )


STAMPS = ("is_trading_day", "data_quality_score", "data_quality_flags")


def stamps(df: DataFrame, found: DataFrame, session_day: bool | DataFrame, keys=KEYS) -> DataFrame:
    """One row per key of ``df``: its present score and flags; clean keys have 1 and no flags.

    A frame of ``spine.session_state`` tells the session day of each key.
    """
    rows = df.select(*keys).distinct().join(quality_scores(found, keys), list(keys), "left")
    if isinstance(session_day, DataFrame):
        rows = _join_same(rows, session_day.select(*keys, F.col(SESSION_DAY).alias("__day")), keys, "left")
        on_day = F.coalesce("__day", F.lit(False))
    else:
        on_day = F.lit(session_day)
    return rows.select(
        *keys,
        on_day.alias("is_trading_day"),
        F.coalesce("data_quality_score", F.lit(1.0)).alias("data_quality_score"),
        F.coalesce("data_quality_flags", F.lit("")).alias("data_quality_flags"),
    )


def with_stamps(df: DataFrame, stamped: DataFrame, keys=KEYS) -> DataFrame:
    """Every row of a key with the key's stamp; a key without one keeps its own values.

    ``stamped`` should be a stored table, so that the join knows its size.
    """
    columns = df.columns
    own = [c for c in STAMPS if c in columns]
    new = stamped.withColumnsRenamed({c: f"__{c}" for c in STAMPS})
    out = df.join(new, list(keys), "left")
    values = {c: F.coalesce(f"__{c}", c) if c in own else F.col(f"__{c}") for c in STAMPS}
    return out.withColumns(values).select(*columns, *[c for c in STAMPS if c not in columns])


def stamp(df: DataFrame, found: DataFrame, session_day: bool, keys=KEYS) -> DataFrame:
    """The key's present score and flags on every one of its rows."""
    return with_stamps(df, settle(stamps(df, found, session_day, keys)), keys)


def enforce(found: DataFrame, path: str | None = None, as_of: str | None = None) -> None:
    """Raise if anything critical was found; call before any sink.

    With a ``path`` all findings are added to the table there first, so none is lost;
    the error names their number and the first few.  With ``as_of`` the day's findings, critical or not,
    are kept under that date, and a rerun replaces them.
    """
    if path is not None and as_of is not None:
        found.write.mode("overwrite").parquet(f"{path}/as_of={as_of}")
    worst = found.filter(F.col("severity") == CRITICAL)
    if worst.isEmpty():
        return
    if path is not None and as_of is None:
        found.write.mode("append").parquet(path)
    n = worst.count()
    keys = [c for c in found.columns if c not in ("severity", "check", "message", "position")]
    first = worst.orderBy(*keys, "position").select("message").limit(EXAMPLES).collect()
    where = "" if path is None else f", all in {path}"
    raise GateFailed(f"{n} critical findings{where}: " + "; ".join(r["message"] for r in first))


def on_empty_source(source: DataFrame, existing: DataFrame, policy: str = "keep_existing") -> DataFrame | None:
    """None if the source has rows; else the existing table, or a failure."""
    if not source.isEmpty():
        return None
    if policy == "keep_existing" and not existing.isEmpty():
        return existing
    raise GateFailed("source is empty and there is no existing table to keep")
