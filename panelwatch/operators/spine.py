"""Aligning frames on a common date spine, appending dates, calendars."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwatch import schemas as S
from panelwatch.operators.series import Series, _join_same, forward_fill, without_same
from panelwatch.session import settle

KEYS = ("series_key",)


def outer_align(frames: Sequence[DataFrame], keys=KEYS, order: str = "date") -> DataFrame:
    """Full outer alignment on (keys, order).

    All sides shuffle on the same columns, so n frames cost one exchange each.
    """
    on = [*keys, order]
    return reduce(lambda a, b: a.join(b, on, "full"), frames)


def reindex(spine: DataFrame, values: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """The spine's rows with ``values`` where the dates match; others are lost."""
    return spine.join(values, [*keys, order], "left")


def align(
    frames: Sequence[DataFrame],
    fill: Sequence[str],
    floor: str | None = S.DATE_FLOOR,
    keys=KEYS,
    order: str = "date",
) -> DataFrame:
    """Outer alignment, forward fill, then the date floor.

    The floor comes last so that older values seed the first kept rows.
    """
    filled = forward_fill(Series.of(outer_align(frames, keys, order), keys, order), fill).df
    return filled if floor is None else filled.filter(F.col(order) >= F.to_date(F.lit(floor)))


def append_new(existing: DataFrame, new: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """Existing rows untouched, plus the rows of ``new`` on dates not yet present; null keys and dates equal each other."""
    fresh = without_same(new, existing, [*keys, order])
    return existing.unionByName(fresh, allowMissingColumns=True)


def new_keys(new: DataFrame, existing: DataFrame, keys=KEYS, order: str = "date") -> DataFrame:
    """(keys, order) present in ``new`` only; nulls equal each other."""
    return without_same(new.select(*keys, order), existing, [*keys, order])


def mark_sessions(df: DataFrame, sessions: DataFrame, order: str = "date") -> DataFrame:
    """Add ``is_session``: whether the date is in the trading calendar."""
    cal = sessions.select(F.col("date").alias(order)).distinct().withColumn("__in", F.lit(True))
    return (
        df.join(cal, order, "left")
        .withColumn("is_session", F.coalesce("__in", F.lit(False)))
        .drop("__in")
    )


def is_session(sessions: DataFrame, date: str) -> bool:
    return not sessions.filter(F.col("date") == F.to_date(F.lit(date))).isEmpty()


def previous_session(sessions: DataFrame, as_of: str):
    """Last session strictly before ``as_of`` (a ``datetime.date``), or None."""
    return sessions.filter(F.col("date") < F.to_date(F.lit(as_of))).agg(F.max("date")).first()[0]


PREVIOUS, SESSION_DAY = "previous_session", "session_day"


def session_before(
    df: DataFrame, sessions: DataFrame, by: Sequence[str] = (), order: str = "date", name: str = PREVIOUS
) -> DataFrame:
    """Every row with the last session strictly before its date, in the calendar that ``by`` names.

    ``sessions`` has ``by`` and ``date``.  Rows keep all columns; the session is null for a null date, before a
    calendar's first session, and for a calendar without sessions.  Null calendars equal each other.
    Only the distinct dates per calendar are ordered, beside its sessions; both are bounded by the
    days they span, so a hot key adds nothing to a window.
    """
    asked = df.select(*by, order).distinct().withColumn("__session", F.lit(None).cast("date"))
    held = sessions.select(*by, F.col("date").alias(order), F.col("date").alias("__session")).dropna(subset=[order]).distinct()
    before = W.partitionBy(*by).orderBy(F.col(order).asc_nulls_first(), F.col("__session").isNotNull())
    last = F.last("__session", ignorenulls=True).over(before.rowsBetween(W.unboundedPreceding, -1))
    found = asked.unionByName(held).withColumn(name, last).filter(F.col("__session").isNull()).drop("__session")
    return _join_same(df, settle(found), [*by, order], "left")


def session_state(sessions: DataFrame, as_of: str, calendars: DataFrame, keys=KEYS, calendar: str = "calendar") -> DataFrame:
    """(keys, previous_session, session_day) of a date for each key, in the key's own calendar.

    ``calendars`` has (keys, calendar), ``sessions`` (calendar, date).  A key whose calendar has no
    session before the date has null, and no session day if the date is not in its calendar.
    Of several calendars listed for one key the smallest counts.
    """
    day = F.to_date(F.lit(as_of))
    state = sessions.groupBy(calendar).agg(
        F.max(F.when(F.col("date") < day, F.col("date"))).alias(PREVIOUS), F.max(F.col("date") == day).alias(SESSION_DAY)
    )
    one = calendars.groupBy(*keys).agg(F.min(calendar).alias(calendar))
    own = _join_same(one, state, [calendar], "left")
    return own.select(*keys, PREVIOUS, F.coalesce(SESSION_DAY, F.lit(False)).alias(SESSION_DAY))


def score_date(scored: DataFrame, target: str | DataFrame, keys=KEYS, fallback: str = "last") -> DataFrame:
    """Per key, ``target`` if scored, else a fallback date.

    ``last`` falls back to the key's last scored date, even a later one;
    ``previous`` to the last one not after the target.
    The target is one date, or (keys, previous_session) with a date for each key; a key without one has no row.
    """
    if isinstance(target, DataFrame):
        due = target.select(*keys, F.col(PREVIOUS).alias("__target")).dropna(subset=["__target"])
        scored, t = _join_same(scored.select(*keys, "date"), due, keys), F.col("__target")
    else:
        t = F.to_date(F.lit(target))
    if fallback == "previous":
        return scored.filter(F.col("date") <= t).groupBy(*keys).agg(F.max("date").alias("date"))
    if fallback != "last":
        raise ValueError(f"unknown fallback {fallback!r}")
    return scored.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(F.col("date") == t, F.col("date"))), F.max("date")).alias("date")
    )
