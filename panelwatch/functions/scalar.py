"""Row-level column expressions.

Missing values are always null here, never NaN: Spark sorts NaN above every
number, so one stray NaN would raise a flag.  ``nan_to_null`` belongs at the
source; everything below relies on plain null propagation.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelwatch import schemas as S

TIE_DIGITS = 1e10

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def clip_lower(c: Column | str, floor: float = S.PRICE_FLOOR) -> Column:
    """Raise values to ``floor``; null stays null (``greatest`` would not keep it)."""
    c = _col(c)
    return F.when(c < floor, F.lit(float(floor))).otherwise(c)


def clip_upper_scaled(c: Column | str, cap: float = 5.0) -> Column:
    c = _col(c)
    return F.when(c > cap, F.lit(float(cap))).otherwise(c) / F.lit(float(cap))


def keep_above(c: Column | str, limit: float = S.PRICE_FLOOR) -> Column:
    c = _col(c)
    return F.when(c > limit, c)


def ratio(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(_col(a), _col(b))


def staleness_weight(days: Column | str, decay: float = S.STALE_DECAY) -> Column:
    return F.pow(F.lit(decay), _col(days))


def decayed_signal(level, fallback_z, weight) -> Column:
    """Pull a stale level toward neutral and let the fallback z-score take over."""
    level, z, w = _col(level), _col(fallback_z), _col(weight)
    rest = F.lit(1.0) - w
    return w * level + rest * S.NEUTRAL_LEVEL + rest * z * S.FALLBACK_SCALE


def total(cols: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def max_abs(cols: Sequence[str]) -> Column:
    """Largest magnitude in the row; nulls are skipped, all-null gives null."""
    parts = [F.abs(F.col(c)) for c in cols]
    return F.greatest(*parts) if len(parts) > 1 else parts[0]


def mean_of(cols: Sequence[Column]) -> Column:
    return total(cols) / F.lit(float(len(cols)))


def shares(cols: Sequence[Column], budget: float) -> list[Column]:
    """Scale non-negative columns so that each row sums to ``budget``."""
    whole = total([F.coalesce(c, F.lit(0.0)) for c in cols])
    return [F.try_divide(c, whole) * F.lit(budget) for c in cols]


def top_k(weights: dict[str, Column], k: int) -> Column:
    """The ``k`` heaviest entries as array<struct<feature, weight>>, ties by name.

    Weights that differ by rounding noise only count as tied.
    """
    # Sorting on (-weight, name) needs no comparator lambda.
    entries = F.array(
        *[
            F.struct(F.rint(-w * F.lit(TIE_DIGITS)).alias("at"), F.lit(name).alias("feature"), w.alias("weight"))
            for name, w in weights.items()
        ]
    )
    best = F.slice(F.array_sort(entries), 1, k)
    return F.transform(
        best, lambda e: F.struct(e["feature"].alias("feature"), e["weight"].alias("weight"))
    )


def driver_total(drivers: Column | str) -> Column:
    return F.aggregate(_col(drivers), F.lit(0.0), lambda acc, d: acc + d["weight"])


def severity(value, threshold, flagged=None) -> Column:
    """red / orange / yellow / green by distance below the threshold.

    With ``flagged`` the stored flag decides red; otherwise the two numbers do.
    """
    value, threshold = _col(value), _col(threshold)
    gap = threshold - value
    red = _col(flagged) if flagged is not None else value >= threshold
    return (
        F.when(red, "red")
        .when(gap <= threshold * F.lit(0.1), "orange")
        .when(gap <= threshold * F.lit(0.3), "yellow")
        .otherwise("green")
    )


def months_before(date: Column | str, months: int) -> Column:
    return F.add_months(_col(date), -months)


def percent_text(c: Column | str, digits: int) -> Column:
    """A fraction as text such as ``7.5%``, rounding halves to even."""
    return F.format_string(f"%.{digits}f%%", F.bround(_col(c) * 100.0, digits))
