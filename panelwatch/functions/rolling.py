"""Row-count window expressions.

Every function takes the *series window* (partitioning and order, no frame) and
returns a column.  A value appears only once ``min_periods`` non-null rows are
in the frame.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwatch.functions.scalar import _col, clip_lower


def frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), W.currentRow)


def _guard(x: Column, w: WindowSpec, n: int, min_periods: int | None, value: Column) -> Column:
    return F.when(F.count(x).over(frame(w, n)) >= (min_periods or n), value)


def log_return(x, n: int, w: WindowSpec) -> Column:
    x = _col(x)
    return F.ln(F.try_divide(x, F.lag(x, n).over(w)))


def diff(x, n: int, w: WindowSpec) -> Column:
    """Positional difference: null rows count as rows."""
    x = _col(x)
    return x - F.lag(x, n).over(w)


def pct_change(x, n: int, w: WindowSpec) -> Column:
    x = _col(x)
    return (F.try_divide(x, F.lag(x, n).over(w)) - F.lit(1.0)) * F.lit(100.0)


def ffill(x, w: WindowSpec) -> Column:
    return F.last(_col(x), ignorenulls=True).over(
        w.rowsBetween(W.unboundedPreceding, W.currentRow)
    )


def rolling_mean(x, n: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    x = _col(x)
    return _guard(x, w, n, min_periods, F.avg(x).over(frame(w, n)))


def rolling_std(x, n: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    x = _col(x)
    return _guard(x, w, n, min_periods, F.stddev_samp(x).over(frame(w, n)))


def rolling_z(x, n: int, w: WindowSpec, floor: float | None = None) -> Column:
    """(x - mean) / sample std over ``n`` rows; a zero std gives null unless floored."""
    x = _col(x)
    sigma = F.stddev_samp(x).over(frame(w, n))
    off = x - F.avg(x).over(frame(w, n))
    if floor is None:
        z = F.try_divide(off, sigma)
    else:
        # The mean of equal values may be off by a rounding step, which a tiny
        # floor would blow up; their deviation is 0.
        z = F.when(sigma == 0, F.lit(0.0)).otherwise(off / clip_lower(sigma, floor))
    return _guard(x, w, n, None, z)


def rolling_quantile(x, n: int, q: float, w: WindowSpec, min_periods: int | None = None) -> Column:
    """Linear-interpolated quantile; for short frames only (cost grows with n)."""
    x = _col(x)
    return _guard(x, w, n, min_periods or n // 2, F.percentile(x, F.lit(q)).over(frame(w, n)))


__all__ = [
    "diff",
    "ffill",
    "frame",
    "log_return",
    "pct_change",
    "rolling_mean",
    "rolling_quantile",
    "rolling_std",
    "rolling_z",
]
