"""Zone-independent time bucketing of epoch-millisecond columns.

The reference renders ``serverTs`` / ``ts`` (epoch ms) as UTC day and hour
strings. Integer arithmetic keeps the result independent of the session time
zone and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_DAY = 86_400_000
MS_PER_HOUR = 3_600_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_date(ms) -> Column:
    """UTC calendar date of an epoch-millisecond value (floor semantics)."""
    ms = _col(ms)
    days = (ms - F.pmod(ms, F.lit(MS_PER_DAY))) / F.lit(MS_PER_DAY)
    return F.date_from_unix_date(days.cast("int"))


def epoch_ms_to_day(ms) -> Column:
    """``yyyy-MM-dd`` string of the UTC day."""
    return F.date_format(epoch_ms_to_date(ms), "yyyy-MM-dd")


def epoch_ms_to_hour(ms) -> Column:
    """Two-digit UTC hour string ``HH``."""
    ms = _col(ms)
    hour = (F.pmod(ms, F.lit(MS_PER_DAY)) / F.lit(MS_PER_HOUR)).cast("int")
    return F.lpad(hour.cast("string"), 2, "0")


def slot_filter(dt_col="dt", h_col="h", begin=None, end=None) -> Column:
    """Half-open hour-slot predicate ``begin <= (dt, h) < end`` on the
    partition columns. ``begin``/``end`` are ``datetime`` (hour resolution)
    or ``None`` for an open side. The day bounds are emitted separately so
    that partition pruning sees a plain range on ``dt``.
    """
    cond = F.lit(True)
    dt, h = _col(dt_col), _col(h_col)
    if begin is not None:
        bd = F.lit(begin.date())
        cond = cond & (dt >= bd) & ((dt > bd) | (h >= F.lit(begin.hour)))
    if end is not None:
        ed = F.lit(end.date())
        cond = cond & (dt <= ed) & ((dt < ed) | (h < F.lit(end.hour)))
    return cond


def day_filter(dt_col="dt", begin=None, end=None) -> Column:
    """Inclusive day-range predicate ``begin <= dt <= end`` (dates or None)."""
    cond = F.lit(True)
    dt = _col(dt_col)
    if begin is not None:
        cond = cond & (dt >= F.lit(begin))
    if end is not None:
        cond = cond & (dt <= F.lit(end))
    return cond
