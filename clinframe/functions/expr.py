"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinframe.functions.rules import F_TO_C, KEEP, PERCENT, Range

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_test(v: Column, r: Range) -> Column:
    cond = F.lit(True)
    if r.lo is not None:
        cond = cond & ((v >= F.lit(float(r.lo))) if r.lo_incl else (v > F.lit(float(r.lo))))
    if r.hi is not None:
        cond = cond & ((v <= F.lit(float(r.hi))) if r.hi_incl else (v < F.lit(float(r.hi))))
    return cond


def apply_transform(v: Column, transform: str) -> Column:
    if transform == KEEP:
        return v
    if transform == PERCENT:
        return v * F.lit(100.0)
    if transform == F_TO_C:
        return (v - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)
    raise ValueError(f"unknown transform {transform!r}")


def rule_value(item, value, rules) -> Column:
    """Cleaned value: transform of the first range accepting ``value`` for ``item``.

    Rendered as one searched CASE; Catalyst turns long item lists into InSet.
    """
    item, value = col(item), col(value)
    expr = None
    for items, ranges in rules:
        member = item.isin(list(items))
        for r in ranges:
            cond = member & range_test(value, r)
            out = apply_transform(value, r.transform)
            expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(F.lit(None).cast("double"))


def micros_since_epoch(ts) -> Column:
    """Microseconds since 1970-01-01 for TIMESTAMP_NTZ (no time-zone shift)."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {_sql(ts)})")


def seconds_between(start, end) -> Column:
    """Epoch seconds of ``end - start`` as double, microsecond exact."""
    return F.expr(f"timestampdiff(MICROSECOND, {_sql(start)}, {_sql(end)})") / F.lit(1e6)


def days_between(start, end) -> Column:
    """Elapsed days, computed as seconds / 60 / 60 / 24 in that order."""
    return seconds_between(start, end) / F.lit(60.0) / F.lit(60.0) / F.lit(24.0)


def years_between(start, end, days_per_year: float = 365.242) -> Column:
    return days_between(start, end) / F.lit(float(days_per_year))


def shift(ts, interval: str) -> Column:
    """``ts + INTERVAL <interval>``; ``interval`` like ``'-6 hours'`` or ``'1 day'``."""
    interval = interval.strip()
    if interval.startswith("-"):
        return F.expr(f"{_sql(ts)} - INTERVAL {interval[1:]}")
    return F.expr(f"{_sql(ts)} + INTERVAL {interval}")


def interval_micros(interval: str) -> int:
    """Length of a simple interval string (``'4 hours'``, ``'1 day'``) in microseconds."""
    n, unit = interval.strip().split()
    unit = unit.lower().rstrip("s")
    scale = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
             "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}[unit]
    return int(float(n) * scale)


def is_distinct_from(a, b) -> Column:
    """SQL ``a IS DISTINCT FROM b`` (NULL vs value is true, NULL vs NULL false)."""
    return ~col(a).eqNullSafe(col(b) if not isinstance(b, (int, float, str)) else F.lit(b))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("pass a column name")


def bucket_of(column: str, width_us: int) -> Column:
    """Exact floor(micros(column) / width) for a TIMESTAMP_NTZ column name."""
    us = f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{column}`)"
    return F.expr(f"({us} - pmod({us}, {int(width_us)})) div {int(width_us)}")


#: Most buckets that one window may touch: 27 years of days.
MOST_BUCKETS = 10_000


def buckets_between(lo: str, hi: str, width_us: int) -> Column:
    """Every bucket id from ``lo``'s to ``hi``'s (one row each when exploded);
    NULL when either bound is NULL or ``hi < lo``.

    A window of more than :data:`MOST_BUCKETS` buckets (an end in the year 9999,
    say) is an error of the data: the query stops and names its bounds instead
    of listing the window millions of times."""
    a, b = bucket_of(lo, width_us), bucket_of(hi, width_us)
    far = F.raise_error(F.concat(F.lit("window of too many buckets: "), F.col(lo).cast("string"), F.lit(" to "), F.col(hi).cast("string")))
    return F.when(b - a >= MOST_BUCKETS, far.cast("array<bigint>")).when(b >= a, F.sequence(a, b))
