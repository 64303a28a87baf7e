"""``rank()`` / ``row_number()`` over a time order without one task per key.

A plain window sends every row of a partition key to one task; if one
subject or admission holds a large share of the rows, that task holds the
stage.  Here the rows are ranked inside ``(key, time bucket)`` partitions and
each bucket's rank is shifted by the number of rows in the earlier buckets of
the key:

    rank = (rows of the key in earlier buckets) + (local rank in the bucket)

The per-bucket counts come from a partially aggregated ``groupBy`` and their
running sum is a window over at most (time span / bucket width) rows per key,
so only that small table is ever grouped by the key alone.  ``rank`` needs no
window over the rows at all (see :func:`_rank_by_counts`), so even a huge
tie or NULL group costs one aggregated row.  The result equals the plain
window (``row_number`` ties are arbitrary in both).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinframe.functions.expr import interval_micros, micros_since_epoch

_LONG_MIN, _LONG_MAX = -(2 ** 63), 2 ** 63 - 1


def bucketed_rank(df: DataFrame, partition_cols: Sequence[str], order_col: str, *, name: str = "rank",
                  descending: bool = False, nulls_first: bool | None = None, method: str = "rank",
                  bucket: str = "1 day") -> DataFrame:
    """``df`` plus ``name`` = rank/row_number over (partition_cols, order_col).

    Default NULL placement follows PostgreSQL: last when ascending, first
    when descending.  ``df`` is read for the rows and for the counts: pass a
    stored one (:func:`clinframe.session.store`) where it is itself a join or
    an aggregate.
    """
    if nulls_first is None:
        nulls_first = descending
    width = interval_micros(bucket)
    fn = {"rank": F.rank, "row_number": F.row_number}[method]
    order = F.col(order_col)
    order = (order.desc_nulls_first() if nulls_first else order.desc_nulls_last()) if descending else \
        (order.asc_nulls_first() if nulls_first else order.asc_nulls_last())

    us = micros_since_epoch(order_col)
    b = F.expr(f"(`_ous` - pmod(`_ous`, {width})) div {width}")
    rb = F.when(F.col(order_col).isNull(), F.lit(_LONG_MIN if nulls_first else _LONG_MAX)) \
          .otherwise(-b if descending else b)
    x = df.withColumn("_ous", us).withColumn("_rb", rb).drop("_ous")

    if method == "rank":
        return _rank_by_counts(df, x, partition_cols, order_col, order, name)

    local = x.withColumn("_local", fn().over(Window.partitionBy(*partition_cols, "_rb").orderBy(order)))
    counts = x.groupBy(*partition_cols, "_rb").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*partition_cols).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_o_{c}") for c in partition_cols], F.col("_rb").alias("_o_rb"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in partition_cols] + [local["_rb"] == offsets["_o_rb"]]
    out = local.join(offsets, cond, "inner")
    return out.select(*df.columns, (F.col("_off") + F.col("_local")).cast("long").alias(name))


def _rank_by_counts(df: DataFrame, x: DataFrame, partition_cols, order_col: str, order, name: str) -> DataFrame:
    """rank = 1 + rows before the value: counts per (key, bucket, value) are
    partially aggregated (a tie group of any size becomes one row), summed
    over the earlier values of the bucket and over the earlier buckets of the
    key, then joined back -- no window ever runs over the raw rows."""
    keys = [*partition_cols, "_rb"]
    cnt = x.select(*keys, order_col).groupBy(*keys, order_col).agg(F.count(F.lit(1)).alias("_n"))
    earlier_value = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    cnt = cnt.withColumn("_before_v", F.coalesce(F.sum("_n").over(earlier_value), F.lit(0)))
    totals = cnt.groupBy(*keys).agg(F.sum("_n").alias("_bn"))
    earlier_bucket = Window.partitionBy(*partition_cols).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(k).alias(f"_t_{k}") for k in keys],
                           F.coalesce(F.sum("_bn").over(earlier_bucket), F.lit(0)).alias("_before_b"))
    tcond = [cnt[k].eqNullSafe(totals[f"_t_{k}"]) for k in keys]
    ranks = cnt.join(totals, tcond, "inner").select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.col(order_col).alias("_r_v"),
        (F.col("_before_b") + F.col("_before_v") + 1).cast("long").alias(name))
    cond = [x[k].eqNullSafe(ranks[f"_r_{k}"]) for k in keys] + [x[order_col].eqNullSafe(ranks["_r_v"])]
    return x.join(ranks, cond, "inner").select(*df.columns, name)


def latest_per_group(df: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """One row per group: the one a descending ``row_number() = 1`` takes, NULL times first.

    Rows of equal time are ordered by ``tiebreak``, descending with NULLs last,
    so the result is defined; rows equal in all of these are interchangeable.
    As the maximum of a struct it combines map-side and needs no window: a group
    that holds a third of all rows costs one row per task.  Returns keys, time,
    ``tiebreak`` and ``values`` (which order last).
    """
    total = F.struct(F.col(time).isNull().alias("_none"), F.col(time).alias(time), *[F.col(c).alias(c) for c in [*tiebreak, *values]])
    return df.groupBy(*keys).agg(F.max(total).alias("_top")).select(*keys, f"_top.{time}", *[f"_top.{c}" for c in [*tiebreak, *values]])
