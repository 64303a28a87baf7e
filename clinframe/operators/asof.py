"""Backward as-of attach with a lookback tolerance.

For an anchor at time ``t`` the answer is the most recent feature row with
``t - lookback <= f.t <= t`` (both ends closed) and the same keys.

Spark has no as-of join, so it is expressed with windows over a time-bucketed
union of anchors and features:

* ``_b = floor(t / W)`` with bucket width ``W >= lookback``; the window is
  partitioned by ``(keys, _b)``, so one stay that holds a large share of all
  rows is still cut into many bounded partitions instead of one huge task.
* Feature rows within ``lookback`` of the next bucket start are copied into
  that bucket as well, so every anchor sees all its candidates inside its own
  partition; the copies are never emitted.
* A running ``last(struct(time, value)) IGNORE NULLS`` (unbounded preceding to
  the current row and its peers) yields the latest candidate; it counts only
  if its time is within the lookback.  If the latest is too old, so is every
  earlier one.  Running frames take linear time however dense a day is, and
  several features with different lookbacks share one sort and one exchange.

* A (keys, bucket) of more than ``dense_rows`` rows is a *dense* one: it is cut
  by quantiles of its times into pieces of about that size, the running
  ``last`` stays inside a piece, and one summary row per piece carries the
  latest candidate on to the later pieces, where it is checked against the
  lookback like any other.  So no task holds a whole dense stay-day.  Finding
  the dense ones takes a counting job when the frame is built
  (``dense_rows=None``: no job, no cuts).

Feature rows must be unique per (keys, time) -- pre-aggregate them (with
``max``) as the pivots do; ties are otherwise resolved arbitrarily, as in SQL.
Rows of one time stay in one piece.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinframe.functions.expr import interval_micros, micros_since_epoch
from clinframe.session import CHECKPOINT_SETTING, store

#: Rows of a (keys, bucket) above which it is cut into pieces; the piece's size.
DENSE_ROWS = 4_000_000
#: Most pieces of a dense (keys, bucket).
MOST_PIECES = 4096


def _hours(n) -> str:
    return f"{n} hours"


def _valid(df: DataFrame, by: Sequence[str], time: str):
    ok = F.col(time).isNotNull()
    for k in by:
        ok = ok & F.col(k).isNotNull()
    return ok


def _bucket(column: str, width: int):
    """Exact floor(column / width) in integer arithmetic (also for negatives)."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {int(width)})) div {int(width)}")


def _buckets_with_ghost(width: int, lookback: int):
    """Own bucket, plus the next one when the row is within ``lookback`` of it.

    Exploding this array copies a row into the next bucket without a second
    reference to the input (no self-union).
    """
    b = _bucket("_us", width)
    near_next = F.col("_us") >= (b + 1) * F.lit(width) - F.lit(lookback)
    return F.explode(F.when(near_next, F.array(b, b + 1)).otherwise(F.array(b)))


def dense_cuts(rows: DataFrame, keys: Sequence[str], dense_rows: int | None) -> DataFrame | None:
    """Times that cut each dense group of ``keys`` into pieces: (keys, ``_cuts``), or None without dense groups.

    ``rows`` has the time as ``_us``.  One counting job; where it finds dense
    groups, approximate quantiles of their times are stored (one row a group).
    """
    if dense_rows is None:
        return None
    known = rows.filter(F.col("_us").isNotNull())
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > dense_rows)
    top = sizes.agg(F.max("_n").alias("top")).first().top
    if top is None:
        return None
    pieces = min(-(-top // dense_rows), MOST_PIECES)
    dense = sizes.select(*[F.col(k).alias(f"_d_{k}") for k in keys])
    inside = known.join(dense, [known[k].eqNullSafe(dense[f"_d_{k}"]) for k in keys], "left_semi")
    cuts = inside.groupBy(*keys).agg(F.percentile_approx("_us", [i / pieces for i in range(1, pieces)], max(10_000, 10 * pieces)).alias("_cuts"))
    return store(cuts, "dense-cuts")


def with_piece(rows: DataFrame, keys: Sequence[str], cuts: DataFrame) -> DataFrame:
    """``rows`` with ``_sub``: the piece of a dense group that holds the row's time, else -1."""
    c = cuts.select(*[F.col(k).alias(f"_c_{k}") for k in keys], "_cuts")
    j = rows.join(c, [rows[k].eqNullSafe(c[f"_c_{k}"]) for k in keys], "left")
    piece = F.when(F.col("_cuts").isNull() | F.col("_us").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter("_cuts", lambda t: t < F.col("_us"))))
    return j.select(*rows.columns, piece.alias("_sub"))


def running_latest(timeline: DataFrame, keys: Sequence[str], latest: Mapping[str, object], pieces: bool) -> DataFrame:
    """``timeline`` plus, per entry of ``latest``, the latest non-NULL struct (its time ``_us`` first)
    at or before each row's time within ``keys``; with ``pieces`` also that of the group's earlier pieces."""
    inside = Window.partitionBy(*keys, *(["_sub"] if pieces else [])).orderBy("_us").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = timeline.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(n) for n, c in latest.items()])
    if not pieces:
        return out
    # One summary row per piece of the dense groups, carried over the pieces and joined back.
    last = out.filter(F.col("_sub") >= 0).groupBy(*keys, "_sub").agg(*[F.max_by(n, F.col(f"{n}._us")).alias(n) for n in latest])
    before = Window.partitionBy(*keys).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_sub").alias("_k_sub"),
                        *[F.last(n, ignorenulls=True).over(before).alias(f"_k{n}") for n in latest])
    cond = [out[k].eqNullSafe(carry[f"_k_{k}"]) for k in keys] + [out["_sub"] == carry["_k_sub"]]
    return out.join(carry, cond, "left").select(*timeline.columns, *[F.coalesce(n, f"_k{n}").alias(n) for n in latest])


def asof_attach(anchor: DataFrame, feature: DataFrame, *, by: Sequence[str], value_cols: Sequence[str],
                lookback: str = "4 hours", time: str = "charttime", skip_null_values: bool = True,
                feature_time: str | None = None, bucket: str = "1 day", dense_rows: int | None = DENSE_ROWS,
                bucket_name: str | None = None) -> DataFrame:
    """Attach to every ``anchor`` row the latest ``feature`` row within ``lookback``.

    Anchor rows are all kept (NULLs when nothing qualifies).  With
    ``skip_null_values`` the latest row having any non-NULL value column is
    taken; without it the latest row is taken even when its values are NULL
    (SQL ``row_number() ... = 1`` over a LEFT JOIN).  ``feature_time`` names an
    optional output column with the matched feature's time.  ``bucket_name``
    names one with the anchor's bucket, for an operator that goes on with the
    same partitioning (:func:`asof_candidates`).
    """
    lb = interval_micros(lookback)
    width = max(interval_micros(bucket), lb)
    payload_cols = list(value_cols) + ([feature_time] if feature_time else [])

    # Anchors with a NULL key or time stay in the timeline; no feature can
    # share their (NULL) partition or order value, so they attach NULLs.
    a = anchor.withColumn("_us", micros_since_epoch(time)).withColumn("_is_anchor", F.lit(True))

    f = feature.filter(_valid(feature, by, time))
    if skip_null_values:
        f = f.filter(F.coalesce(*[F.col(c) for c in value_cols]).isNotNull())
    hit = F.struct(*[F.col(c).alias(c) for c in value_cols],
                   *([F.col(time).alias(feature_time)] if feature_time else []))
    f = f.select(*by, micros_since_epoch(time).alias("_us"), hit.alias("_hit"),
                 F.lit(False).alias("_is_anchor"))

    a = a.withColumn("_b", _bucket("_us", width))
    f = f.withColumn("_b", _buckets_with_ghost(width, lb))
    timeline = a.unionByName(f, allowMissingColumns=True)

    keys = [*by, "_b"]
    cuts = dense_cuts(timeline.select(*keys, "_us"), keys, dense_rows)
    if cuts is not None:
        timeline = with_piece(timeline, keys, cuts)
    latest = {"_got": F.when(F.col("_hit").isNotNull(), F.struct("_us", "_hit"))}
    got = running_latest(timeline, keys, latest, cuts is not None).filter(F.col("_is_anchor"))
    near = F.col("_us") - F.col("_got._us") <= lb
    return got.select(*anchor.columns, *[F.when(near, F.col(f"_got._hit.{c}")).alias(c) for c in payload_cols],
                      *([F.col("_b").alias(bucket_name)] if bucket_name else []))


def asof_candidates(anchor: DataFrame, feature: DataFrame, *, by: Sequence[str], value_cols: Sequence[str],
                    lookback: str = "4 hours", time: str = "charttime", rank_name: str = "rn",
                    bucket_name: str | None = None) -> DataFrame:
    """All feature rows inside each anchor's lookback window, numbered newest first.

    A LEFT range join: anchors without candidates get one row of NULLs with
    ``rank_name`` = 1.  The join is an equi join on ``(keys, bucket)`` with
    bucket width = lookback (features are copied into the bucket their
    window reaches), so only nearby rows are ever compared -- never all rows
    of a stay.  ``bucket_name``: a column of ``anchor`` that already is its
    bucket of that width (it is dropped); the anchors keep its partitioning.
    """
    lb = max(interval_micros(lookback), 1)
    a = anchor.withColumnRenamed(bucket_name, "_ab") if bucket_name else \
        anchor.withColumn("_us", micros_since_epoch(time)).withColumn("_ab", _bucket("_us", lb))
    f = (feature.filter(_valid(feature, by, time))
         .withColumn("_fus", micros_since_epoch(time)).withColumn("_fus_end", F.col("_fus") + F.lit(lb))
         .select(*[F.col(k).alias(f"_f_{k}") for k in by], F.col(time).alias("_ft"),
                 *[F.col(c).alias(f"_v_{c}") for c in value_cols],
                 F.explode(F.sequence(_bucket("_fus", lb), _bucket("_fus_end", lb))).alias("_fb")))
    cond = ([a[k] == f[f"_f_{k}"] for k in by] + [a["_ab"] == f["_fb"]]
            + [f["_ft"] >= a[time] - F.expr(f"INTERVAL {lookback}"), f["_ft"] <= a[time]])
    j = a.join(f, cond, "left")
    # The bucket is a function of the anchor time, so (keys, bucket, time) are
    # the same groups as (keys, time); listing it lets the join's (keys,
    # bucket) partitioning satisfy the window without another exchange.
    w = Window.partitionBy(*by, "_ab", time).orderBy(F.col("_ft").desc_nulls_first())
    return j.select(*[c for c in anchor.columns if c != bucket_name], F.row_number().over(w).cast("long").alias(rank_name),
                    *[F.col(f"_v_{c}").alias(c) for c in value_cols])


def match_values(values: DataFrame, anchor: str = "pao2", features: Mapping[str, int] | None = None,
                 *, by: Sequence[str] = ("icustay_id",), ids: Sequence[str] = ("subject_id", "hadm_id"),
                 time: str = "charttime", anchor_alias: str = "pao2", bucket: str = "1 day",
                 dense_rows: int | None = DENSE_ROWS) -> DataFrame:
    """For each row with a non-NULL ``anchor``, the latest non-NULL value of
    every feature within its lookback (hours), on one merged timeline.

    One exchange on (stay, day bucket), one sort, one Window operator for all
    features -- instead of a chain of range joins.  ``values`` must be unique
    per (keys, time), as the merge makes it: each row is an anchor of its own,
    where :func:`match_values_chain` would keep one of several equal anchors.
    """
    from clinframe.functions.rules import MATCH_FEATURES
    features = dict(features or MATCH_FEATURES)
    lbs = {name: interval_micros(_hours(h)) for name, h in features.items()}
    max_lb = max(lbs.values())
    width = max(interval_micros(bucket), max_lb)

    keep = F.coalesce(F.col(anchor), *[F.col(n) for n in features]).isNotNull()
    # A row with a NULL key or time can be an anchor but never a feature (its
    # features are masked); it attaches NULLs, as BETWEEN with NULL would.
    # The features travel as one struct, which keeps the plan's constraints few.
    v = values.filter(keep).select(*ids, *by, time, F.col(anchor).alias("_anchor"),
                                   F.when(_valid(values, by, time), F.struct(*features)).alias("_f"))
    v = v.withColumn("_us", micros_since_epoch(time))
    own = _bucket("_us", width)
    timeline = (v.withColumn("_own", own).withColumn("_b", _buckets_with_ghost(width, max_lb))
                .withColumn("_emit", F.coalesce(F.col("_b") == F.col("_own"), F.lit(True)) & F.col("_anchor").isNotNull()))
    keys = [*by, "_b"]
    cuts = dense_cuts(timeline.select(*keys, "_us"), keys, dense_rows)
    if cuts is not None:
        timeline = with_piece(timeline, keys, cuts)
    out = attach_latest(timeline, keys, features, lbs, cuts is not None)
    return out.select(*ids, *by, time, F.col("_anchor").alias(anchor_alias), *features)


def attach_latest(timeline: DataFrame, keys: Sequence[str], features: Sequence[str], lookbacks: Mapping[str, int], pieces: bool) -> DataFrame:
    """Rows of ``timeline`` marked ``_emit`` with, per feature of the struct ``_f``, its latest non-NULL value within its lookback."""
    latest = {f"_l_{n}": F.when(F.col(f"_f.{n}").isNotNull(), F.struct("_us", F.col(f"_f.{n}").alias("v"))) for n in features}
    out = running_latest(timeline, keys, latest, pieces).filter("_emit")
    return out.select("*", *[F.when(F.col("_us") - F.col(f"_l_{n}._us") <= lookbacks[n], F.col(f"_l_{n}.v")).alias(n) for n in features])


def match_values_chain(values: DataFrame, anchor: str = "pao2", features: Mapping[str, int] | None = None,
                       *, by: Sequence[str] = ("icustay_id",), ids: Sequence[str] = ("subject_id", "hadm_id"),
                       time: str = "charttime", anchor_alias: str = "pao2") -> DataFrame:
    """:func:`match_values` in the study's shape: one range join + ``row_number() = 1``
    per feature, chained.  Same result where (keys, time) is unique, else one row
    per (keys, time); kept to measure the two forms against each other (each
    link adds two exchanges).

    Every link reads ``values``, so they are stored first (without rows that are
    neither anchor nor feature), or else a derived view would be derived anew per
    link: this runs a job when the frame is built.  Where ``spark.checkpoint.dir``
    is unset nothing is stored.
    """
    from clinframe.functions.rules import MATCH_FEATURES
    features = dict(features or MATCH_FEATURES)
    read = list(dict.fromkeys([*ids, *by, time, anchor, *features]))
    values = values.filter(reduce(or_, [F.col(n).isNotNull() for n in (anchor, *features)])).select(*read)
    if values.sparkSession.conf.get(CHECKPOINT_SETTING, None):
        values = store(values, "match-values")
    cur = values.filter(F.col(anchor).isNotNull()).select(*ids, *by, time, F.col(anchor).alias(anchor_alias))
    for name, hours in features.items():
        feat = values.filter(F.col(name).isNotNull()).select(*by, time, name)
        cur = (asof_candidates(cur, feat, by=by, value_cols=[name], lookback=_hours(hours), time=time,
                               rank_name="_rn")
               .filter(F.col("_rn") == 1).drop("_rn"))
    return cur


def carry_forward(df: DataFrame, *, by: Sequence[str], time: str, value, name: str,
                  bucket: str = "1 day", tiebreak: str | None = None) -> DataFrame:
    """``df`` plus ``name`` = the latest non-NULL ``value`` among rows with the
    same ``by`` keys at or before each row's time (no lookback limit).

    Computed per ``(keys, time bucket)`` with a running ``last``, plus a
    carry-in from earlier buckets: a summary of one row per key and bucket,
    carried over the buckets and joined back on (keys, bucket).  So a key
    holding a large share of the rows is split by time everywhere.  Rows with equal times are ordered by ``tiebreak`` (they
    must otherwise have distinct times within a key).
    """
    width = interval_micros(bucket)
    value = F.col(value) if isinstance(value, str) else value
    x = (df.withColumn("_us", micros_since_epoch(time)).withColumn("_b", _bucket("_us", width))
         .withColumn("_val", value))
    order = ["_us"] + ([tiebreak] if tiebreak else [])
    running = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_in", F.last("_val", ignorenulls=True).over(running))
    # Summary: the last value of every bucket, then the last one of all earlier buckets.
    summary = x.groupBy(*by, "_b").agg(F.max_by("_val", F.when(F.col("_val").isNotNull(), F.col("_us"))).alias("_last"))
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(*[F.col(k).alias(f"_c_{k}") for k in by], F.col("_b").alias("_c_b"),
                           F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
    cond = [x[k].eqNullSafe(carry[f"_c_{k}"]) for k in by] + [x["_b"].eqNullSafe(carry["_c_b"])]
    out = x.join(carry, cond, "left")
    return out.select(*df.columns, F.coalesce(F.col("_in"), F.col("_carry")).alias(name))
