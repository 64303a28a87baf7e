"""From the raw event logs to the match table under one exchange.

The study pivots the charts, pivots the labs, joins the two and attaches the
latest features, each step with shuffles of its own.  Here all four steps use
one partitioning, (subject, admission, day bucket):

1. charted and laboratory events, labelled and cleaned, form one long table;
   an event close to the end of its day is listed in the next one as well
   (before anything is merged, so no later step has to move it);
2. that table is exchanged once, and the stays, listed once per day their
   window touches, join it there;
3. grouping by (stay, day, time) is both pivots and the merge at once: an
   event's label says which column of which source it fills;
4. the running windows of the match run per (stay, day).

Grouping and windows extend the keys of the exchange, so Spark needs no other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.functions.expr import buckets_between, interval_micros, micros_since_epoch
from clinframe.functions.rules import item_rules, ruled_value
from clinframe.operators.asof import DENSE_ROWS, _bucket, _buckets_with_ghost, attach_latest, dense_cuts, with_piece
from clinframe.operators.merge import SHARED

STAY_KEYS = ("subject_id", "hadm_id", "icustay_id")
ADMISSION = ("subject_id", "hadm_id")


def _signals(events: DataFrame, items: Sequence[int], labels: Mapping[str, Sequence[int]], rules, stay, known: Sequence[str],
             time: str) -> DataFrame:
    """(subject, admission, ``_stay``, time, signal, value) of the labelled events whose cleaned value isn't NULL."""
    ok = F.col("itemid").isin(list(items)) & F.col(time).isNotNull()
    for k in known:
        ok = ok & F.col(k).isNotNull()
    e = events.filter(ok).join(item_rules(events.sparkSession, items, labels, rules), "itemid", "inner")
    e = e.select(*ADMISSION, stay.cast("long").alias("_stay"), time, F.col("label").alias("signal"), ruled_value("valuenum").alias("value"))
    return e.filter(F.col("signal").isNotNull() & F.col("value").isNotNull())


def signal_events(chartevents: DataFrame, labevents: DataFrame, version: str = "v1.2", time: str = "charttime",
                  fio2_range: tuple[float, float] | None = None, keep_negative_base_excess: bool = False) -> DataFrame:
    """Both logs in long form.  Signals that both sources measure end in ``_c`` (charted) or ``_l`` (laboratory)."""
    labels, value_rules = R.CHART_VERSIONS[version]
    charted = {src: f"{name}_c" for name, src, _ in SHARED}
    tested = {src: f"{name}_l" for name, _, src in SHARED}
    chart_labels = {charted.get(n, n): ids for n, ids in labels.items()}
    lab_labels: dict[str, list[int]] = {}
    for item, label in R.LAB_PF_LABELS.items():
        if label in tested:
            lab_labels.setdefault(tested[label], []).append(item)
    lab_items = [i for i in R.LAB_IN_STAY_ITEMS if any(i in ids for ids in lab_labels.values())]
    lab_rules = R.capped_rules(R.LAB_IN_STAY_ITEMS, R.LAB_PF_CAPS, fio2_range, keep_negative_base_excess)
    chart = _signals(chartevents, [i for ids in labels.values() for i in ids], chart_labels, value_rules, F.col("icustay_id"), STAY_KEYS, time)
    labs = _signals(labevents, lab_items, lab_labels, lab_rules, F.lit(None), ADMISSION, time)
    return chart.unionByName(labs)


def match_from_logs(stays: DataFrame, chartevents: DataFrame, labevents: DataFrame, anchor: str = "pao2",
                    features: Mapping[str, int] | None = None, *, version: str = "v1.2", time: str = "charttime",
                    anchor_alias: str = "pao2", bucket: str = "1 day", dense_rows: int | None = DENSE_ROWS, **lab_options) -> DataFrame:
    """The match table of ``stays`` straight from the two logs.

    Equals :func:`clinframe.operators.asof.match_values` over the merged pivots
    of the same stays (``icustay_id`` names one admission): one row per time at
    which ``anchor`` (``pao2``, ``pao2_c`` or ``pao2_l``) has a value, with the
    latest value of every feature within its lookback in hours.

    A (subject, admission, day) of more than ``dense_rows`` events is cut into
    pieces of its time, see :mod:`clinframe.operators.asof`; counting them is a
    job of its own over four columns of the logs, run when the frame is built.
    The events of one stay at one instant meet in one task.
    """
    features = dict(features or R.MATCH_FEATURES)
    lookbacks = {n: interval_micros(f"{h} hours") for n, h in features.items()}
    reach = max(lookbacks.values())
    width = max(interval_micros(bucket), reach)

    e = signal_events(chartevents, labevents, version, time, **lab_options)
    e = e.withColumn("_us", micros_since_epoch(time)).withColumn("_b", _buckets_with_ghost(width, reach))
    s = stays.select(*[F.col(k).alias(f"_s_{k}") for k in STAY_KEYS], F.col("intime").alias("_lo"), F.col("outtime").alias("_hi"))
    s = s.withColumn("_s_b", F.explode(buckets_between("_lo", "_hi", width)))

    day = [*ADMISSION, "_b"]
    cuts = dense_cuts(e.select(*day, "_us"), day, dense_rows)
    piece = [] if cuts is None else ["_sub"]
    if cuts is not None:
        e = with_piece(e, day, cuts)
        c = cuts.select(*[F.col(k).alias(f"_c_{k}") for k in day], "_cuts")
        s = s.join(c, [s[f"_s{k}" if k == "_b" else f"_s_{k}"] == c[f"_c_{k}"] for k in day], "left")
        s = s.withColumn("_s_sub", F.explode(F.when(F.col("_cuts").isNull(), F.array(F.lit(-1)))
                                             .otherwise(F.sequence(F.lit(0), F.size("_cuts"))))).drop("_cuts", *[f"_c_{k}" for k in day])
    e = e.repartition(*day, *piece)
    cond = ([e[k] == s[f"_s_{k}"] for k in ADMISSION] + [e[k] == s[f"_s{k}"] for k in ("_b", *piece)]
            + [e["_stay"].isNull() | (e["_stay"] == s["_s_icustay_id"]), e[time] >= s["_lo"], e[time] <= s["_hi"]])
    rows = e.join(s, cond, "inner").select(*ADMISSION, F.col("_s_icustay_id").alias("icustay_id"), "_b", *piece, time, "_us", "signal", "value")

    shared = [f"{name}_{side}" for name, _, _ in SHARED for side in "cl"]
    single = [n for n in features if n not in {name for name, _, _ in SHARED}]
    merged = rows.groupBy(*STAY_KEYS, "_b", *piece, time, "_us").agg(
        *[F.max(F.when(F.col("signal") == n, F.col("value"))).alias(n) for n in [*single, *shared]])
    for name, _, _ in SHARED:  # the laboratory's value goes first
        merged = merged.withColumn(name, F.coalesce(f"{name}_l", f"{name}_c"))
    own = F.col("_b") == _bucket("_us", width)
    timeline = merged.select(*STAY_KEYS, "_b", *piece, time, "_us", F.col(anchor).alias("_anchor"), F.struct(*features).alias("_f"),
                             (own & F.col(anchor).isNotNull()).alias("_emit"))
    out = attach_latest(timeline, [*STAY_KEYS, "_b"], list(features), lookbacks, cuts is not None)
    return out.select(*STAY_KEYS, time, F.col("_anchor").alias(anchor_alias), *features)
