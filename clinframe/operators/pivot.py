"""Long event logs to one row per (stay, time): window join + conditional-max pivot.

Plan shape (the same for every pivot): the filtered event log is band-joined
to the stay windows -- equi join on (ids, day bucket), each stay listed once
per day its window touches, then the closed time range -- and to the rules of
its items, partially aggregated map-side, shuffled once on (stay ids, time)
(so one long stay spreads over many tasks) and finally aggregated.

Stays without any event get one row with a NULL time, as LEFT JOIN + GROUP BY
gives.  This takes no second pass: every stay adds a NULL-time row, every
joined event adds a marker to its stay's NULL-time group (markers collapse
map-side), and marked groups are dropped after the aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.functions.expr import bucket_of, buckets_between, interval_micros, is_distinct_from, shift
from clinframe.functions.rules import item_rules, ruled_value
from clinframe.operators.rank import bucketed_rank
from clinframe.session import store

STAY_KEYS = ("subject_id", "hadm_id", "icustay_id")


def _bound(spec):
    column, offset = spec
    return shift(column, offset) if offset else F.col(column)


def stage_events(stays: DataFrame, events: DataFrame, *, join_keys: Sequence[str], start, end,
                 labels: Mapping[str, Sequence[int]], rules, items: Sequence[int] | None = None,
                 stay_cols: Sequence[str] = STAY_KEYS, time: str = "charttime", text: str | None = None,
                 band: str = "1 day") -> DataFrame:
    """The events inside each stay's ``[start, end]`` window in long form, one row
    per (stay, event): stay columns, time, itemid, label and cleaned ``value``
    (and ``text``, the named column as text).

    ``start``/``end`` are ``(stay column, interval or None)``, e.g.
    ``("intime", "-6 hours")``.  ``labels`` maps a label to its items, ``items``
    (default: all labelled ones) is what is fetched, ``rules`` as in
    :mod:`clinframe.functions.rules`.  Items, labels and ranges are joined as a
    small table (one row per item), so plans stay short however long the
    vocabulary is.  Rows with a NULL key or time belong to no window.
    """
    items = list(items if items is not None else (i for ids in labels.values() for i in ids))
    width = interval_micros(band)
    # Band join: each stay is listed once per day bucket its window touches and
    # each event carries its own bucket, so the equi key (ids, bucket) only
    # pairs an event with the stays whose window reaches that day -- never
    # with every stay of a large admission -- and a long stay is split by day.
    s_cols = list(dict.fromkeys([*stay_cols, *join_keys]))
    s = (stays.select(*[F.col(c).alias(f"_s_{c}") for c in s_cols],
                      _bound(start).alias("_lo"), _bound(end).alias("_hi"))
         .withColumn("_s_b", F.explode(buckets_between("_lo", "_hi", width))))
    known = F.col(time).isNotNull()
    for k in join_keys:
        known = known & F.col(k).isNotNull()
    e = events.filter(F.col("itemid").isin(items) & known)
    e = e.join(item_rules(events.sparkSession, items, labels, rules), "itemid", "inner")
    e = e.select(*join_keys, time, "itemid", "label", ruled_value("valuenum").alias("_value"),
                 *([F.col(text).cast("string").alias("_text")] if text else []), bucket_of(time, width).alias("_e_b"))
    cond = ([e[k] == s[f"_s_{k}"] for k in join_keys] + [e["_e_b"] == s["_s_b"]]
            + [e[time] >= s["_lo"], e[time] <= s["_hi"]])
    return e.join(s, cond, "inner").select(
        *[F.col(f"_s_{c}").alias(c) for c in stay_cols], time, "itemid", "label", F.col("_value").alias("value"),
        *([F.col("_text").alias("text")] if text else []))


def window_pivot(stays: DataFrame, staged: DataFrame, *, outputs: Sequence[str], text_outputs: Sequence[str] = (),
                 keep_empty: bool = True, stay_cols: Sequence[str] = STAY_KEYS, time: str = "charttime") -> DataFrame:
    """Pivot of :func:`stage_events`: one row per (stay ids, time), each name in
    ``outputs`` the maximum value with that label (``text_outputs`` the maximum
    text).  Rows whose item has no label still form their group, with NULLs.

    Groups are formed on all stay columns.  With ``keep_empty`` stays without
    events give one row with a NULL time (see the module docstring).
    """
    cols = ["label", "value", *(["text"] if text_outputs else [])]
    rows = staged.select(*stay_cols, time, *cols)
    if keep_empty:
        kinds = dict(rows.dtypes)
        null = lambda c: F.lit(None).cast(kinds[c]).alias(c)
        event = F.struct(time, *cols, F.lit(False).alias("_marker"))
        marker = F.struct(null(time), *[null(c) for c in cols], F.lit(True).alias("_marker"))
        rows = rows.select(*stay_cols, F.inline(F.array(event, marker)))
        rows = rows.unionByName(stays.select(*stay_cols, null(time), *[null(c) for c in cols], F.lit(False).alias("_marker")))
    aggs = ([F.max(F.when(F.col("label") == n, F.col("text"))).alias(n) for n in text_outputs]
            + [F.max(F.when(F.col("label") == n, F.col("value"))).alias(n) for n in outputs])
    if not keep_empty:
        return rows.groupBy(*stay_cols, time).agg(*aggs)
    pivot = rows.groupBy(*stay_cols, time).agg(*aggs, F.max("_marker").alias("_marked"))
    return pivot.filter(~F.col("_marked")).drop("_marked")


def stage_chart(stays: DataFrame, chartevents: DataFrame, version: str = "v1.2", band: str = "1 day") -> DataFrame:
    """Charted vital signs inside [intime, outtime], labelled and cleaned, in long form."""
    labels, value_rules = R.CHART_VERSIONS[version]
    return stage_events(stays, chartevents, join_keys=STAY_KEYS, start=("intime", None), end=("outtime", None),
                        labels=labels, rules=value_rules, band=band)


def chart_pivot(stays: DataFrame, chartevents: DataFrame, version: str = "v1.2", keep_empty: bool = True,
                band: str = "1 day") -> DataFrame:
    """Charted vital signs per (stay, time) inside [intime, outtime].

    ``version`` selects the label vocabulary and cleaning rules: ``base``
    (15 signals), ``v1.1`` or ``v1.2`` (18 signals; the default).
    """
    return window_pivot(stays, stage_chart(stays, chartevents, version, band),
                        outputs=list(R.CHART_VERSIONS[version][0]), keep_empty=keep_empty)


def stage_labs(stays: DataFrame, labevents: DataFrame, *, items: Sequence[int], labels: Mapping[int, str],
               caps: Mapping[int, float], start=("intime", None), end=("outtime", None), text: bool = False,
               fio2_range: tuple[float, float] | None = None, keep_negative_base_excess: bool = False,
               band: str = "1 day") -> DataFrame:
    """Laboratory values inside the window, labelled and cleaned, in long form.

    Labs carry no stay id, so they are joined on (subject, admission) and
    assigned to stays by time alone; a lab inside two overlapping stay windows
    appears under both stays.  See
    :func:`clinframe.functions.rules.capped_rules` for the two options."""
    by_label: dict[str, list[int]] = {}
    for item, label in labels.items():
        by_label.setdefault(label, []).append(item)
    return stage_events(stays, labevents, join_keys=("subject_id", "hadm_id"), start=start, end=end, labels=by_label,
                        items=items, rules=R.capped_rules(items, caps, fio2_range, keep_negative_base_excess),
                        text="value" if text else None, band=band)


def lab_pivot(stays: DataFrame, labevents: DataFrame, *, outputs: Sequence[str], text_outputs: Sequence[str] = (),
              keep_empty: bool = True, **staging) -> DataFrame:
    """Laboratory values per (stay, time): :func:`stage_labs`, pivoted."""
    staged = stage_labs(stays, labevents, text=bool(text_outputs), **staging)
    return window_pivot(stays, staged, outputs=outputs, text_outputs=text_outputs, keep_empty=keep_empty)


def stage_bloodgas(icustays: DataFrame, labevents: DataFrame, start="-6 hours", end="1 day", **options) -> DataFrame:
    """Blood-gas labs from intime - 6 h to intime + 1 day in long form, with their text."""
    return stage_labs(icustays, labevents, items=R.BLOODGAS_ITEMS, labels=R.BLOODGAS_LABELS, caps=R.BLOODGAS_CAPS,
                      start=("intime", start), end=("intime", end), text=True, **options)


def lab_first_day(icustays: DataFrame, labevents: DataFrame, start="-6 hours", end="1 day",
                  **options) -> DataFrame:
    """Blood-gas panel from intime - 6 h to intime + 1 day: text specimen and 27 values."""
    numeric = [n for n in R.BLOODGAS_LABELS.values() if n != "specimen"]
    return lab_pivot(icustays, labevents, items=R.BLOODGAS_ITEMS, labels=R.BLOODGAS_LABELS,
                     outputs=numeric, caps=R.BLOODGAS_CAPS, start=("intime", start),
                     end=("intime", end), text_outputs=["specimen"], **options)


def lab_seven_day(icustays: DataFrame, labevents: DataFrame, **options) -> DataFrame:
    """PaO2 / FiO2 labs from intime - 6 h to intime + 7 days.

    Fetches O2 flow (50815) but labels PEEP's item instead, as the study
    does, so ``o2flow`` is always NULL and O2-flow rows only add empty groups.
    """
    return lab_pivot(icustays, labevents, items=R.LAB_SEVEN_DAY_ITEMS, labels=R.LAB_PF_LABELS,
                     outputs=["o2flow", "fio2", "po2"], caps=R.LAB_PF_CAPS,
                     start=("intime", "-6 hours"), end=("intime", "7 days"), **options)


def lab_in_stay(stays: DataFrame, labevents: DataFrame, **options) -> DataFrame:
    """PEEP, FiO2 and PaO2 labs between intime and outtime."""
    return lab_pivot(stays, labevents, items=R.LAB_IN_STAY_ITEMS, labels=R.LAB_PF_LABELS,
                     outputs=["peep", "fio2", "po2"], caps=R.LAB_PF_CAPS, **options)


def gcs_first_day(icustays: DataFrame, chartevents: DataFrame) -> DataFrame:
    """Glasgow coma scale components per (stay, time) in the first day.

    Intubated-verbal text is scored 0 using the original item id, before the
    two charting systems are fused; ``endotrachflag`` is 1 when the verbal
    maximum is 0; ``rn`` numbers the rows of a stay by time.
    """
    item = F.col("itemid")
    fused = F.coalesce(*[F.when(item.isin([k for k, v in R.GCS_FUSION.items() if v == target]), F.lit(target))
                         for target in sorted(set(R.GCS_FUSION.values()))], item)
    intubated = None
    for original, text in R.GCS_INTUBATED_TEXT.items():
        cond = (item == original) & (F.col("value") == text)
        intubated = cond if intubated is None else intubated | cond
    scored = chartevents.filter(is_distinct_from("error", 1) & item.isin(list(R.GCS_FUSION))).select(
        "icustay_id", "charttime", fused.alias("itemid"), F.when(intubated, F.lit(0.0)).otherwise(F.col("valuenum")).alias("valuenum"))
    staged = stage_events(icustays, scored, join_keys=("icustay_id",), start=("intime", None), end=("intime", "1 day"),
                          labels={name: [i] for name, i in R.GCS_COMPONENTS.items()},
                          rules=[(tuple(R.GCS_COMPONENTS.values()), [R.Range()])], stay_cols=("icustay_id",))
    rows = window_pivot(icustays, staged, outputs=list(R.GCS_COMPONENTS), keep_empty=False, stay_cols=("icustay_id",))
    out = rows.withColumn("endotrachflag", F.when(F.col("gcsverbal") == 0, F.lit(1)).otherwise(F.lit(0)))
    return bucketed_rank(store(out, "gcs"), ["icustay_id"], "charttime", name="rn", method="row_number", bucket="1 hour")
