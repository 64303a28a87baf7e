"""Several laboratory windows from one scan of the log.

The study reads the laboratory log three times: the blood-gas panel of the first
day, PaO2 / FiO2 of seven days, and PEEP / FiO2 / PaO2 of the whole stay.  Here
one band join pairs each event with each stay whose windows, taken together,
hold it; flags say which windows do, and one aggregation over (panel, stay,
time) forms all pivots.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.functions.expr import bucket_of, buckets_between, interval_micros
from clinframe.functions.rules import item_rules, ruled_value
from clinframe.operators.pivot import STAY_KEYS, _bound, window_pivot
from clinframe.session import store


@dataclass(frozen=True)
class LabPanel:
    """A window of the stay, ``(column, interval or None)`` at either end, and what is read in it."""

    items: tuple[int, ...]
    labels: Mapping[int, str]
    caps: Mapping[int, float]
    outputs: tuple[str, ...]
    text_outputs: tuple[str, ...] = ()
    start: tuple[str, str | None] = ("intime", None)
    end: tuple[str, str | None] = ("outtime", None)


PANELS = {
    "first_day": LabPanel(tuple(R.BLOODGAS_ITEMS), R.BLOODGAS_LABELS, R.BLOODGAS_CAPS,
                          tuple(n for n in R.BLOODGAS_LABELS.values() if n != "specimen"), ("specimen",),
                          ("intime", "-6 hours"), ("intime", "1 day")),
    "seven_day": LabPanel(tuple(R.LAB_SEVEN_DAY_ITEMS), R.LAB_PF_LABELS, R.LAB_PF_CAPS, ("o2flow", "fio2", "po2"),
                          start=("intime", "-6 hours"), end=("intime", "7 days")),
    "in_stay": LabPanel(tuple(R.LAB_IN_STAY_ITEMS), R.LAB_PF_LABELS, R.LAB_PF_CAPS, ("peep", "fio2", "po2")),
}


def panel_events(stays: DataFrame, labevents: DataFrame, panels: Mapping[str, LabPanel], *, time: str = "charttime",
                 band: str = "1 day", **options) -> DataFrame:
    """(panel, stay keys, time, label, value, text): each event once per panel and stay that fetch it.

    The pairs of events and stays are formed once, by (subject, admission, day)
    over the union of the stay's windows.  A window with a NULL bound holds nothing.
    """
    width = interval_micros(band)
    bounds = [c for i, p in enumerate(panels.values()) for c in (_bound(p.start).alias(f"_lo{i}"), _bound(p.end).alias(f"_hi{i}"))]
    ends = range(len(panels))
    first, last = (F.least(*[F.col(f"_lo{i}") for i in ends]), F.greatest(*[F.col(f"_hi{i}") for i in ends])) if len(panels) > 1 else \
        (F.col("_lo0"), F.col("_hi0"))
    s = (stays.select(*[F.col(c).alias(f"_s_{c}") for c in STAY_KEYS], *bounds).withColumn("_lo", first).withColumn("_hi", last)
         .withColumn("_s_b", F.explode(buckets_between("_lo", "_hi", width))))

    items = sorted({i for p in panels.values() for i in p.items})
    known = F.col("itemid").isin(items) & F.col(time).isNotNull() & F.col("subject_id").isNotNull() & F.col("hadm_id").isNotNull()
    e = labevents.filter(known).select("subject_id", "hadm_id", time, "itemid", "valuenum", F.col("value").cast("string").alias("_text"),
                                       bucket_of(time, width).alias("_e_b"))
    pairs = e.join(s, (e.subject_id == s._s_subject_id) & (e.hadm_id == s._s_hadm_id) & (e._e_b == s._s_b)
                   & (e[time] >= s._lo) & (e[time] <= s._hi), "inner")
    flags = [F.when((F.col(time) >= F.col(f"_lo{i}")) & (F.col(time) <= F.col(f"_hi{i}")) & F.col("itemid").isin(list(p.items)), F.lit(n))
             for i, (n, p) in enumerate(panels.items())]
    expanded = pairs.select(F.explode(F.array_compact(F.array(*flags))).alias("panel"), *[F.col(f"_s_{c}").alias(c) for c in STAY_KEYS],
                            time, "itemid", "valuenum", "_text")

    rules = None
    for n, p in panels.items():
        labels: dict[str, list[int]] = {}
        for item, label in p.labels.items():
            labels.setdefault(label, []).append(item)
        part = item_rules(stays.sparkSession, p.items, labels, R.capped_rules(p.items, p.caps, **options)).withColumn("panel", F.lit(n))
        rules = part if rules is None else rules.unionByName(part)
    return expanded.join(rules, ["panel", "itemid"], "inner").select(
        "panel", *STAY_KEYS, time, "itemid", "label", ruled_value("valuenum").alias("value"), F.col("_text").alias("text"))


def lab_panels(stays: DataFrame, labevents: DataFrame, panels: Mapping[str, LabPanel] | None = None, *, keep_empty: bool = True,
               time: str = "charttime", band: str = "1 day", **options) -> DataFrame:
    """All panels in one table: ``panel``, stay keys, time and the outputs of every panel (NULL where it isn't of the row's panel).

    Per panel the rows and values of :func:`clinframe.operators.pivot.lab_pivot`,
    with a NULL-time row for stays without events.
    """
    panels = dict(panels or PANELS)
    staged = panel_events(stays, labevents, panels, time=time, band=band, **options)
    listed = stays.select(F.explode(F.array(*[F.lit(n) for n in panels])).alias("panel"), *STAY_KEYS)
    return window_pivot(listed, staged, outputs=list(dict.fromkeys(o for p in panels.values() for o in p.outputs)),
                        text_outputs=list(dict.fromkeys(o for p in panels.values() for o in p.text_outputs)),
                        keep_empty=keep_empty, stay_cols=("panel", *STAY_KEYS), time=time)


def stored_panels(stays: DataFrame, labevents: DataFrame, panels: Mapping[str, LabPanel] | None = None, time: str = "charttime",
                  **options) -> dict[str, DataFrame]:
    """:func:`lab_panels` written once, a folder per panel, and read back as one frame per panel with its own columns."""
    panels = dict(panels or PANELS)
    table = store(lab_panels(stays, labevents, panels, time=time, **options), "lab-panels", partition_by="panel")
    return {n: table.filter(F.col("panel") == n).select(*STAY_KEYS, time, *p.text_outputs, *p.outputs) for n, p in panels.items()}


def of_stays(panel: DataFrame, stays: DataFrame) -> DataFrame:
    """The rows of a panel that belong to ``stays``, by all three stay keys."""
    wanted = stays.select(*[F.col(k).alias(f"_w_{k}") for k in STAY_KEYS]).distinct()
    return panel.join(wanted, [panel[k].eqNullSafe(wanted[f"_w_{k}"]) for k in STAY_KEYS], "left_semi")
