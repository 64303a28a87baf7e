"""Item vocabularies and value-cleaning rules.

A rule set is an ordered list of ``(item_ids, [Range, ...])``.  A measurement's
cleaned value is the transform of the *first* range that accepts it, among the
ranges listed for its item; no accepting range gives NULL.  Ranges of one
item are tried in list order, which is how shadowing rules (version ``v1.1``)
are expressed as data instead of code.
"""

from __future__ import annotations

from dataclasses import dataclass

# Transforms applied to an accepted value.
KEEP = "keep"        # v
PERCENT = "percent"  # v * 100              (fraction -> percent)
F_TO_C = "f_to_c"    # (v - 32) * 5 / 9     (evaluated in this order)


@dataclass(frozen=True)
class Range:
    """Accepts ``lo <(=) v <(=) hi``; a ``None`` bound is open."""

    lo: float | None = None
    lo_incl: bool = False
    hi: float | None = None
    hi_incl: bool = False
    transform: str = KEEP


def gt(lo, transform=KEEP):
    return Range(lo=lo, transform=transform)


def between_open(lo, hi, transform=KEEP):
    return Range(lo=lo, hi=hi, transform=transform)


# --------------------------------------------------------------------------
# FIXED VALUES: item ids, labels and bounds that must equal the reference
# study's definitions for results to match.  Stated plainly, in natural order.
# --------------------------------------------------------------------------

# Charted vital-sign vocabulary (label -> item ids), output order of the pivot.
CHART_LABELS: dict[str, tuple[int, ...]] = {
    "spo2": (220277, 646),
    "pao2": (220224, 779),
    "fio2": (190, 3420, 223835, 3422),
    "hr": (211, 220045),
    "temp": (223762, 676, 677, 223761, 678, 679),
    "nbps": (442, 455, 220179),
    "nbpd": (8440, 8441, 220180),
    "nbpm": (456, 443, 220181),
    "abps": (51, 6701, 220050),
    "abpd": (8368, 8555, 220051),
    "abpm": (52, 220052, 6702, 225312),
    "rr": (615, 618, 220210, 224690),
    "tv": (681, 682, 2400, 2408, 2534, 2420, 224685),
    "pip": (507, 535, 224695),
    "plap": (543, 224696),
    "mv": (445, 448, 450, 224687),
    "map": (444, 3502, 3503, 224697),
    "peep": (506, 220339),
}
# The base chart version has no arterial blood-pressure signals.
BASE_CHART_LABELS = {k: v for k, v in CHART_LABELS.items() if k not in ("abps", "abpd", "abpm")}

CELSIUS_ITEMS = (223762, 676, 677)
FAHRENHEIT_ITEMS = (223761, 678, 679)
FIO2_FRACTION_OR_PERCENT = 223835    # mixes fractions and percents
FIO2_SET_FRACTION = 190              # fraction
FIO2_PERCENT_ITEMS = (3420, 3422)    # percent
BPS_ITEMS = (51, 442, 455, 6701, 220179, 220050)
BPD_ITEMS = (8368, 8440, 8441, 8555, 220180, 220051)
BPM_ITEMS = (456, 52, 6702, 443, 220052, 220181, 225312)

# 223835: fraction (0, 1] becomes percent; [21, 100] is kept; the rest is NULL.
_FIO2_MIXED = [Range(0, False, 1, True, PERCENT), Range(21, True, 100, True)]

# Chart cleaning, version v1.2 (strict bounds).
CHART_RULES_V12 = [
    (CHART_LABELS["spo2"], [between_open(0, 100)]),
    (CHART_LABELS["pao2"], [between_open(0, 800)]),
    (CHART_LABELS["hr"], [between_open(0, 300)]),
    ((FIO2_FRACTION_OR_PERCENT,), _FIO2_MIXED),
    (FIO2_PERCENT_ITEMS, [between_open(0, 100)]),
    ((FIO2_SET_FRACTION,), [Range(0.2, False, 1, True, PERCENT)]),
    (CELSIUS_ITEMS, [between_open(10, 50)]),
    (FAHRENHEIT_ITEMS, [between_open(70, 120, F_TO_C)]),
    (BPS_ITEMS, [between_open(0, 400)]),
    (BPD_ITEMS, [between_open(0, 300)]),
    (BPM_ITEMS, [between_open(0, 300)]),
    (CHART_LABELS["rr"], [Range(0, True, 70, False)]),
    (CHART_LABELS["tv"], [gt(100)]),
    (CHART_LABELS["pip"], [between_open(0, 100)]),
    (CHART_LABELS["plap"], [between_open(0, 100)]),
    (CHART_LABELS["mv"], [gt(0)]),
    (CHART_LABELS["map"], [between_open(0, 100)]),
    (CHART_LABELS["peep"], [between_open(0, 40)]),
]

# Chart cleaning, base version: non-positive is NULL; SpO2 <= 100 and
# PaO2 <= 800 are inclusive caps; item 190 outside (0.2, 1] keeps its raw value.
CHART_RULES_BASE = [
    (CHART_LABELS["spo2"], [Range(0, False, 100, True)]),
    (CHART_LABELS["pao2"], [Range(0, False, 800, True)]),
    ((FIO2_FRACTION_OR_PERCENT,), _FIO2_MIXED),
    ((FIO2_SET_FRACTION,), [Range(0.2, False, 1, True, PERCENT), gt(0)]),
    (FAHRENHEIT_ITEMS, [gt(0, F_TO_C)]),
    (tuple(i for label, items in BASE_CHART_LABELS.items() for i in items
           if i not in CHART_LABELS["spo2"] + CHART_LABELS["pao2"] + FAHRENHEIT_ITEMS
           + (FIO2_FRACTION_OR_PERCENT, FIO2_SET_FRACTION)), [gt(0)]),
]

# Chart cleaning, version v1.1: a leading "v > 0 keeps v" rule shadows every
# later bound; non-positive values survive only for the items whose second
# rule has no lower bound.
_V11_UPPER = {
    CHART_LABELS["spo2"]: 100, CHART_LABELS["pao2"]: 800, CHART_LABELS["hr"]: 300,
    FIO2_PERCENT_ITEMS: 100, BPS_ITEMS: 400, BPD_ITEMS: 300, BPM_ITEMS: 300,
    CHART_LABELS["rr"]: 70,
}
_V11_ITEMS_WITH_UPPER = {i for items in _V11_UPPER for i in items}
CHART_RULES_V11 = (
    [(items, [gt(0), Range(hi=hi)]) for items, hi in _V11_UPPER.items()]
    + [(tuple(i for items in CHART_LABELS.values() for i in items if i not in _V11_ITEMS_WITH_UPPER),
        [gt(0)])]
)

CHART_VERSIONS = {
    "base": (BASE_CHART_LABELS, CHART_RULES_BASE),
    "v1.1": (CHART_LABELS, CHART_RULES_V11),
    "v1.2": (CHART_LABELS, CHART_RULES_V12),
}

# Charted FiO2 for the P/F ratio and specimen score (percent scale):
# 223835 as above; 3420/3422 taken as charted, unchecked; 190 in (0.2, 1) x 100.
FIO2_ITEMS = (3420, 190, 223835, 3422)
FIO2_RULES = [
    ((FIO2_FRACTION_OR_PERCENT,), _FIO2_MIXED),
    (FIO2_PERCENT_ITEMS, [Range()]),
    ((FIO2_SET_FRACTION,), [between_open(0.2, 1, PERCENT)]),
]

# SpO2 staging: keep 0 < v <= 100.
SPO2_ITEMS = (646, 220277)
SPO2_RULES = [(SPO2_ITEMS, [Range(0, False, 100, True)])]

# Blood-gas laboratory vocabulary (item -> label).  50807 and 51545 are
# fetched but carry no label.
BLOODGAS_LABELS: dict[int, str] = {
    50800: "specimen",
    50801: "aado2",
    50802: "baseexcess",
    50803: "bicarbonate",
    50804: "totalco2",
    50805: "carboxyhemoglobin",
    50806: "chloride",
    50808: "calcium",
    50809: "glucose",
    50810: "hematocrit",
    50811: "hemoglobin",
    50812: "intubated",
    50813: "lactate",
    50814: "methemoglobin",
    50815: "o2flow",
    50816: "fio2",
    50817: "so2",
    50818: "pco2",
    50819: "peep",
    50820: "ph",
    50821: "po2",
    50822: "potassium",
    50823: "requiredo2",
    50824: "sodium",
    50825: "temperature",
    50826: "tidalvolume",
    50827: "ventilationrate",
    50828: "ventilator",
}
BLOODGAS_ITEMS = tuple(range(50800, 50829)) + (51545,)
# Blood-gas caps: non-positive is NULL everywhere; these items also have an
# inclusive upper cap.
BLOODGAS_CAPS = {50810: 100, 50816: 100, 50817: 100, 50815: 70, 50821: 800}

# Seven-day P/F labs and in-stay labs: labels, fetched items and caps.
LAB_PF_LABELS = {50819: "peep", 50816: "fio2", 50821: "po2"}
LAB_SEVEN_DAY_ITEMS = (50815, 50816, 50821)
LAB_IN_STAY_ITEMS = (50819, 50816, 50821)
LAB_PF_CAPS = {50821: 800}
LAB_FIO2_ITEM = 50816
BASE_EXCESS_ITEM = 50802

# Glasgow coma scale: two charting systems fused onto one id per component.
GCS_FUSION = {723: 723, 223900: 723, 454: 454, 223901: 454, 184: 184, 220739: 184}
GCS_COMPONENTS = {"gcsmotor": 454, "gcsverbal": 723, "gcseyes": 184}
# Text values that mean "intubated, verbal not assessable" -> scored 0.
GCS_INTUBATED_TEXT = {723: "1.0 ET/Trach", 223900: "No Response-ETT"}

# Surgical services: a service ending in SURG, or orthopaedics.
SURGICAL_SUFFIX = "SURG"
SURGICAL_EXTRA = ("ORTHO",)

# Arterial-specimen logistic model: intercept, the mandatory PaO2 term, then
# (feature, coefficient, mean, missing-offset) for the imputed terms.
SPECIMEN_INTERCEPT = -0.02544
SPECIMEN_PO2_COEF = 0.04598
SPECIMEN_TERMS = [
    ("spo2", -0.15356, 97.49420, 0.13429),
    ("fio2_chartevents", 0.00621, 51.49550, -0.24958),
    ("hemoglobin", 0.10559, 10.32307, 0.05954),
    ("so2", 0.13251, 93.66539, -0.23172),
    ("pco2", -0.01511, 42.08866, -0.01630),
    ("fio2", 0.01480, 63.97836, -0.31142),
    ("aado2", -0.00200, 442.21186, -0.01328),
    ("bicarbonate", -0.03220, 22.96894, -0.06535),
    ("totalco2", 0.05384, 24.72632, -0.01405),
    ("lactate", 0.08202, 3.06436, 0.06038),
    ("ph", 0.10956, 7.36233, -0.00617),
    ("o2flow", 0.00848, 7.59362, -0.35803),
]

# Feature lookbacks of the PaO2 match table (hours).
MATCH_FEATURES: dict[str, int] = {
    "spo2": 2, "fio2": 4, "hr": 4, "temp": 4, "nbps": 4, "nbpd": 4, "nbpm": 4,
    "abps": 4, "abpd": 4, "abpm": 4, "rr": 4, "tv": 4, "pip": 4, "plap": 4,
    "mv": 4, "map": 4, "peep": 4,
}
# --------------------------------------------------------------------------


def capped_rules(items, caps: dict[int, float], fio2_range: tuple[float, float] | None = None,
                 keep_negative_base_excess: bool = False):
    """Lab rule set: ``v > 0`` for every item, plus an inclusive cap per item.

    Options for two study behaviours that look unintended (off by default):
    ``fio2_range=(lo, hi)`` keeps lab FiO2 only inside ``[lo, hi]`` (the study's
    check can never be true, so FiO2 is only tested for ``> 0``), and
    ``keep_negative_base_excess`` keeps base excess of any sign (the study's
    ``<= 0 -> NULL`` also drops legitimate negative values).
    """
    special = {}
    for item in items:
        if item in caps:
            special[item] = [Range(0, False, caps[item], True)]
    if fio2_range is not None and LAB_FIO2_ITEM in items:
        special[LAB_FIO2_ITEM] = [Range(fio2_range[0], True, fio2_range[1], True)]
    if keep_negative_base_excess and BASE_EXCESS_ITEM in items:
        special[BASE_EXCESS_ITEM] = [Range()]
    rules = [((item,), ranges) for item, ranges in special.items()]
    rest = tuple(i for i in items if i not in special)
    return rules + ([(rest, [gt(0)])] if rest else [])


def chart_items(version: str) -> tuple[int, ...]:
    labels, _ = CHART_VERSIONS[version]
    return tuple(i for items in labels.values() for i in items)


def _number(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"{float(x)!r}D"


def item_rules(spark, items, labels, rules):
    """One row per fetched item: itemid, label, and its first and second range
    (``lo0, lo0_incl, hi0, hi0_incl, t0, lo1, ...``; ``t`` NULL where there is none).

    A literal table, so its size is known to the optimizer.  The ranges are
    listed in ``rules`` order; no item has more than two.
    """
    label_of = {i: name for name, ids in labels.items() for i in ids}
    ranges = {i: [r for ids, listed in rules if i in ids for r in listed] for i in items}
    assert all(len(r) <= 2 for r in ranges.values()), "an item has more than two ranges"
    rows = []
    for i in dict.fromkeys(items):
        cells = [str(int(i)), f"'{label_of[i]}'" if i in label_of else "CAST(NULL AS STRING)"]
        for r in (ranges[i] + [None, None])[:2]:
            cells += ([_number(r.lo), str(r.lo_incl).lower(), _number(r.hi), str(r.hi_incl).lower(), f"'{r.transform}'"] if r else
                      [_number(None), "false", _number(None), "false", "CAST(NULL AS STRING)"])
        rows.append("(" + ", ".join(cells) + ")")
    names = ["itemid", "label"] + [f"{c}{n}{x}" for n in (0, 1) for c, x in (("lo", ""), ("lo", "_incl"), ("hi", ""), ("hi", "_incl"), ("t", ""))]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS rules({', '.join(names)})")


def ruled_value(value: str):
    """Cleaned ``value`` of a row joined with :func:`item_rules`: the transform of the first range that accepts it."""
    from pyspark.sql import functions as F
    v, out = F.col(value), F.lit(None).cast("double")
    for n in (1, 0):
        low = F.col(f"lo{n}").isNull() | (v > F.col(f"lo{n}")) | (F.col(f"lo{n}_incl") & (v == F.col(f"lo{n}")))
        high = F.col(f"hi{n}").isNull() | (v < F.col(f"hi{n}")) | (F.col(f"hi{n}_incl") & (v == F.col(f"hi{n}")))
        done = F.when(F.col(f"t{n}") == PERCENT, v * 100.0).when(F.col(f"t{n}") == F_TO_C, (v - 32.0) * 5.0 / 9.0).otherwise(v)
        out = F.when(F.col(f"t{n}").isNotNull() & low & high, done).otherwise(out)
    return out


RULE_SETS = {
    "chart_base": (BASE_CHART_LABELS, CHART_RULES_BASE),
    "chart_v1.1": (CHART_LABELS, CHART_RULES_V11),
    "chart_v1.2": (CHART_LABELS, CHART_RULES_V12),
    "fio2_charted": ({"fio2": FIO2_ITEMS}, FIO2_RULES),
    "spo2_stage": ({"spo2": SPO2_ITEMS}, SPO2_RULES),
    "bloodgas": ({v: (k,) for k, v in BLOODGAS_LABELS.items()}, capped_rules(BLOODGAS_ITEMS, BLOODGAS_CAPS)),
    "lab_pf": ({v: (k,) for k, v in LAB_PF_LABELS.items()}, capped_rules(LAB_IN_STAY_ITEMS, LAB_PF_CAPS)),
}


def rules_table(spark, name: str | None = None):
    """The versioned rule sets as a DataFrame, one row per (rule set, item,
    position): ``label, lo, lo_incl, hi, hi_incl, transform``.  For review
    and audit; the pivots join the same rules (:func:`item_rules`)."""
    rows = []
    for set_name, (labels, rules) in RULE_SETS.items():
        if name and set_name != name:
            continue
        label_of = {i: lab for lab, items in labels.items() for i in items}
        for items, ranges in rules:
            for item in items:
                for pos, r in enumerate(ranges):
                    rows.append((set_name, item, label_of.get(item), pos, None if r.lo is None else float(r.lo),
                                 r.lo_incl, None if r.hi is None else float(r.hi), r.hi_incl, r.transform))
    return spark.createDataFrame(rows, "rule_set string, itemid int, label string, position int, lo double, "
                                       "lo_incl boolean, hi double, hi_incl boolean, transform string")
