"""Two-source merge of charted and laboratory rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHART_ONLY = ("spo2", "hr", "temp", "nbps", "nbpd", "nbpm", "abps", "abpd", "abpm",
              "rr", "tv", "pip", "plap", "mv", "map")
# (merged name, chart column, lab column); the lab value wins when present.
SHARED = (("pao2", "pao2", "po2"), ("fio2", "fio2", "fio2"), ("peep", "peep", "peep"))


ORDER = ["spo2", "pao2", "pao2_c", "pao2_l", "fio2", "fio2_c", "fio2_l", "hr", "temp", "nbps", "nbpd",
         "nbpm", "abps", "abpd", "abpm", "rr", "tv", "pip", "plap", "mv", "map", "peep", "peep_c", "peep_l"]


def merge_sources(chart: DataFrame, lab: DataFrame, keys: Sequence[str] = ("icustay_id", "charttime"),
                  ids: Sequence[str] = ("subject_id", "hadm_id", "icustay_id", "charttime"),
                  prefer: str = "lab") -> DataFrame:
    """FULL JOIN on ``keys`` with plain equality (NULL times never match, so
    rows of event-less stays survive from both sides).  Ids are coalesced
    chart-first; shared signals take the ``prefer`` side and keep both
    originals as ``<name>_c`` / ``<name>_l``.

    The join shuffles both sides on (stay, time); the time in the key spreads
    a long stay over many partitions.
    """
    c = chart.select(*[F.col(k).alias(f"_c_{k}") for k in ids],
                     *[F.col(n).alias(n) for n in CHART_ONLY if n in chart.columns],
                     *[F.col(src).alias(f"{name}_c") for name, src, _ in SHARED])
    lab_ids = [k for k in ids if k in lab.columns]
    lb = lab.select(*[F.col(k).alias(f"_l_{k}") for k in lab_ids],
                    *[F.col(src).alias(f"{name}_l") for name, _, src in SHARED])
    cond = [c[f"_c_{k}"] == lb[f"_l_{k}"] for k in keys]
    j = c.join(lb, cond, "full")
    first, second = ("_l", "_c") if prefer == "lab" else ("_c", "_l")
    out = [F.coalesce(F.col(f"_c_{k}"), F.col(f"_l_{k}")).alias(k) if k in lab_ids else F.col(f"_c_{k}").alias(k)
           for k in ids]
    cols = {}
    for n in CHART_ONLY:
        if n in chart.columns:
            cols[n] = F.col(n)
    for name, _, _ in SHARED:
        cols[name] = F.coalesce(F.col(f"{name}{first}"), F.col(f"{name}{second}"))
        cols[f"{name}_c"] = F.col(f"{name}_c")
        cols[f"{name}_l"] = F.col(f"{name}_l")
    return j.select(*out, *[cols[n].alias(n) for n in ORDER if n in cols])
