"""Event-log cleaning: item fusion, unit normalisation and range checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.functions.expr import is_distinct_from, rule_value

STAY_KEYS = ("subject_id", "hadm_id", "icustay_id")


def stage_signal(events: DataFrame, items, value_rules, name: str, drop_errors: bool = False,
                 keys=STAY_KEYS, time: str = "charttime") -> DataFrame:
    """One cleaned signal per (stay, time): ``max`` of rule-checked values.

    ``drop_errors`` removes rows whose ``error`` flag IS DISTINCT FROM 1 is
    false (NULL flags are kept).  Groups whose values all fail their rules
    stay, with a NULL value.
    """
    rows = events.filter(F.col("itemid").isin(list(items)))
    if drop_errors:
        rows = rows.filter(is_distinct_from("error", 1))
    return (rows.groupBy(*keys, time)
            .agg(F.max(rule_value("itemid", "valuenum", value_rules)).alias(name)))


def normalize_fio2(chartevents: DataFrame) -> DataFrame:
    """Charted FiO2 in percent per (stay, time), error rows removed."""
    return stage_signal(chartevents, R.FIO2_ITEMS, R.FIO2_RULES, "fio2_chartevents", drop_errors=True)


def stage_spo2(chartevents: DataFrame) -> DataFrame:
    """Charted SpO2 per (stay, time); values outside (0, 100] become NULL."""
    return stage_signal(chartevents, R.SPO2_ITEMS, R.SPO2_RULES, "spo2")
