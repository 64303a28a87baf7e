"""Invariants of the view DAG on the smallest driver tables."""

import pytest
from pyspark.sql import functions as F

from clinframe.functions.rules import chart_items
from clinframe.plans import Study
from clinframe.sources import clinical_tables
from conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def study(spark):
    t = clinical_tables(spark, SMOKE_DIR)
    return Study(t, stays=t["icustays"])


def test_merge_rows_are_chart_plus_lab_minus_matches(study):
    chart, lab = study["patientschart"], study["patientslab"]
    matches = chart.alias("c").join(lab.alias("l"), (F.col("c.icustay_id") == F.col("l.icustay_id"))
                                    & (F.col("c.charttime") == F.col("l.charttime"))).count()
    assert study["patientsvalue"].count() == chart.count() + lab.count() - matches


def test_match_rows_are_the_non_null_anchors(study):
    pv = study["patientsvalue"]
    assert study["matchvalue"].count() == pv.filter(F.col("pao2").isNotNull()).count()
    assert study["matchvalue_lab"].count() == pv.filter(F.col("pao2_l").isNotNull()).count()


def test_pivot_keeps_every_stay_time_group(study):
    t = study.t
    items = list(chart_items("v1.2"))
    stays = t["icustays"].select("subject_id", "hadm_id", "icustay_id", "intime", "outtime")
    ev = t["chartevents"].filter(F.col("itemid").isin(items))
    inside = ev.join(stays, ["subject_id", "hadm_id", "icustay_id"]).filter(
        (F.col("charttime") >= F.col("intime")) & (F.col("charttime") <= F.col("outtime")))
    groups = inside.select("icustay_id", "charttime").distinct().count()
    with_events = inside.select("icustay_id").distinct().count()
    pivot = study["patientschart"]
    assert pivot.filter(F.col("charttime").isNotNull()).count() == groups
    assert pivot.filter(F.col("charttime").isNull()).count() == stays.count() - with_events
