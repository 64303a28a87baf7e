"""Queries for the relational primitives of SURVEY §2.2 (one per listed key).

Each runs one primitive over whole clinical tables derived from the driver's
data; the composite operators use the same primitives internally.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clinframe.operators.cohort import left_theta
from clinframe import operators as op
from clinframe.functions import rules as R
from clinframe.functions.expr import days_between, is_distinct_from, seconds_between, shift


def is_distinct_from_q(t):
    """``error IS DISTINCT FROM 1`` keeps NULL and 0 flags."""
    return (t["chartevents"].filter(is_distinct_from("error", 1))
            .groupBy("itemid").agg(F.count(F.lit(1)).alias("n")))


def _labs_in_span(t, strict):
    """Labs between the first and the last lab of their admission, so that rows lie on both bounds."""
    lab = t["labevents"].filter(F.col("hadm_id").isNotNull()).select("hadm_id", "charttime")
    span = lab.groupBy("hadm_id").agg(F.min("charttime").alias("lo"), F.max("charttime").alias("hi"))
    inside = ((F.col("charttime") > F.col("lo")) & (F.col("charttime") < F.col("hi")) if strict
              else F.col("charttime").between(F.col("lo"), F.col("hi")))
    return lab.join(span, "hadm_id").filter(inside).groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n"))


def between_closed_q(t):
    """Closed ``BETWEEN`` on timestamps (labs per admission)."""
    return _labs_in_span(t, strict=False)


def range_open_q(t):
    """P5: strict open range (labs per admission)."""
    return _labs_in_span(t, strict=True)


def like_contains_q(t):
    """``LIKE '%...%'``."""
    return (t["noteevents"].filter(F.col("description").like("%6%"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("n")))


def like_suffix_q(t):
    """``LIKE '%SURG'``."""
    return (t["services"].filter(F.col("curr_service").like("%SURG"))
            .groupBy("curr_service").agg(F.count(F.lit(1)).alias("n")))


def in_list_q(t):
    """``IN (...)`` list."""
    items = list(R.CHART_LABELS["spo2"] + R.CHART_LABELS["pao2"])
    return (t["chartevents"].filter(F.col("itemid").isin(items))
            .groupBy("itemid").agg(F.count(F.lit(1)).alias("n")))


def nested_case_q(t):
    """Nested searched CASE (FiO2 item 223835)."""
    v = F.col("valuenum")
    inner = (F.when((v > 0) & (v <= 1), v * F.lit(100.0)).when((v > 1) & (v < 21), F.lit(None))
             .when((v >= 21) & (v <= 100), v).otherwise(F.lit(None)))
    return t["chartevents"].filter(F.col("itemid") == R.FIO2_FRACTION_OR_PERCENT).select(
        "icustay_id", "charttime", "valuenum",
        F.when(F.col("itemid") == R.FIO2_FRACTION_OR_PERCENT, inner).otherwise(F.lit(None)).cast("double")
        .alias("fio2"))


def full_join_q(t):
    """FULL JOIN on (stay, time), keys coalesced."""
    s = op.stage_spo2(t["chartevents"]).select("icustay_id", "charttime", "spo2")
    f = op.normalize_fio2(t["chartevents"]).select(F.col("icustay_id").alias("_f_stay"),
                                                   F.col("charttime").alias("_f_time"), "fio2_chartevents")
    j = s.join(f, (s.icustay_id == f._f_stay) & (s.charttime == f._f_time), "full")
    return j.select(F.coalesce("icustay_id", "_f_stay").alias("icustay_id"),
                    F.coalesce("charttime", "_f_time").alias("charttime"), "spo2", "fio2_chartevents")


def theta_left_join_q(t):
    """LEFT JOIN with one equi key and a one-sided interval bound."""
    icu, sv = t["icustays"], t["services"].select(F.col("hadm_id").alias("_h"), "transfertime", "curr_service")
    icu = icu.select("hadm_id", "icustay_id", "intime")
    j = left_theta(icu, sv, (icu.hadm_id == sv._h) & (sv.transfertime < shift("intime", "12 hours")))
    return j.select("icustay_id", "transfertime", "curr_service")


def inner_range_join_q(t):
    """Inner join, point in [intime, intime + 1 day]."""
    icu = t["icustays"].select(F.col("icustay_id").alias("_stay"), "intime")
    ce = t["chartevents"].select("icustay_id", "charttime")
    j = ce.join(icu, (ce.icustay_id == icu._stay) & (ce.charttime >= icu.intime)
                & (ce.charttime <= shift("intime", "1 day")), "inner")
    return j.groupBy("icustay_id").agg(F.count(F.lit(1)).alias("n"))


def rank_ties_q(t):
    """``rank()`` per subject by intime (ties share a rank)."""
    return op.bucketed_rank(t["icustays"].select("subject_id", "icustay_id", "intime"),
                            ["subject_id"], "intime", name="rk")


def window_after_agg_q(t):
    """``row_number()`` over already aggregated groups."""
    g = t["chartevents"].filter(F.col("icustay_id").isNotNull()).groupBy("icustay_id", "charttime") \
        .agg(F.count(F.lit(1)).alias("n"))
    return op.bucketed_rank(g, ["icustay_id"], "charttime", name="rn", method="row_number")


def interval_diff_q(t):
    """timestamp - timestamp as a day-time interval, read back as seconds."""
    i = t["icustays"].select("icustay_id", (F.col("outtime") - F.col("intime")).alias("los"))
    secs = F.expr("extract(DAY FROM los) * 86400 + extract(HOUR FROM los) * 3600 "
                  "+ extract(MINUTE FROM los) * 60 + extract(SECOND FROM los)")
    return i.select("icustay_id", secs.cast("double").alias("los_seconds"))


def epoch_days_q(t):
    """epoch seconds -> days (and the raw seconds)."""
    return t["icustays"].select("icustay_id", seconds_between("intime", "outtime").alias("los_seconds"),
                                days_between("intime", "outtime").alias("los_days"))


def coalesce_precedence_q(t):
    """first non-NULL of lab FiO2 and charted FiO2."""
    st = op.pf_ratio(op.lab_seven_day(t["icustays"], t["labevents"]), op.normalize_fio2(t["chartevents"]))
    return st.select("icustay_id", "charttime", F.coalesce("fio2", "fio2_chartevents").alias("fio2_used"))


def max_text_q(t):
    """A3: ``max`` over text (binary order)."""
    return (t["labevents"].filter(F.col("itemid") == 50800).groupBy("subject_id", "hadm_id")
            .agg(F.max("value").alias("specimen")))


def order_by_keys_q(t):
    """O1: final ORDER BY the four keys (compared order-insensitively)."""
    return op.lab_in_stay(t["icustays"], t["labevents"]).orderBy(
        *[F.col(c).asc_nulls_last() for c in ("subject_id", "hadm_id", "icustay_id", "charttime")])


PRIMITIVES = {
    "is_distinct_from": is_distinct_from_q,
    "between_closed": between_closed_q,
    "range_open": range_open_q,
    "like_contains": like_contains_q,
    "like_suffix": like_suffix_q,
    "in_list": in_list_q,
    "nested_case": nested_case_q,
    "full_join": full_join_q,
    "theta_left_join": theta_left_join_q,
    "inner_range_join": inner_range_join_q,
    "rank_ties": rank_ties_q,
    "window_after_agg": window_after_agg_q,
    "interval_diff": interval_diff_q,
    "epoch_days": epoch_days_q,
    "coalesce_precedence": coalesce_precedence_q,
    "max_text": max_text_q,
    "order_by_keys": order_by_keys_q,
}
