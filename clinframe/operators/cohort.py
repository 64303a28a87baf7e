"""Cohort building: one row per ICU stay with 0/1 exclusion flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.functions.expr import bucket_of, buckets_between, days_between, interval_micros, shift, years_between
from clinframe.operators.rank import bucketed_rank
from clinframe.session import store

STAY_KEYS = ("subject_id", "hadm_id", "icustay_id")
FLAGS = ("exclusion_age", "exclusion_chest", "exclusion_first_stay", "exclusion_los", "exclusion_vent")


def _flag(cond) -> F.Column:
    """1 when ``cond`` is true; 0 when false *or NULL* (SQL CASE semantics)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def cohort_base(icustays: DataFrame, patients: DataFrame, vent: DataFrame | None = None,
                rank_bucket: str = "30 days") -> DataFrame:
    """Per stay: LOS (days), age (years), order of the stay within the subject
    (``rank``: tied intimes share rank 1) and the ventilation marker.

    The rank is computed per (subject, ``rank_bucket`` of intime) plus the
    count of the subject's earlier stays (:func:`bucketed_rank`)."""
    s = icustays.join(patients.select("subject_id", "dob"), "subject_id", "inner")
    if vent is not None:
        s = s.join(vent.select("icustay_id", "vent"), "icustay_id", "left")
    else:
        s = s.withColumn("vent", F.lit(None).cast("int"))
    s = s.select(
        *STAY_KEYS, "intime", "outtime", "vent",
        days_between("intime", "outtime").alias("icu_length_of_stay"),
        years_between("dob", "intime").alias("age"),
    )
    return bucketed_rank(store(s, "stays"), ["subject_id"], "intime", name="icustay_id_order", bucket=rank_bucket)


def count_events_in_stay(icustays: DataFrame, notes: DataFrame, category: str = "Radiology",
                         pattern: str = "%CHEST%", name: str = "chest_num", band: str = "1 day") -> DataFrame:
    """Notes of the admission strictly inside (intime, outtime) with the given
    category and a description LIKE ``pattern``; stays without any are absent."""
    width = interval_micros(band)
    n = notes.filter((F.col("category") == category) & F.col("description").like(pattern)
                     & F.col("hadm_id").isNotNull() & F.col("charttime").isNotNull()) \
             .select(F.col("hadm_id").alias("_n_hadm"), F.col("charttime").alias("_n_time"),
                     bucket_of("charttime", width).alias("_n_b"))
    # Band join on (admission, day bucket): a note is only compared with the
    # stays of its admission whose window reaches its day.
    s = icustays.select(*STAY_KEYS, "intime", "outtime") \
        .withColumn("_s_b", F.explode(buckets_between("intime", "outtime", width)))
    j = s.join(n, (s.hadm_id == n._n_hadm) & (s._s_b == n._n_b) & (n._n_time > s.intime)
               & (n._n_time < s.outtime), "inner")
    return j.groupBy(*STAY_KEYS).agg(F.count(F.lit(1)).alias(name))


def select_patients(base: DataFrame, chest: DataFrame, heightweight: DataFrame, detail: DataFrame,
                    min_los: float = 1.0, min_age: float = 16.0, treat_missing_as_zero: bool = False) -> DataFrame:
    """The cohort table: base ⟕ chest count ⟕ height/weight ⟕ detail, five flags.

    ``exclusion_chest`` compares the count with 1; a stay without qualifying
    notes has a NULL count, so it is *not* flagged (the study's behaviour)
    unless ``treat_missing_as_zero``.
    """
    j = (base.join(chest.select("icustay_id", "chest_num"), "icustay_id", "left")
         .join(heightweight.select("icustay_id", "height_first", "weight_first"), "icustay_id", "left")
         .join(detail.select("icustay_id", "gender", "ethnicity"), "icustay_id", "left"))
    chest_num = F.coalesce(F.col("chest_num"), F.lit(0)) if treat_missing_as_zero else F.col("chest_num")
    return j.select(
        *STAY_KEYS, "age", "gender", "height_first", "weight_first", "ethnicity", "intime", "outtime",
        "icu_length_of_stay",
        _flag(F.col("icu_length_of_stay") < F.lit(float(min_los))).alias("exclusion_los"),
        _flag(F.col("age") < F.lit(float(min_age))).alias("exclusion_age"),
        _flag(F.col("icustay_id_order") != 1).alias("exclusion_first_stay"),
        _flag(F.col("vent") == 0).alias("exclusion_vent"),
        _flag(chest_num < 1).alias("exclusion_chest"),
    )


def surgical_flag(service) -> F.Column:
    s = F.col(service)
    cond = s.like(f"%{R.SURGICAL_SUFFIX}")
    for extra in R.SURGICAL_EXTRA:
        cond = cond | (s == extra)
    return _flag(cond)


def left_theta(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """LEFT JOIN on an equality and a range, as an inner join (either side of a hot
    key may be split) and, by an anti join of the same inputs, the left rows
    without a partner, with NULLs.  Both joins read the same exchanges."""
    alone = left.join(right, on, "left_anti").select(*left.columns, *[F.lit(None).cast(t).alias(c) for c, t in right.dtypes])
    return left.join(right, on, "inner").unionByName(alone)


def service_at_entry(icustays: DataFrame, services: DataFrame, grace: str = "12 hours",
                     partition: str = "hadm_id") -> DataFrame:
    """Services of the admission transferred to before intime + ``grace``,
    ranked newest first per ``partition`` (the admission, as in the study).

    NULL transfer times (stays with no such service) rank *first*, as a
    descending sort does in PostgreSQL.  The pairs are stored once when the
    frame is built: the rank reads them twice.
    """
    sv = services.select(F.col("hadm_id").alias("_sv_hadm"), "transfertime", "curr_service")
    s = icustays.select(*STAY_KEYS, "intime", shift("intime", grace).alias("_limit"))
    j = left_theta(s, sv, (s.hadm_id == sv._sv_hadm) & (sv.transfertime < s._limit))
    rows = j.select("hadm_id", "icustay_id", "transfertime", "curr_service",
                    surgical_flag("curr_service").alias("surgical"))
    rows = store(rows, "service-pairs")
    ranked = bucketed_rank(rows, [partition], "transfertime", name="rank", descending=True, nulls_first=True)
    return ranked.select("hadm_id", "icustay_id", "curr_service", "surgical", "rank")


def service_rank1(icustays: DataFrame, services: DataFrame, grace: str = "12 hours",
                  partition: str = "hadm_id") -> DataFrame:
    """The rank-1 rows of :func:`service_at_entry` per ``partition``, without ranking its pairs.

    A stay's latest service before its limit (intime + ``grace``) grows with the
    limit.  So a partition needs four numbers, all mergeable aggregates: the
    first transfer of its admission, the earliest and latest limit of its stays,
    and from the last of these ``top``, the latest transfer that any of them
    reaches.

    * If a stay has no service before its limit (the first transfer is not
      before the earliest limit, or a limit is NULL), NULL ranks first: rank 1
      are these stays, without a service.
    * Else rank 1 are the services at time ``top`` with each stay of their
      admission whose limit is after it.

    No window runs over the stays or services.  Returns
    ``(hadm_id, icustay_id, curr_service, surgical)``.
    """
    s = icustays.select(F.col(partition).alias("_part"), "hadm_id", "icustay_id", shift("intime", grace).alias("_limit"))
    known = services.filter(F.col("hadm_id").isNotNull() & F.col("transfertime").isNotNull()).select(
        F.col("hadm_id").alias("_sv_hadm"), F.col("transfertime").alias("_sv_t"), "curr_service")
    limits = s.groupBy(F.col("_part").alias("_g_part"), F.col("hadm_id").alias("_g_hadm")).agg(
        F.min("_limit").alias("_lo"), F.max("_limit").alias("_hi"), F.max(F.col("_limit").isNull()).alias("_open"))
    reached = known.join(limits, known._sv_hadm == limits._g_hadm, "inner").groupBy("_g_part", "_g_hadm", "_lo", "_open").agg(
        F.min("_sv_t").alias("_first"), F.max(F.when(F.col("_sv_t") < F.col("_hi"), F.col("_sv_t"))).alias("_top"))
    j = s.join(reached, s._part.eqNullSafe(reached._g_part) & (s.hadm_id == reached._g_hadm), "left")
    j = j.withColumn("_any", F.col("_first").isNull() | F.col("_open") | (F.col("_first") >= F.col("_lo")))
    if partition != "hadm_id":  # several admissions may meet in a partition
        whole = j.groupBy(F.col("_part").alias("_w_part")).agg(F.max("_any").alias("_w_any"), F.max("_top").alias("_w_top"))
        j = j.join(whole, j._part.eqNullSafe(whole._w_part), "inner").drop("_any", "_top").withColumnsRenamed({"_w_any": "_any", "_w_top": "_top"})
    without = F.col("_first").isNull() | F.col("_limit").isNull() | (F.col("_limit") <= F.col("_first"))
    nulls = j.filter(F.col("_any") & without).select("hadm_id", "icustay_id", F.lit(None).cast("string").alias("curr_service"))
    tops = j.filter(~F.col("_any") & (F.col("_limit") > F.col("_top"))).select("hadm_id", "icustay_id", "_top")
    pairs = tops.join(known, (tops.hadm_id == known._sv_hadm) & (tops._top == known._sv_t), "inner").select(
        "hadm_id", "icustay_id", "curr_service")
    return pairs.unionByName(nulls).withColumn("surgical", surgical_flag("curr_service"))


def select_patients_surgical(icustays: DataFrame, patients: DataFrame, services: DataFrame,
                             min_los: float = 2.0, min_age: float = 16.0) -> DataFrame:
    """Surgical-study cohort: LOS, age, first stay and surgical-service flags.

    Joins each stay to its rank-1 service row(s) (:func:`service_rank1`);
    tied transfer times give more than one row per stay, as in the study.
    """
    base = cohort_base(icustays, patients)
    serv = service_rank1(icustays, services) \
        .select(F.col("icustay_id").alias("_sv_stay"), F.col("surgical").alias("_surgical"))
    j = base.join(serv, base.icustay_id == serv._sv_stay, "left")
    return j.select(
        *STAY_KEYS, "icu_length_of_stay", "age", "icustay_id_order",
        _flag(F.col("icu_length_of_stay") < F.lit(float(min_los))).alias("exclusion_los"),
        _flag(F.col("age") < F.lit(float(min_age))).alias("exclusion_age"),
        _flag(F.col("icustay_id_order") != 1).alias("exclusion_first_stay"),
        _flag(F.col("_surgical") == 1).alias("exclusion_surgical"),
    )


def cohort_with_pf(select_patient: DataFrame, pf: DataFrame) -> DataFrame:
    """All cohort columns plus ``exclusion_pf`` (NULL for stays absent from pf)."""
    return select_patient.join(pf.select(F.col("icustay_id").alias("_pf_stay"), "exclusion_pf"),
                               F.col("icustay_id") == F.col("_pf_stay"), "left").drop("_pf_stay")


def eligible(select_patient: DataFrame, pf: DataFrame) -> DataFrame:
    """Stays with all six flags equal to 0 (a stay missing from pf is dropped)."""
    j = cohort_with_pf(select_patient, pf)
    keep = F.lit(True)
    for c in (*FLAGS, "exclusion_pf"):
        keep = keep & (F.col(c) == 0)
    return j.filter(keep).select(*STAY_KEYS, "intime", "outtime", *FLAGS, "exclusion_pf")
