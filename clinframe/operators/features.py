"""Derived clinical features: P/F ratio, P/F exclusion, arterial-specimen score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.functions import rules as R
from clinframe.operators.asof import asof_attach, asof_candidates

STAY_KEYS = ("subject_id", "hadm_id", "icustay_id")


def pf_ratio(po2: DataFrame, fio2_charted: DataFrame, lookback: str = "4 hours") -> DataFrame:
    """PaO2/FiO2 per lab row: ``100 * po2 / coalesce(lab fio2, charted fio2)``.

    The charted FiO2 is the latest charted row (even if its value is NULL)
    within ``lookback`` before the sample.  A zero FiO2 gives NULL rather
    than an error (``try_divide``).  Every row of ``po2`` is kept: where a stay
    is listed under two admissions, both of its rows are.
    """
    fio2 = fio2_charted.select("icustay_id", "charttime", "fio2_chartevents")
    rows = asof_attach(po2, fio2, by=("icustay_id",), value_cols=["fio2_chartevents"],
                       lookback=lookback, skip_null_values=False)
    denom = F.coalesce(F.col("fio2"), F.col("fio2_chartevents"))
    pf = F.when(F.col("po2").isNotNull() & denom.isNotNull(),
                F.try_divide(F.lit(100.0) * F.col("po2"), denom))
    return rows.withColumn("pf", pf)


def pf_exclusion(pf: DataFrame, threshold: float = 300.0, stays: DataFrame | None = None) -> DataFrame:
    """Per stay: ``minpf`` and ``exclusion_pf`` = 1 when minpf > threshold or NULL.

    With ``stays``, ``pf`` may hold only the rows of stays that have labs:
    every other stay gets ``minpf`` NULL (so ``exclusion_pf`` 1), which is
    what its single NULL-time row would give.
    """
    agg = pf.groupBy(*STAY_KEYS).agg(F.min("pf").alias("minpf"))
    if stays is not None:
        agg = stays.select(*STAY_KEYS).distinct().join(agg, list(STAY_KEYS), "left")
    flag = F.when((F.col("minpf") > F.lit(float(threshold))) | F.col("minpf").isNull(), F.lit(1)).otherwise(F.lit(0))
    return agg.withColumn("exclusion_pf", flag)


def specimen_probability(bloodgas: DataFrame, spo2: DataFrame, fio2_charted: DataFrame,
                         latest_only: bool = False) -> DataFrame:
    """Probability that a blood gas is arterial (logistic model).

    Anchors are blood-gas rows with a PaO2.  SpO2 is the latest staged row
    within 2 h; charted FiO2 rows within 4 h are all emitted, numbered newest
    first in ``lastrowfio2`` (as the study does), unless ``latest_only``.
    Missing features are imputed with ``coef * mean + offset``.
    """
    bg = bloodgas.filter(F.col("po2").isNotNull())
    s = spo2.select("icustay_id", "charttime", "spo2")
    # Buckets of four hours serve both lookbacks: blood gases and SpO2 rows are
    # exchanged once, FiO2 rows once, and the numbering needs no exchange.
    with_spo2 = asof_attach(bg, s, by=("icustay_id",), value_cols=["spo2"], lookback="2 hours", skip_null_values=False,
                            bucket="4 hours", bucket_name="_four_hours").withColumn("lastrowspo2", F.lit(1).cast("long"))
    f = fio2_charted.select("icustay_id", "charttime", "fio2_chartevents")
    rows = asof_candidates(with_spo2, f, by=("icustay_id",), value_cols=["fio2_chartevents"],
                           lookback="4 hours", rank_name="lastrowfio2", bucket_name="_four_hours")
    if latest_only:
        rows = rows.filter(F.col("lastrowfio2") == 1)
    score = F.lit(R.SPECIMEN_INTERCEPT) + F.lit(R.SPECIMEN_PO2_COEF) * F.col("po2")
    for name, coef, mean, offset in R.SPECIMEN_TERMS:
        score = score + F.coalesce(F.lit(coef) * F.col(name), F.lit(coef) * F.lit(mean) + F.lit(offset))
    return rows.withColumn("specimen_prob", F.lit(1.0) / (F.lit(1.0) + F.exp(-score)))
