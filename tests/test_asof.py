"""As-of attach: closed bounds, bucket edges, hot keys -- against brute force."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from clinframe import operators as op
from fixtures import T0, ts

SCHEMA_A = "icustay_id long, charttime timestamp_ntz, pao2 double"
SCHEMA_F = "icustay_id long, charttime timestamp_ntz, spo2 double"


def brute(anchors, feats, lookback, skip_null=True):
    out = {}
    for k, t, _ in anchors:
        cands = [(ft, v) for fk, ft, v in feats
                 if fk == k and t is not None and t - lookback <= ft <= t and (v is not None or not skip_null)]
        out[(k, t)] = max(cands)[1] if cands else None
    return out


def test_closed_bounds(spark):
    a = [(1, ts(10), 80.0)]
    for offset, expect in ((timedelta(hours=4), 1.0), (timedelta(hours=4, microseconds=1), None),
                           (timedelta(0), 1.0), (-timedelta(microseconds=1), None)):
        f = [(1, ts(10) - offset, 1.0)]
        got = op.asof_attach(spark.createDataFrame(a, SCHEMA_A), spark.createDataFrame(f, SCHEMA_F),
                             by=("icustay_id",), value_cols=["spo2"], lookback="4 hours").collect()
        assert got[0].spo2 == expect, offset


def test_latest_wins_and_null_handling(spark):
    a = spark.createDataFrame([(1, ts(10), 80.0), (1, None, 81.0), (None, ts(10), 82.0)], SCHEMA_A)
    f = spark.createDataFrame([(1, ts(7), 1.0), (1, ts(9), None)], SCHEMA_F)
    skip = {(r.icustay_id, r.charttime): r.spo2 for r in
            op.asof_attach(a, f, by=("icustay_id",), value_cols=["spo2"], lookback="4 hours").collect()}
    keep = {(r.icustay_id, r.charttime): r.spo2 for r in
            op.asof_attach(a, f, by=("icustay_id",), value_cols=["spo2"], lookback="4 hours",
                           skip_null_values=False).collect()}
    assert skip == {(1, ts(10)): 1.0, (1, None): None, (None, ts(10)): None}
    assert keep[(1, ts(10))] is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_timelines_with_hot_key(spark, seed):
    rnd = random.Random(seed)
    feats, anchors, used = [], [], set()
    for _ in range(600):
        k = 1 if rnd.random() < 0.4 else rnd.randint(2, 6)   # key 1 holds ~40 % of rows
        t = T0 + timedelta(microseconds=rnd.randint(0, 5 * 86_400_000_000))
        if (k, t) in used:
            continue
        used.add((k, t))
        if rnd.random() < 0.3:
            anchors.append((k, t, 1.0))
        else:
            feats.append((k, t, None if rnd.random() < 0.2 else rnd.random()))
    # exact boundary cases
    anchors.append((1, ts(50), 1.0))
    feats += [(1, ts(46), 0.5), (1, ts(46) - timedelta(microseconds=1), 0.25)]
    A = spark.createDataFrame(anchors, SCHEMA_A)
    Fdf = spark.createDataFrame(feats, SCHEMA_F)
    for bucket in ("4 hours", "1 day"):
        for skip in (True, False):
            got = {(r.icustay_id, r.charttime): r.spo2 for r in
                   op.asof_attach(A, Fdf, by=("icustay_id",), value_cols=["spo2"], lookback="4 hours",
                                  bucket=bucket, skip_null_values=skip).collect()}
            assert got == brute(anchors, feats, timedelta(hours=4), skip)


def test_match_values_equals_per_feature_brute_force(spark):
    rnd = random.Random(7)
    rows, seen = [], set()
    for _ in range(500):
        k = rnd.choice([1, 1, 1, 2, 3])
        t = T0 + timedelta(minutes=rnd.randint(0, 4 * 24 * 60))
        if (k, t) in seen:
            continue
        seen.add((k, t))
        rows.append((0, 0, k, t, *[(round(rnd.random(), 3) if rnd.random() < 0.3 else None) for _ in range(3)]))
    df = spark.createDataFrame(rows, "subject_id long, hadm_id long, icustay_id long, charttime timestamp_ntz, "
                                     "pao2 double, spo2 double, hr double")
    got = {(r.icustay_id, r.charttime): (r.spo2, r.hr) for r in
           op.match_values(df, features={"spo2": 2, "hr": 4}, bucket="6 hours").collect()}
    anchors = [(r[2], r[3], r[4]) for r in rows if r[4] is not None]
    sp = brute(anchors, [(r[2], r[3], r[5]) for r in rows], timedelta(hours=2))
    hr = brute(anchors, [(r[2], r[3], r[6]) for r in rows], timedelta(hours=4))
    assert got == {key: (sp[key], hr[key]) for key in sp}


def test_candidates_are_range_join(spark):
    a = spark.createDataFrame([(1, ts(10), 80.0), (1, ts(30), 81.0)], SCHEMA_A)
    f = spark.createDataFrame([(1, ts(6), 1.0), (1, ts(8), 2.0), (1, ts(10), 3.0), (1, ts(11), 4.0)], SCHEMA_F)
    rows = op.asof_candidates(a, f, by=("icustay_id",), value_cols=["spo2"], lookback="4 hours").collect()
    got = sorted((r.charttime, r.rn, r.spo2) for r in rows)
    assert got == [(ts(10), 1, 3.0), (ts(10), 2, 2.0), (ts(10), 3, 1.0), (ts(30), 1, None)]


@pytest.mark.parametrize("descending", [False, True])
def test_bucketed_rank_equals_plain_window(spark, descending):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rnd = random.Random(11)
    rows = []
    for i in range(800):
        k = 1 if rnd.random() < 0.5 else rnd.choice([2, 3, None])
        t = None if rnd.random() < 0.05 else T0 + timedelta(hours=rnd.randint(0, 24 * 60) / 4)
        rows.append((i, k, t))
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz")
    ranked = op.bucketed_rank(df, ["k"], "t", descending=descending, bucket="3 days")
    order = F.col("t").desc_nulls_first() if descending else F.col("t").asc_nulls_last()
    plain = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(order)))
    got = {r.id: r["rank"] for r in ranked.collect()}
    assert got == {r.id: r.r for r in plain.collect()}
    rn = op.bucketed_rank(df.filter("t is not null"), ["k"], "t", method="row_number", bucket="1 day")
    by_key = {}
    for r in rn.collect():
        by_key.setdefault(r.k, []).append((r.t, r["rank"]))
    for k, pairs in by_key.items():
        pairs.sort(key=lambda p: p[1])
        assert [p[1] for p in pairs] == list(range(1, len(pairs) + 1))
        assert [p[0] for p in pairs] == sorted(p[0] for p in pairs)


def test_carry_forward_equals_unbounded_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    rows, seen = [], set()
    for i in range(700):
        k = 1 if rnd.random() < 0.5 else rnd.choice([2, 3, None])
        t = T0 + timedelta(minutes=rnd.randint(0, 6 * 24 * 60))
        if (k, t) in seen:
            continue
        seen.add((k, t))
        rows.append((i, k, t, i if rnd.random() < 0.1 else None))
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, v long")
    got = {r.id: r.c for r in op.carry_forward(df, by=["k"], time="t", value="v", name="c",
                                               bucket="6 hours").collect()}
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: r.c for r in df.withColumn("c", F.last("v", ignorenulls=True).over(w)).collect()}
    assert got == want


def test_candidates_random_against_brute_force(spark):
    rnd = random.Random(13)
    anchors, feats, used = [], [], set()
    for _ in range(400):
        k = 1 if rnd.random() < 0.5 else rnd.randint(2, 4)
        t = T0 + timedelta(minutes=rnd.randint(0, 3 * 24 * 60))
        if (k, t) in used:
            continue
        used.add((k, t))
        (anchors if rnd.random() < 0.3 else feats).append((k, t, rnd.random()))
    a0 = anchors[0]
    feats += [(a0[0], a0[1] - timedelta(hours=4), 0.1), (a0[0], a0[1] - timedelta(hours=4, microseconds=1), 0.2)]
    rows = op.asof_candidates(spark.createDataFrame(anchors, SCHEMA_A), spark.createDataFrame(feats, SCHEMA_F),
                              by=("icustay_id",), value_cols=["spo2"], lookback="4 hours").collect()
    got = {}
    for r in rows:
        got.setdefault((r.icustay_id, r.charttime), []).append((r.rn, r.spo2))
    for k, t, _ in anchors:
        cands = sorted(((ft, v) for fk, ft, v in feats if fk == k and t - timedelta(hours=4) <= ft <= t),
                       reverse=True)
        want = [(i + 1, v) for i, (_, v) in enumerate(cands)] or [(1, None)]
        assert sorted(got[(k, t)]) == want, (k, t)
    assert len(got) == len(anchors)


def test_dense_day_takes_linear_time(spark):
    """Ten and forty thousand rows in one stay and day: about four times the work, not sixteen."""
    import time

    from clinframe.functions.rules import MATCH_FEATURES

    def seconds(n):
        v = spark.range(n).select(
            F.lit(1).cast("long").alias("subject_id"), F.lit(1).cast("long").alias("hadm_id"), F.lit(1).cast("long").alias("icustay_id"),
            F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000)").alias("charttime"),
            F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("pao2"),
            *[F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).alias(n) for n in MATCH_FEATURES])
        best = 1e9
        for _ in range(2):
            t = time.perf_counter()
            op.match_values(v).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t)
        return best

    seconds(1000)
    small, large = seconds(10_000), seconds(40_000)
    assert large < 8 * max(small, 0.5), (small, large)


def test_repeated_anchor_rows(spark):
    """Each row is an anchor of its own; the chained form keeps one per (stay, time)."""
    from clinframe.functions.rules import MATCH_FEATURES
    cols = "subject_id long, hadm_id long, icustay_id long, charttime timestamp_ntz, pao2 double, " + ", ".join(f"{n} double" for n in MATCH_FEATURES)
    rows = [(1, 1, 1, T0, 80.0, *[1.0] * len(MATCH_FEATURES))] * 2
    v = spark.createDataFrame(rows, cols)
    assert op.match_values(v).count() == 2
    assert op.match_values_chain(v).count() == 1


def test_chain_derives_its_values_once(spark):
    """The links read stored values: a derived view is not derived anew in each of them."""
    from clinframe.functions.rules import MATCH_FEATURES
    cols = "subject_id long, hadm_id long, icustay_id long, charttime timestamp_ntz, pao2 double, " + ", ".join(f"{n} double" for n in MATCH_FEATURES)
    rnd = random.Random(5)
    rows = [(1, 1, rnd.randint(1, 3), T0 + timedelta(minutes=20 * i), *[None if rnd.random() < 0.6 else rnd.random() for _ in range(1 + len(MATCH_FEATURES))])
            for i in range(200)] + [(1, 1, 1, None, 70.0, *[1.0] * len(MATCH_FEATURES))]
    keys = ["subject_id", "hadm_id", "icustay_id", "charttime"]
    view = spark.createDataFrame(rows, cols).groupBy(*keys).agg(*[F.max(n).alias(n) for n in ("pao2", *MATCH_FEATURES)])
    chain = op.match_values_chain(view)
    assert "Aggregate" not in chain._jdf.queryExecution().optimizedPlan().toString()
    want = op.match_values(view)
    assert chain.columns == want.columns
    assert sorted(map(str, chain.collect())) == sorted(map(str, want.collect()))
