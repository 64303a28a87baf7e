"""One exchange from the logs to the match table, dense stay-days, shared laboratory panels, snapshots, profiles."""

import os
import re

import pytest
from pyspark.sql import functions as F

from clinframe import operators as op
from clinframe import session
from clinframe.functions import rules as R
from clinframe.functions.rules import MATCH_FEATURES
from clinframe.plans import Study, StudyParams, publish, read_snapshot, rebuild, snapshot_paths
from clinframe.sources import clinical_tables, write_bucketed
from conftest import SMOKE_DIR
from fixtures import T0, chart_row, frame, ts

PARAMS = {"min_age_years": 28.0, "note_pattern": "%6%"}


def _plan(df) -> str:
    """The executed plan: of a query that ran, the one that adaptive execution ended with."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The clinical tables as stored Parquet."""
    root = str(tmp_path_factory.mktemp("clinical"))
    out = {}
    for name, df in clinical_tables(spark, SMOKE_DIR).items():
        df.write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


@pytest.fixture(scope="module")
def merged(spark, stored, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("merged") / "values")
    Study(stored, stays=stored["icustays"])["patientsvalue"].write.parquet(path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------- from the logs

@pytest.mark.parametrize("version", ["v1.1", "v1.2"])
@pytest.mark.parametrize("anchor", ["pao2", "pao2_c", "pao2_l"])
def test_match_from_logs_equals_pivots_merge_and_match(spark, stored, version, anchor):
    study = Study(stored, StudyParams(chart_version=version), stays=stored["icustays"])
    staged = op.match_values(study["patientsvalue"], anchor=anchor)
    direct = op.match_from_logs(stored["icustays"], stored["chartevents"], stored["labevents"], anchor, version=version)
    assert staged.columns == direct.columns
    assert _rows(staged) == _rows(direct) and direct.count() > 0


@pytest.mark.parametrize("small_stays", [True, False])
def test_match_from_logs_has_one_exchange_for_the_logs(spark, stored, small_stays):
    stays = stored["icustays"] if small_stays else stored["icustays"].hint("shuffle_merge")
    df = op.match_from_logs(stays, stored["chartevents"], stored["labevents"])
    df.collect()
    plan = _plan(df)
    shuffles = re.findall(r"(?<!Broadcast)Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(shuffles) == (1 if small_stays else 2), plan               # both logs together, and the stays
    assert ("SortMergeJoin" in plan) != small_stays
    assert all(re.sub(r"#\d+L?", "", s).startswith(("subject_id, hadm_id, _b", "_s_subject_id, _s_hadm_id, _s_b")) for s in shuffles), shuffles
    assert len(re.findall(r"\bWindow \[", plan)) == 1 and plan.count("SortMergeJoin") <= 1, plan
    scans = re.findall(r"FileScan parquet.*?Location: [^\[]*\[([^\]]*)", plan)
    assert sum("chartevents" in s for s in scans) == 1 and sum("labevents" in s for s in scans) == 1, scans
    assert "PushedFilters: [In(itemid" in plan.replace("IsNotNull(itemid), ", "") or "In(itemid" in plan


def test_study_matches_the_eligible_cohort_without_storing_the_merge(spark, stored):
    with session.scratch(spark) as paths:
        direct = Study(stored, StudyParams(**PARAMS))
        rows = _rows(direct["matchvalue"])
        assert not any("patientsvalue" in p for p in paths)
        assert rows == _rows(op.match_values(direct["patientsvalue"]))
        assert _rows(direct["matchvalue_lab"]) == _rows(op.match_values(direct["patientsvalue"], anchor="pao2_l"))


def test_events_carry_over_midnight_only_inside_the_stay(spark):
    stays = frame(spark, "icustays", [(1, 10, 100, T0, ts(20)), (1, 10, 101, ts(20.5), ts(40)), (2, 20, 200, T0, None)])
    chart = frame(spark, "chartevents", [
        chart_row(100, 220045, 80.0, 15.5), chart_row(100, 220045, 81.0, 17.0),        # 23:30, 01:00
        chart_row(101, 220045, 90.0, 20.6), chart_row(100, 220045, 70.0, 25.0)])       # the last after the stay's end
    po2 = next(i for i, label in R.LAB_PF_LABELS.items() if label == "po2")
    labs = frame(spark, "labevents", [(1, 10, po2, ts(h), None, 90.0) for h in (15.9, 16.5, 19.5, 21.0, 30.0)])
    got = {(r.icustay_id, r.charttime): r.hr for r in op.match_from_logs(stays, chart, labs).collect()}
    assert got == {(100, ts(15.9)): 80.0, (100, ts(16.5)): 80.0, (100, ts(19.5)): 81.0, (101, ts(21.0)): 90.0, (101, ts(30.0)): None}
    study = Study({"icustays": stays, "chartevents": chart, "labevents": labs}, stays=stays)
    assert _rows(op.match_values(study["patientsvalue"])) == _rows(op.match_from_logs(stays, chart, labs))


def test_match_from_logs_of_empty_logs(spark):
    stays = frame(spark, "icustays", [(1, 10, 100, T0, ts(20))])
    out = op.match_from_logs(stays, frame(spark, "chartevents", []), frame(spark, "labevents", []))
    assert out.count() == 0 and out.columns[-1] == list(MATCH_FEATURES)[-1]


# --------------------------------------------------------------------- dense stay-days

def _dense(values):
    """A third of the rows moved into one day of one stay, times distinct."""
    hot = F.col("icustay_id") % 5 < 2
    dense = F.expr("timestampadd(MICROSECOND, 20000000 + pmod(xxhash64(icustay_id, charttime), 70000000000), timestamp_ntz'2030-05-05 00:00:00')")
    return (values.filter("charttime is not null").withColumn("charttime", F.when(hot, dense).otherwise(F.col("charttime")))
            .withColumn("icustay_id", F.when(hot, F.lit(-1)).otherwise(F.col("icustay_id")))
            .withColumn("subject_id", F.when(hot, F.lit(-1)).otherwise(F.col("subject_id")))
            .withColumn("hadm_id", F.when(hot, F.lit(-1)).otherwise(F.col("hadm_id"))).dropDuplicates(["icustay_id", "charttime"]))


def test_dense_day_is_cut_into_pieces_with_equal_results(spark, merged, tmp_path):
    path = str(tmp_path / "dense")
    _dense(merged).write.parquet(path)
    values = spark.read.parquet(path)
    n = values.count()
    hot = values.filter("icustay_id = -1").count()
    assert hot > 0.3 * n
    whole = op.match_values(values, dense_rows=None)
    pieces = op.match_values(values, dense_rows=max(hot // 40, 10))
    assert _rows(whole) == _rows(pieces)
    keys = ["icustay_id", "_b"]
    rows = values.withColumn("_us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', charttime)"))
    rows = rows.withColumn("_b", F.expr("_us div 86400000000"))
    cuts = op.dense_cuts(rows, keys, max(hot // 40, 10))
    sizes = [r["count"] for r in op.with_piece(rows, keys, cuts).groupBy(*keys, "_sub").count().collect()]
    assert max(sizes) <= 0.05 * n, (max(sizes), n)                      # window partitions: (stay, day, piece)


def test_dense_day_of_the_logs_is_cut_into_pieces(spark, stored):
    # every event of the table on one day of one stay
    day = F.expr("timestampadd(MICROSECOND, pmod(xxhash64(itemid, charttime), 80000000000), timestamp_ntz'2030-05-05 00:00:00')")
    one = lambda df, **k: df.withColumns({"subject_id": F.lit(1), "hadm_id": F.lit(10), "charttime": day, **k})
    chart, labs = one(stored["chartevents"], icustay_id=F.lit(100)), one(stored["labevents"])
    stays = spark.sql("SELECT 1 AS subject_id, 10 AS hadm_id, 100 AS icustay_id, timestamp_ntz'2030-05-04 12:00:00' AS intime, "
                      "timestamp_ntz'2030-05-06 12:00:00' AS outtime")
    whole = op.match_from_logs(stays, chart, labs, dense_rows=None)
    assert _rows(whole) == _rows(op.match_from_logs(stays, chart, labs, dense_rows=50)) and whole.count() > 10


def test_dense_asof_equals_plain(spark):
    rows = [(1, ts(i / 100), None if i % 7 == 0 else float(i)) for i in range(600)] + [(2, ts(i), float(i)) for i in range(30)] + [(None, ts(1), 5.0), (3, None, 6.0)]
    feature = spark.createDataFrame(rows, "k long, charttime timestamp_ntz, v double")
    anchor = spark.createDataFrame([(1, ts(i / 50)) for i in range(400)] + [(1, ts(3))] * 40 + [(2, ts(2.5)), (None, ts(1)), (3, None)],
                                   "k long, charttime timestamp_ntz")
    for skip in (True, False):
        make = lambda n: op.asof_attach(anchor, feature, by=("k",), value_cols=["v"], lookback="30 minutes", feature_time="at",
                                        skip_null_values=skip, dense_rows=n)
        assert _rows(make(None)) == _rows(make(25))


# --------------------------------------------------------------------- shared laboratory panels

def test_panels_equal_the_single_pivots(spark, stored):
    with session.scratch(spark):
        got = op.stored_panels(stored["icustays"], stored["labevents"])
        want = {"first_day": op.lab_first_day(stored["icustays"], stored["labevents"]),
                "seven_day": op.lab_seven_day(stored["icustays"], stored["labevents"]),
                "in_stay": op.lab_in_stay(stored["icustays"], stored["labevents"])}
        for name, df in want.items():
            assert _rows(got[name]) == _rows(df), name


def test_panels_scan_the_log_once(spark, stored):
    df = op.lab_panels(stored["icustays"], stored["labevents"])
    df.collect()
    scans = re.findall(r"FileScan parquet.*?Location: [^\[]*\[([^\]]*)", _plan(df))
    assert sum("labevents" in s for s in scans) == 1, scans
    with session.scratch(spark):
        study = Study(stored, StudyParams(**PARAMS, share_labs=True))
        plan = _plan(study["pf"]) + _plan(study["patientslab"])
        assert "labevents" not in plan and "lab-panels" in plan
        lazy = Study(stored, StudyParams(**PARAMS))
        for view in ("pf", "patientslab", "patientsvalue"):
            assert _rows(study[view]) == _rows(lazy[view]), view


def test_panels_with_missing_bounds_and_options(spark):
    stays = frame(spark, "icustays", [(1, 10, 100, T0, None), (1, 10, 101, None, ts(9)), (2, 20, 200, T0, ts(5))])
    labs = frame(spark, "labevents", [(s, h, 50821, ts(t), "ART", 80.0) for s, h in ((1, 10), (2, 20)) for t in (1, 4, 30)])
    with session.scratch(spark):
        got = op.stored_panels(stays, labs, keep_negative_base_excess=True)
        for name, one in (("seven_day", op.lab_seven_day), ("in_stay", op.lab_in_stay)):
            assert _rows(got[name]) == _rows(one(stays, labs, keep_negative_base_excess=True)), name


# --------------------------------------------------------------------- snapshots and stored tables

def test_failed_rebuild_leaves_the_old_snapshot(spark, stored, tmp_path, monkeypatch):
    sink, views = str(tmp_path / "sink"), ("select_patient", "po2sevenday", "pf")
    study = Study(stored, StudyParams(**PARAMS))
    rebuild(spark, study, sink, views, database="default")
    before, old = snapshot_paths(spark, sink), {n: _rows(df) for n, df in read_snapshot(spark, sink).items()}

    def broken(self):
        raise RuntimeError("lost")
    monkeypatch.setattr(Study, "_build_pf_rows", broken)
    with pytest.raises(RuntimeError, match="lost"):
        rebuild(spark, Study(stored, StudyParams()), sink, views, database="default")
    assert snapshot_paths(spark, sink) == before
    assert {n: _rows(df) for n, df in read_snapshot(spark, sink).items()} == old
    assert _rows(spark.table("default.pf")) == old["pf"]
    monkeypatch.undo()

    # killed without a chance to clean up: an uncommitted folder stays, unseen, until the next rebuild
    os.makedirs(f"{sink}/versions/half/select_patient")
    assert snapshot_paths(spark, sink) == before
    after = rebuild(spark, Study(stored, StudyParams()), sink, views, database="default")
    assert snapshot_paths(spark, sink) == after != before
    assert _rows(spark.table("default.select_patient")) == _rows(read_snapshot(spark, sink)["select_patient"]) != old["select_patient"]
    assert len(os.listdir(f"{sink}/versions")) == 2                      # this one and the one before
    for v in views:
        spark.sql(f"DROP TABLE default.{v}")


def test_publish_can_be_repeated(spark, stored, tmp_path):
    sink = str(tmp_path / "sink")
    rebuild(spark, Study(stored), sink, ("select_patient",))
    for _ in range(2):
        publish(spark, sink, "default")
    assert spark.table("default.select_patient").count() == stored["icustays"].count()
    spark.sql("DROP TABLE default.select_patient")


def test_rebuild_twice_with_one_study_reads_the_sources_again(spark, stored, tmp_path):
    sink, study = str(tmp_path / "sink"), Study(dict(stored))
    rebuild(spark, study, sink, ("select_patient",), keep=1)
    study.t["icustays"] = stored["icustays"].limit(0)
    rebuild(spark, study, sink, ("select_patient",), keep=1)
    assert read_snapshot(spark, sink)["select_patient"].count() == 0
    assert len(os.listdir(f"{sink}/versions")) == 1


def test_rebuild_and_scratch_leave_no_stored_table(spark, stored, tmp_path):
    folder = session.checkpoint_dir(spark)
    session.release_stored(spark)
    before = set(os.listdir(folder))
    rebuild(spark, Study(stored, StudyParams(**PARAMS)), str(tmp_path / "sink"))
    assert set(os.listdir(folder)) == before
    with pytest.raises(ValueError), session.scratch(spark) as paths:
        session.store(stored["icustays"], "x")
        assert len(paths) == 1 and os.path.exists(paths[0])
        raise ValueError
    assert set(os.listdir(folder)) == before
    session.store(stored["icustays"], "y")
    assert session.release_stored(spark) == 1 and set(os.listdir(folder)) == before


def test_rebuild_without_checkpoint_folder_leaves_none_behind(spark, stored, tmp_path, monkeypatch):
    sink = str(tmp_path / "sink")
    monkeypatch.setattr(session, "CHECKPOINT_SETTING", "spark.none.such")
    with pytest.raises(ValueError, match="unset"):
        session.checkpoint_dir(spark)
    rebuild(spark, Study(stored), sink, ("select_patient",))
    assert sorted(os.listdir(sink)) == ["commits", "versions"]
    with pytest.raises(ValueError, match="unset"):
        session.checkpoint_dir(spark)


# --------------------------------------------------------------------- bucketed storage, profiles, top rows

def test_bucketed_values_need_no_exchange(spark, merged):
    table = write_bucketed(merged.filter("icustay_id is not null"), "default.values_by_stay", ["icustay_id"], ["charttime"], 4)
    try:
        df = op.match_values(table, dense_rows=None)
        plan = _plan(df)
        assert "Exchange" not in plan and "Window [" in plan, plan
        assert _rows(df) == _rows(op.match_values(merged.filter("icustay_id is not null")))
        ranked = table.groupBy("icustay_id", "charttime").agg(F.max("hr"))
        assert "Exchange" not in _plan(ranked)
    finally:
        spark.sql("DROP TABLE default.values_by_stay")


def test_missing_profile_from_one_pass(spark, stored):
    df = op.chart_pivot(stored["icustays"], stored["chartevents"])
    patterns, per_column = op.missing_profile(df)
    assert _rows(patterns) == _rows(op.missing_patterns(df)) and _rows(per_column) == _rows(op.missing_per_column(df))
    for part in (patterns, per_column):
        assert "chartevents" not in _plan(part) and "missing-masks" in _plan(part)


def test_missing_profile_of_many_columns_and_no_rows(spark):
    wide = spark.range(5).select(*[F.when(F.col("id") % (i + 2) == 0, F.lit(1)).alias(f"c{i}") for i in range(70)])
    patterns, per_column = op.missing_profile(wide)
    assert _rows(patterns) == _rows(op.missing_patterns(wide)) and _rows(per_column) == _rows(op.missing_per_column(wide))
    none, zero = op.missing_profile(wide.limit(0))
    assert none.count() == 0 and _rows(zero) == _rows(op.missing_per_column(wide.limit(0)))


def test_latest_per_group_breaks_ties_without_a_window(spark):
    rows = [(1, ts(1), "A"), (1, ts(2), "B"), (1, ts(2), "C"), (2, ts(5), "Z"), (2, None, "N"), (3, None, None), (None, ts(1), "Q")]
    df = spark.createDataFrame(rows, "hadm_id long, transfertime timestamp_ntz, curr_service string")
    out = op.latest_per_group(df, ["hadm_id"], "transfertime", ["curr_service"])
    assert {tuple(r) for r in out.collect()} == {(1, ts(2), "C"), (2, None, "N"), (3, None, None), (None, ts(1), "Q")}
    assert "Window" not in _plan(out)


def test_service_rank1_reads_its_inputs_without_a_window(spark, stored):
    out = op.service_rank1(stored["icustays"], stored["services"])
    out.collect()
    plan = _plan(out)
    assert "Window" not in plan and len(re.findall(r"(?<!Broadcast)Exchange ", plan)) <= 8, plan
    surgical = op.select_patients_surgical(stored["icustays"], stored["patients"], stored["services"])
    surgical.collect()
    assert len(re.findall(r"\bWindow \[", _plan(surgical))) <= 2       # those of the rank of the stays


def test_left_theta_stores_nothing(spark, stored):
    before = list(session._owned[-1])
    icu = stored["icustays"].select("hadm_id", "icustay_id", "intime")
    sv = stored["services"].select(F.col("hadm_id").alias("_h"), "transfertime")
    j = op.left_theta(icu, sv, (icu.hadm_id == sv._h) & (sv.transfertime < icu.intime))
    plain = icu.join(sv, (icu.hadm_id == sv._h) & (sv.transfertime < icu.intime), "left")
    assert _rows(j) == _rows(plain) and session._owned[-1] == before


def test_specimen_probability_exchanges_each_input_once(spark, stored, tmp_path):
    for name, df in {"bg": op.lab_first_day(stored["icustays"], stored["labevents"], keep_empty=False),
                     "spo2": op.stage_spo2(stored["chartevents"]), "fio2": op.normalize_fio2(stored["chartevents"])}.items():
        df.write.parquet(str(tmp_path / name))
    bg, spo2, fio2 = (spark.read.parquet(str(tmp_path / n)) for n in ("bg", "spo2", "fio2"))
    plan = op.specimen_probability(bg, spo2, fio2.hint("shuffle_merge"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan             # blood gases with SpO2, and FiO2


def test_endless_window_is_an_error(spark):
    stays = spark.sql("SELECT 1L AS subject_id, 10L AS hadm_id, 100L AS icustay_id, timestamp_ntz'2024-01-01 00:00:00' AS intime, "
                      "timestamp_ntz'9999-12-31 00:00:00' AS outtime")
    labs = frame(spark, "labevents", [(1, 10, 50821, ts(1), "ART", 80.0)])
    with pytest.raises(Exception, match="window of too many buckets: 2024-01-01 00:00:00 to 9999-12-31"):
        op.lab_in_stay(stays, labs).collect()
    assert op.lab_first_day(stays, labs).count() == 1
