"""Sinks, sources and physical-plan shape."""

from pyspark.sql import functions as F

from clinframe import operators as op
from clinframe.plans import Study, StudyParams, read_snapshot, rebuild
from clinframe.sources import clinical_tables, list_tables, read_parquet_tables, run_sql
from conftest import SMOKE_DIR
from fixtures import chart_row, frame, ts, T0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_rebuild_stores_what_the_lazy_views_hold(spark, tmp_path):
    tables = clinical_tables(spark, SMOKE_DIR)
    lazy = Study(tables, StudyParams(min_age_years=28.0, note_pattern="%6%"))
    stored = Study(tables, StudyParams(min_age_years=28.0, note_pattern="%6%"))
    paths = rebuild(spark, stored, str(tmp_path / "views"))
    assert list(paths)[0] == "select_patient" and list(paths)[-1] == "matchvalue_lab"
    reread = read_snapshot(spark, str(tmp_path / "views"))
    for view in ("select_patient", "pf", "cohort_with_pf", "eligible", "patientsvalue", "matchvalue", "matchvalue_lab"):
        assert _rows(reread[view]) == _rows(lazy[view]), view


def _joins_on_time(plan: str) -> int:
    """Band joins: joins that compare the event time with the window's bounds."""
    return sum("Join" in line and "_lo" in line for line in plan.split("== Initial Plan ==")[0].splitlines())


def test_each_pivot_runs_its_band_join_once(spark):
    tables = clinical_tables(spark, SMOKE_DIR)
    pivot = op.chart_pivot(tables["icustays"], tables["chartevents"], "v1.2")
    merged = Study(tables, stays=tables["icustays"])["patientsvalue"]
    for df, n in ((pivot, 1), (merged, 2)):
        df.collect()
        assert _joins_on_time(_plan(df)) == n, _plan(df)


def test_event_scan_filters_null_stays(spark, tmp_path):
    path = str(tmp_path / "chartevents")
    frame(spark, "chartevents", [chart_row(100, 454, 4.0)]).write.parquet(path)
    stays = frame(spark, "icustays", [(1, 10, 100, T0, ts(10))])
    plan = _plan(op.chart_pivot(stays, spark.read.parquet(path)))
    assert "isnotnull(icustay_id" in plan and "isnotnull(charttime" in plan, plan


def test_match_values_plan_one_exchange_one_window(spark, tmp_path):
    tables = clinical_tables(spark, SMOKE_DIR)
    values = Study(tables, stays=tables["icustays"])["patientsvalue"]
    path = str(tmp_path / "patientsvalue")
    values.write.parquet(path)
    plan = _plan(op.match_values(spark.read.parquet(path)))
    assert plan.count("Exchange") == 1, plan
    assert plan.count("+- Window [") == 1 and plan.count("Sort [") == 1, plan


def test_item_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "chartevents")
    frame(spark, "chartevents", [chart_row(100, 220045, 80.0)]).write.parquet(path)
    stays = frame(spark, "icustays", [(1, 10, 100, T0, ts(10))])
    df = op.chart_pivot(stays, spark.read.parquet(path), "v1.2")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(itemid), In(itemid" in plan or "In(itemid" in plan, plan
    assert df.filter(F.col("charttime").isNotNull()).count() == 1


def test_sql_text_and_catalog_listing(spark):
    tables = clinical_tables(spark, SMOKE_DIR)
    out = run_sql(spark, "SELECT count(*) AS n FROM icustays", views=tables).collect()[0].n
    assert out == tables["icustays"].count()
    names = {r.name for r in list_tables(spark).collect()}
    assert {"icustays", "chartevents", "labevents"} <= names


def test_rebuild_registers_catalog_tables(spark, tmp_path):
    tables = clinical_tables(spark, SMOKE_DIR)
    study = Study(tables)
    rebuild(spark, study, str(tmp_path / "cat"), views=("select_patient", "po2sevenday"), database="default")
    assert spark.table("default.select_patient").count() == tables["icustays"].count()
    assert "po2sevenday" in {r.name for r in list_tables(spark, "default").collect()}


def test_cluster_settings_scale_with_input():
    from clinframe.session import cluster_settings
    small = cluster_settings(10 * 1024 ** 3)
    big = cluster_settings(100 * 1024 ** 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2) + 1
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_study_checkpoints_deep_views(spark):
    tables = clinical_tables(spark, SMOKE_DIR)
    lazy = Study(tables, StudyParams(min_age_years=28.0, note_pattern="%6%"))["matchvalue"].count()
    st = Study(tables, StudyParams(min_age_years=28.0, note_pattern="%6%"), checkpoint=("eligible", "patientsvalue"))
    plan = st["patientsvalue"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and "Window" not in plan         # lineage cut at the checkpoint
    assert st["matchvalue"].count() == lazy


def test_no_query_plans_pairs_sorts_or_python(spark):
    """No nested-loop / cartesian joins or Python UDFs in any query of the study."""
    import __spark_entry__ as E
    banned = ("NestedLoop", "CartesianProduct", "PythonUDF", "ArrowEval", "BatchEval")
    flagged = {}
    for name, q in E.QUERIES.items():
        df = q(spark, SMOKE_DIR)
        df.write.format("noop").mode("overwrite").save()
        plan = _plan(df)
        hits = [b for b in banned if b in plan]
        if hits:
            flagged[name] = hits
    assert not flagged, flagged


def test_read_parquet_tables_conforms_schema(spark, tmp_path):
    from clinframe.sources.schema import SCHEMAS
    path = str(tmp_path / "tables")
    df = spark.createDataFrame([(1, 2, 3, T0, ts(5), "extra")],
                               "subject_id int, hadm_id int, icustay_id int, intime timestamp_ntz, "
                               "outtime timestamp_ntz, junk string")
    df.write.parquet(f"{path}/icustays")
    got = read_parquet_tables(spark, path, names=["icustays"], conform_schema=True)["icustays"]
    assert got.schema == SCHEMAS["icustays"]


def test_command_line_rebuild(spark, tmp_path):
    from clinframe.__main__ import main
    src = tmp_path / "clinical"
    for name, df in clinical_tables(spark, SMOKE_DIR).items():
        df.write.parquet(str(src / name))
    paths = main(["rebuild", str(src), str(tmp_path / "views"), "--views", "select_patient,po2sevenday,pf"])
    assert list(paths) == ["select_patient", "po2sevenday", "pf"]
    assert spark.read.parquet(paths["pf"]).count() == spark.read.parquet(str(src / "icustays")).count()
