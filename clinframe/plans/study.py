"""The study's view DAG, lazily as DataFrames, and a materialising rebuild.

::

    icustays patients vent notes heightweight detail -> select_patient
    icustays labevents -> po2sevenday --+
    chartevents -----------------------+-> pf
    select_patient + pf -> eligible -> patientschart, patientslab
    patientschart FULL JOIN patientslab -> patientsvalue -> matchvalue, matchvalue_lab

``rebuild`` writes each view as Parquet in DAG order and re-reads it, so
later views start from stored files (lineage is cut and a lost executor only
recomputes the current view).  A rebuild is a version of its own; readers see
it from the moment its commit is appended, see :func:`rebuild`.
"""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinframe.operators import asof, clean, cohort, features, labs, merge, pivot, timeline
from clinframe.session import checkpoint_dir, checkpoints_below, delete_folder, list_folder, scratch

ORDER = ("select_patient", "po2sevenday", "fio2_chart", "pf", "cohort_with_pf", "eligible", "patientschart",
         "patientslab", "patientsvalue", "matchvalue", "matchvalue_lab")


@dataclass
class StudyParams:
    chart_version: str = "v1.2"
    min_los_days: float = 1.0
    min_age_years: float = 16.0
    note_category: str = "Radiology"
    note_pattern: str = "%CHEST%"
    pf_threshold: float = 300.0
    # Options for behaviours of the study that look unintended (off by default).
    treat_missing_as_zero: bool = False
    fio2_range: tuple[float, float] | None = None
    keep_negative_base_excess: bool = False
    # Read the laboratory log once for all of its views (stores the panels when the first is built).
    share_labs: bool = False
    # Rows of a stay-day above which its match is cut into pieces (None: never).
    dense_rows: int | None = asof.DENSE_ROWS


class Study:
    """Views over a dict of clinical tables; each is built once, when first asked for.

    Building runs jobs where a view needs a stored or measured input: ranks
    store their rows, the match tables count dense stay-days, shared
    laboratory panels are stored.  The views themselves are lazy.

    ``stays`` overrides the stays fed to the chart and lab pivots (default:
    the eligible cohort, as in the study).  Views named in ``checkpoint`` are
    checkpointed (reliably, to ``spark.checkpoint.dir``) when first built.
    """

    def __init__(self, tables: dict[str, DataFrame], params: StudyParams | None = None,
                 stays: DataFrame | None = None, checkpoint: tuple[str, ...] = ()):
        self.t = tables
        self.p = params or StudyParams()
        self._stays = stays
        self._checkpoint = set(checkpoint)
        self._cache: dict[str, DataFrame] = {}
        self._stored: set[str] = set()
        self.share_labs = self.p.share_labs

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = getattr(self, f"_build_{name}")()
            if name in self._checkpoint:
                # Reliable checkpoint into the session's spark.checkpoint.dir
                # (a shared folder on a cluster): cuts the lineage of deep views.
                df.sparkSession.sparkContext.setCheckpointDir(checkpoint_dir(df.sparkSession))
                df = df.checkpoint(eager=True)
            self._cache[name] = df
        return self._cache[name]

    def put(self, name: str, df: DataFrame) -> None:
        """Use ``df`` as view ``name`` from now on (a stored copy, say)."""
        self._cache[name] = df
        self._stored.add(name)

    def forget(self, *names: str) -> None:
        """Forget the views ``names`` and all that aren't stored; they are built anew when asked for again."""
        self._stored -= set(names)
        self._cache = {n: df for n, df in self._cache.items() if n in self._stored}

    # -- cohort ----------------------------------------------------------
    def _build_cohort_base(self):
        return cohort.cohort_base(self.t["icustays"], self.t["patients"], self.t["ventfirstday"])

    def _build_chest(self):
        return cohort.count_events_in_stay(self.t["icustays"], self.t["noteevents"],
                                           self.p.note_category, self.p.note_pattern)

    def _build_select_patient(self):
        return cohort.select_patients(self["cohort_base"], self["chest"], self.t["heightweight"],
                                      self.t["icustay_detail"], self.p.min_los_days, self.p.min_age_years,
                                      self.p.treat_missing_as_zero)

    # -- P/F -------------------------------------------------------------
    def _build_lab_panels(self):
        panels = {n: labs.PANELS[n] for n in ("seven_day", "in_stay")}
        return labs.stored_panels(self.t["icustays"], self.t["labevents"], panels, **self._lab_options())

    def _build_po2sevenday(self):
        if self.share_labs:
            return self["lab_panels"]["seven_day"]
        return pivot.lab_seven_day(self.t["icustays"], self.t["labevents"], **self._lab_options())

    def _lab_options(self):
        return {"fio2_range": self.p.fio2_range, "keep_negative_base_excess": self.p.keep_negative_base_excess}

    def _build_fio2_chart(self):
        return clean.normalize_fio2(self.t["chartevents"])

    def _build_pf_rows(self):
        return features.pf_ratio(self["po2sevenday"], self["fio2_chart"])

    def _build_pf(self):
        return features.pf_exclusion(self["pf_rows"], self.p.pf_threshold)

    def _build_cohort_with_pf(self):
        return cohort.cohort_with_pf(self["select_patient"], self["pf"])

    def _build_eligible(self):
        return cohort.eligible(self["select_patient"], self["pf"])

    # -- values ----------------------------------------------------------
    def _stays_for_pivots(self):
        return self._stays if self._stays is not None else self["eligible"]

    def _build_patientschart(self):
        return pivot.chart_pivot(self._stays_for_pivots(), self.t["chartevents"], self.p.chart_version)

    def _build_patientslab(self):
        if self.share_labs:
            return labs.of_stays(self["lab_panels"]["in_stay"], self._stays_for_pivots())
        return pivot.lab_in_stay(self._stays_for_pivots(), self.t["labevents"], **self._lab_options())

    def _build_patientsvalue(self):
        return merge.merge_sources(self["patientschart"], self["patientslab"])

    def _match(self, anchor: str) -> DataFrame:
        """From the merged view where it is stored, else straight from the logs (one exchange, no merged view)."""
        if "patientsvalue" in self._stored:
            return asof.match_values(self["patientsvalue"], anchor=anchor, dense_rows=self.p.dense_rows)
        return timeline.match_from_logs(self._stays_for_pivots(), self.t["chartevents"], self.t["labevents"], anchor,
                                        version=self.p.chart_version, dense_rows=self.p.dense_rows, **self._lab_options())

    def _build_matchvalue(self):
        return self._match("pao2")

    def _build_matchvalue_lab(self):
        return self._match("pao2_l")


VERSIONS, COMMITS = "versions", "commits"
COMMIT = "number long, version string, views array<string>"


def _commits(spark: SparkSession, sink: str) -> list:
    """The commits of a sink, oldest first: one small row each, as many as :func:`rebuild` keeps plus those it removed."""
    if not list_folder(spark, f"{sink}/{COMMITS}"):
        return []
    return spark.read.schema(COMMIT).parquet(f"{sink}/{COMMITS}").orderBy("number").collect()


def snapshot_paths(spark: SparkSession, sink: str) -> dict[str, str]:
    """``{view: path}`` of the last committed rebuild below ``sink``; empty before the first."""
    sink = sink.rstrip("/")
    done = _commits(spark, sink)
    return {name: f"{sink}/{VERSIONS}/{done[-1].version}/{name}" for name in done[-1].views} if done else {}


def read_snapshot(spark: SparkSession, sink: str) -> dict[str, DataFrame]:
    """``{view: DataFrame}`` of the last committed rebuild; all views are of one version."""
    return {name: spark.read.parquet(path) for name, path in snapshot_paths(spark, sink).items()}


def publish(spark: SparkSession, sink: str, database: str) -> None:
    """Point the catalog tables ``database.view`` at the last committed rebuild.

    Repeatable: after a failure between two tables, another call completes it.
    """
    for name, path in snapshot_paths(spark, sink).items():
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=path, source="parquet")


def rebuild(spark: SparkSession, study: Study, sink: str, views=ORDER, database: str | None = None, keep: int = 2) -> dict[str, str]:
    """Write ``views`` as Parquet under ``sink`` in DAG order, as one new version.

    Every run writes to ``sink/versions/<its own>``; when all views are there, a
    row appended to ``sink/commits`` makes it the current snapshot
    (:func:`read_snapshot`).  A run that fails or is killed before leaves the
    old snapshot as it was, for readers and catalog alike.  ``database``
    registers or moves the catalog tables after the commit (:func:`publish`).

    Each written view replaces its plan in ``study``, so later views read the
    stored files; the laboratory log is read once for all of its views.
    Intermediate tables are deleted at the end, and so are versions other than
    the last ``keep`` committed ones, left-overs of killed runs among them: one
    rebuild at a time per sink, and readers of older snapshots must be done.

    ``sink`` must be a shared path on a cluster.  Returns ``{view: path}``.
    """
    sink = sink.rstrip("/")
    version = uuid.uuid4().hex
    root = f"{sink}/{VERSIONS}/{version}"
    study.forget(*views)
    labs_before, study.share_labs = study.share_labs, True
    try:
        with checkpoints_below(spark, f"{sink}/_intermediate"), scratch(spark):
            for name in views:
                study[name].write.parquet(f"{root}/{name}")
                study.put(name, spark.read.parquet(f"{root}/{name}"))
        done = _commits(spark, sink)
        row = [(done[-1].number + 1 if done else 0, version, list(views))]
        spark.createDataFrame(row, COMMIT).coalesce(1).write.mode("append").parquet(f"{sink}/{COMMITS}")
    except BaseException:
        study.forget(*views)
        with contextlib.suppress(Exception):
            delete_folder(spark, root)
        raise
    finally:
        study.share_labs = labs_before
        study.forget()  # what isn't stored may read an intermediate table that is gone
    if database:
        publish(spark, sink, database)
    kept = {c.version for c in _commits(spark, sink)[-max(keep, 1):]}
    for old in list_folder(spark, f"{sink}/{VERSIONS}"):
        if old not in kept:
            delete_folder(spark, f"{sink}/{VERSIONS}/{old}")
    return {name: f"{root}/{name}" for name in views}
