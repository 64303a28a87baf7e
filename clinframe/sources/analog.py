"""Clinical-schema tables derived from the driver's generic tables.

The test data ships no clinical tables, so each one is derived row by row from
``events`` / ``customer`` / ``orders`` (their work therefore grows with the
input).  The same definitions are written independently in DuckDB SQL in
``oracle_sql.py``; keep the two in step.

Mapping (``k`` is the integer in ``events.props`` JSON ``{"k": n}``):

* admission ``hadm_id`` = ``user_id * 100 + week``, week = whole weeks since
  2024-01-01 of the event time;
* ``icustays``: signup events; stay id = event id, ``intime`` = ts,
  ``outtime`` = ts + k hours;
* every other event belongs to the latest stay of its admission that began
  at or before it (NULL before the first stay of the week);
* ``chartevents`` / ``labevents``: click, view and error events, each one a
  panel of several items picked from a fixed list by ``event_id`` and fixed
  offsets, with value / (position + 1); error-type values are divided by 100
  first so fraction-scaled items see fractions;
* ``noteevents``: view events; ``services``: purchase events;
* ``patients``: customers, birth = first order date; ``admissions``: orders.

The ``%`` terms only *derive attributes* (which item an event measures,
whether a stay has a vent or height row, the error flag); no input row is
dropped to make anything cheaper -- every event becomes a stay, a chart and
lab panel, a note or a service transfer, so the work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinframe.functions import rules
from clinframe.operators.asof import carry_forward
from clinframe.session import list_folder, store

# --------------------------------------------------------------------------
# FIXED VALUES of the analog mapping (mirrored in oracle_sql.py).
# --------------------------------------------------------------------------
WEEK_ORIGIN = "2024-01-01"
CHART_ITEMS = tuple(sorted(set(rules.chart_items("v1.2")) | set(rules.GCS_FUSION) | {198}))
LAB_ITEMS = rules.BLOODGAS_ITEMS
SERVICES = ("MED", "CSURG", "ORTHO", "NSURG", "CMED", "TRAUM", "SURG", "VSURG", "OMED", "ORTHD")
SPECIMEN_TEXT = ("ART", "VEN", "MIX")
# Each measured event is a panel: item j of the panel is picked at
# (event_id + offset_j) in the item list and its value is the event value / (j + 1).
CHART_PANEL_OFFSETS = (0, 7, 19, 31)
LAB_PANEL_OFFSETS = (0, 5, 13)
NOTE_PATTERN = "%6%"          # stands in for the chest-imaging description pattern
RADIOLOGY_BELOW = 50.0        # note category: value below this is 'Radiology'
# --------------------------------------------------------------------------

DRIVER_TABLES = ("events", "customer", "orders")


def read_driver_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def _events(events: DataFrame) -> DataFrame:
    week = F.floor(F.datediff(F.to_date("ts"), F.lit(WEEK_ORIGIN).cast("date")) / F.lit(7.0))
    return events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "props",
        (F.col("user_id") * 100 + week.cast("long")).alias("hadm_id"),
    )


def _pick(values, idx) -> object:
    """``values[idx]`` for a fixed literal list (0-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def clinical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All clinical tables for one driver scale-factor folder."""
    t = read_driver_tables(spark, sf_dir)
    ev = _events(t["events"])
    signup = ev.filter(F.col("event_type") == "signup")

    icustays = signup.select(
        F.col("user_id").alias("subject_id"), "hadm_id", F.col("event_id").alias("icustay_id"),
        F.col("ts").alias("intime"), F.expr("timestampadd(HOUR, k, ts)").alias("outtime"),
    )

    # Stay assignment: the latest signup at or before each event within its
    # admission (user-week), split by day so a hot admission is not one task.
    assigned = carry_forward(ev, by=["hadm_id"], time="ts", name="icustay_id",
                             value=F.when(F.col("event_type") == "signup", F.col("event_id"))) \
        .filter(F.col("event_type") != "signup")

    # Labs, notes and services carry no stay id: they come straight from the events.
    measured_types = F.col("event_type").isin("click", "view", "error")
    valuenum = F.when(F.col("event_type") == "error", F.col("value") / F.lit(100.0)).otherwise(F.col("value"))

    def panel(rows, offsets):
        return rows.filter(measured_types).select("*", F.posexplode(F.array(*[F.lit(o) for o in offsets])).alias("_j", "_off"))

    chart = panel(assigned, CHART_PANEL_OFFSETS)
    chartevents = chart.select(
        F.col("user_id").alias("subject_id"), "hadm_id", "icustay_id",
        _pick(CHART_ITEMS, (F.col("event_id") + F.col("_off")) % len(CHART_ITEMS)).cast("int").alias("itemid"),
        F.col("ts").alias("charttime"),
        F.when(F.col("k") % 7 == 0, F.lit(rules.GCS_INTUBATED_TEXT[723]))
         .when(F.col("k") % 7 == 1, F.lit(rules.GCS_INTUBATED_TEXT[223900]))
         .otherwise(F.col("props")).alias("value"),
        (valuenum / (F.col("_j") + F.lit(1.0))).alias("valuenum"),
        F.col("event_type").alias("valueuom"),
        F.when(F.col("k") % 10 == 0, F.lit(1)).when(F.col("k") % 10 == 1, F.lit(None))
         .otherwise(F.lit(0)).cast("int").alias("error"),
    )

    labevents = panel(ev, LAB_PANEL_OFFSETS).select(
        F.col("user_id").alias("subject_id"), "hadm_id",
        _pick(LAB_ITEMS, (F.col("event_id") + F.col("_off")) % len(LAB_ITEMS)).cast("int").alias("itemid"),
        F.col("ts").alias("charttime"),
        _pick(SPECIMEN_TEXT, F.col("k") % len(SPECIMEN_TEXT)).alias("value"),
        (valuenum / (F.col("_j") + F.lit(1.0))).alias("valuenum"),
    )

    noteevents = ev.filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("subject_id"), "hadm_id", F.col("ts").alias("charttime"),
        F.when(F.col("value") < F.lit(RADIOLOGY_BELOW), F.lit("Radiology")).otherwise(F.lit("Nursing"))
         .alias("category"),
        F.col("props").alias("description"),
    )

    services = ev.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("subject_id"), "hadm_id", F.col("ts").alias("transfertime"),
        F.lit(None).cast("string").alias("prev_service"),
        _pick(SERVICES, F.col("event_id") % len(SERVICES)).alias("curr_service"),
    )

    first_order = t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("dob"))
    patients = t["customer"].join(first_order, t["customer"].c_custkey == first_order.o_custkey).select(
        F.col("c_custkey").alias("subject_id"), "dob")

    customer = t["customer"].select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("c_mktsegment").alias("ethnicity"))
    icustay_detail = icustays.join(customer, "subject_id").select("icustay_id", "gender", "ethnicity")

    heightweight = signup.filter(F.col("k") % 4 != 0).select(
        F.col("event_id").alias("icustay_id"),
        (F.lit(140.0) + F.col("k")).alias("height_first"), F.col("value").alias("weight_first"))

    ventfirstday = signup.filter(F.col("k") % 3 != 2).select(
        F.col("event_id").alias("icustay_id"),
        F.when(F.col("k") % 3 == 1, F.lit(1)).otherwise(F.lit(0)).alias("vent"))

    admissions = t["orders"].select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderpriority").alias("admission_location"),
        F.col("o_orderstatus").alias("admission_type"))

    return {
        "icustays": icustays, "patients": patients, "ventfirstday": ventfirstday,
        "heightweight": heightweight, "icustay_detail": icustay_detail, "noteevents": noteevents,
        "chartevents": chartevents, "labevents": labevents, "services": services,
        "admissions": admissions,
    }


#: (application, folder, table) -> path of the stored table.
_stored: dict[tuple[str, str, str], str] = {}
_tables: dict[tuple[str, str], StoredTables] = {}


class StoredTables(Mapping):
    """The clinical tables of a folder, each derived and written once per application, when first asked for.

    They stand for tables that the study finds stored; queries over them then
    measure the study's work and not the mapping's.  A table that was deleted
    meanwhile is written again.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir, self._tables = spark, sf_dir, clinical_tables(spark, sf_dir)

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        key = (self.spark.sparkContext.applicationId, self._dir, name)
        path = _stored.get(key)
        if path and "_SUCCESS" in list_folder(self.spark, path):
            return self.spark.read.schema(df.schema).parquet(path)
        out = store(df, f"table-{name}", lasting=True)
        _stored[key] = out.stored_path
        return out


def stored_clinical_tables(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """:func:`clinical_tables`, stored; derived anew by each query where ``spark.checkpoint.dir`` is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        return clinical_tables(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _tables or _tables[key].spark is not spark:
        _tables[key] = StoredTables(spark, sf_dir)
    return _tables[key]
