"""Measure how the match window spreads a hot stay over tasks.

Builds ``patientsvalue`` from one driver folder, reassigns a third of its
rows to a single stay (time order kept), stores it, and then runs the
17-feature match in two forms:

* ``per_stay``: the windows partitioned by the stay alone (a plain
  window, what a direct translation would do);
* ``bucketed``: :func:`clinframe.operators.match_values` (stay, day bucket);

and ``rank()`` per stay by time, as a plain window vs :func:`bucketed_rank`.

For each, Spark's event log (written to a scratch folder; no UI) gives the
shuffle records read by every task of the window stage.  Prints one JSON
line with the largest task's share of the rows.

    python tools/skew_report.py /root/testdata/sf0.1
"""

from __future__ import annotations

import glob
import json
import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clinframe import get_spark, operators as op  # noqa: E402
from clinframe.functions.rules import MATCH_FEATURES  # noqa: E402
from clinframe.plans import Study  # noqa: E402
from clinframe.session import checkpoint_dir  # noqa: E402
from clinframe.sources import clinical_tables  # noqa: E402

HOT = -1


def per_stay(values):
    """Plain range-frame windows partitioned by the stay only."""
    v = values.filter(F.col("charttime").isNotNull()).withColumn(
        "_us", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', charttime)"))
    w = Window.partitionBy("icustay_id").orderBy("_us")
    cols = [F.last(n, ignorenulls=True).over(w.rangeBetween(-h * 3_600_000_000, 0)).alias(n)
            for n, h in MATCH_FEATURES.items()]
    return v.select("subject_id", "hadm_id", "icustay_id", "charttime", "pao2", *cols).filter("pao2 is not null")


def task_records(log_dir: str):
    """{stage id: [shuffle records read per task]} from the event log."""
    stages: dict[int, list[int]] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerTaskEnd":
                    continue
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if n:
                    stages.setdefault(ev["Stage ID"], []).append(n)
    return stages


def main(sf_dir: str) -> None:
    results = {}
    spark = get_spark("local[8]", shuffle_partitions=64)
    # Scratch under the session's checkpoint folder (a shared path on a cluster).
    scratch = f"{checkpoint_dir(spark)}/skew-{uuid.uuid4().hex}"
    values_path = f"{scratch}/patientsvalue"
    t = clinical_tables(spark, sf_dir)
    pv = Study(t, stays=t["icustays"])["patientsvalue"]
    hot = F.when(F.abs(F.hash("icustay_id")) % 3 == 0, F.lit(HOT)).otherwise(F.col("icustay_id"))
    pv.withColumn("icustay_id", hot).write.parquet(values_path)
    total = spark.read.parquet(values_path).count()
    hot_rows = spark.read.parquet(values_path).filter(F.col("icustay_id") == HOT).count()
    spark.stop()

    def rank_plain(values):
        return values.filter("charttime is not null").withColumn(
            "rk", F.rank().over(Window.partitionBy("icustay_id").orderBy("charttime")))

    def rank_bucketed(values):
        return op.bucketed_rank(values.filter("charttime is not null"), ["icustay_id"], "charttime", name="rk")

    for name, build in (("per_stay", per_stay), ("bucketed", op.match_values),
                        ("rank_per_stay", rank_plain), ("rank_bucketed", rank_bucketed)):
        log_dir = f"{scratch}/events-{name}"
        os.makedirs(log_dir)
        spark = get_spark("local[8]", shuffle_partitions=64, **{
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"})
        build(spark.read.parquet(values_path)).write.format("noop").mode("overwrite").save()
        spark.stop()
        stages = task_records(log_dir)
        window_stage = max(stages, key=lambda s: sum(stages[s]))
        recs = stages[window_stage]
        results[name] = {"tasks": len(recs), "rows_shuffled": sum(recs), "largest_task_rows": max(recs),
                         "largest_task_share": round(max(recs) / sum(recs), 4)}
    print(json.dumps({"rows": total, "hot_stay_rows": hot_rows,
                      "hot_stay_share": round(hot_rows / total, 4), **results}))


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
