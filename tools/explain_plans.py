"""Physical plans of the main operators over *stored* clinical tables.

Writes the analog clinical tables of one driver folder as Parquet into a
scratch folder, re-reads them (as a deployment would read its tables) and
prints the AQE-final physical plan tree of each operator after running it.

    python tools/explain_plans.py /root/testdata/sf0.1 > docs/plan_trees.txt
"""

from __future__ import annotations

import os
import re
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clinframe import get_spark, operators as op  # noqa: E402
from clinframe.session import checkpoint_dir  # noqa: E402
from clinframe.plans import Study  # noqa: E402
from clinframe.sources import clinical_tables, read_parquet_tables  # noqa: E402


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()          # final AQE plan
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        lines.append(line[:150])
    return "\n".join(lines)


def main(sf_dir: str) -> None:
    spark = get_spark("local[8]", shuffle_partitions=16, **{"spark.driver.memory": "8g"})
    # Scratch tables go under the session's (shared) checkpoint folder.
    root = f"{checkpoint_dir(spark)}/plans-{uuid.uuid4().hex}"
    for name, df in clinical_tables(spark, sf_dir).items():
        df.write.parquet(f"{root}/{name}")
    t = read_parquet_tables(spark, root)
    st = Study(t, stays=t["icustays"])
    cases = {
        "chart_pivot(v1.2)": st["patientschart"],
        "lab_first_day": op.lab_first_day(t["icustays"], t["labevents"]),
        "merge_sources": st["patientsvalue"],
        "match_values (over stored patientsvalue)": None,
        "pf_ratio (asof_attach)": st["pf_rows"],
        "specimen_probability (asof_attach + asof_candidates)": op.specimen_probability(
            op.lab_first_day(t["icustays"], t["labevents"]), op.stage_spo2(t["chartevents"]),
            op.normalize_fio2(t["chartevents"])),
        "cohort_base (bucketed_rank)": st["cohort_base"],
        "service_at_entry": op.service_at_entry(t["icustays"], t["services"]),
        "exclusion_report": op.exclusion_report(st["cohort_with_pf"]),
    }
    st["patientsvalue"].write.parquet(f"{root}/patientsvalue")
    cases["match_values (over stored patientsvalue)"] = op.match_values(spark.read.parquet(f"{root}/patientsvalue"))
    for title, df in cases.items():
        print(f"===== {title}\n{tree(df)}\n")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1")
