"""Command line: rebuild the study's views from stored clinical tables.

    python -m clinframe rebuild SOURCE SINK [--chart-version v1.2] [--database DB]
        [--min-age 16] [--min-los 1] [--views select_patient,pf,...]
        [--missing-notes-as-zero] [--fio2-range 21 100] [--keep-negative-base-excess]

SOURCE holds one Parquet folder per clinical table (icustays, patients, ...);
SINK (a shared path on a cluster) receives one Parquet folder per view,
written in DAG order.  Run it with spark-submit to use a cluster.
"""

from __future__ import annotations

import argparse
import json
import sys

from clinframe.plans import ORDER, Study, StudyParams, rebuild
from clinframe.session import get_spark
from clinframe.sources import read_parquet_tables


def main(argv: list[str] | None = None) -> dict[str, str]:
    ap = argparse.ArgumentParser(prog="python -m clinframe")
    sub = ap.add_subparsers(dest="command", required=True)
    rb = sub.add_parser("rebuild", help="write the study's views in DAG order")
    rb.add_argument("source")
    rb.add_argument("sink")
    rb.add_argument("--chart-version", default="v1.2", choices=["base", "v1.1", "v1.2"])
    rb.add_argument("--database", default=None, help="also register external catalog tables here")
    rb.add_argument("--min-age", type=float, default=16.0)
    rb.add_argument("--min-los", type=float, default=1.0)
    rb.add_argument("--missing-notes-as-zero", action="store_true", help="flag stays without qualifying notes")
    rb.add_argument("--fio2-range", type=float, nargs=2, default=None, metavar=("LO", "HI"), help="keep lab FiO2 inside this range only")
    rb.add_argument("--keep-negative-base-excess", action="store_true")
    rb.add_argument("--views", default=",".join(ORDER), help="comma-separated subset, in DAG order")
    args = ap.parse_args(argv)

    spark = get_spark(app="clinframe-rebuild")
    tables = read_parquet_tables(spark, args.source, conform_schema=True)
    study = Study(tables, StudyParams(chart_version=args.chart_version, min_age_years=args.min_age,
                                      min_los_days=args.min_los, treat_missing_as_zero=args.missing_notes_as_zero,
                                      fio2_range=tuple(args.fio2_range) if args.fio2_range else None,
                                      keep_negative_base_excess=args.keep_negative_base_excess))
    views = [v for v in ORDER if v in set(args.views.split(","))]
    paths = rebuild(spark, study, args.sink, views=views, database=args.database)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main(sys.argv[1:])
