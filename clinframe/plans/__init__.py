"""The study's view DAG (lazy DataFrames) and its materialising rebuild."""

from clinframe.plans.study import (  # noqa: F401
    ORDER, Study, StudyParams, publish, read_snapshot, rebuild, snapshot_paths,
)
