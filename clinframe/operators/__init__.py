"""DataFrame operators: cleaning, pivots, merge, as-of attach, features, cohort, reports."""

from clinframe.operators.asof import (  # noqa: F401
    asof_attach, asof_candidates, carry_forward, dense_cuts, match_values, match_values_chain, with_piece,
)
from clinframe.operators.clean import normalize_fio2, stage_signal, stage_spo2  # noqa: F401
from clinframe.operators.cohort import (  # noqa: F401
    cohort_base, cohort_with_pf, count_events_in_stay, eligible, select_patients,
    left_theta, select_patients_surgical, service_at_entry, service_rank1,
)
from clinframe.operators.features import pf_exclusion, pf_ratio, specimen_probability  # noqa: F401
from clinframe.operators.merge import merge_sources  # noqa: F401
from clinframe.operators.pivot import (  # noqa: F401
    chart_pivot, gcs_first_day, lab_first_day, lab_in_stay, lab_pivot, lab_seven_day, stage_bloodgas, stage_chart,
    stage_events, stage_labs, window_pivot,
)
from clinframe.operators.labs import PANELS, LabPanel, lab_panels, of_stays, panel_events, stored_panels  # noqa: F401
from clinframe.operators.rank import bucketed_rank, latest_per_group  # noqa: F401
from clinframe.operators.report import (  # noqa: F401
    category_counts, crosstab, distinct_values, exclusion_report, missing_patterns,
    missing_per_column, missing_profile,
)
from clinframe.operators.timeline import match_from_logs, signal_events  # noqa: F401
