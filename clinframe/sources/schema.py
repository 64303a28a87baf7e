"""Clinical source schemas (columns the operators read)."""

from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS = {
    "icustays": _s(("subject_id", L), ("hadm_id", L), ("icustay_id", L), ("intime", TS), ("outtime", TS)),
    "patients": _s(("subject_id", L), ("dob", TS)),
    "ventfirstday": _s(("icustay_id", L), ("vent", I)),
    "heightweight": _s(("icustay_id", L), ("height_first", D), ("weight_first", D)),
    "icustay_detail": _s(("icustay_id", L), ("gender", S), ("ethnicity", S)),
    "noteevents": _s(("subject_id", L), ("hadm_id", L), ("charttime", TS), ("category", S), ("description", S)),
    "chartevents": _s(("subject_id", L), ("hadm_id", L), ("icustay_id", L), ("itemid", I), ("charttime", TS),
                      ("value", S), ("valuenum", D), ("valueuom", S), ("error", I)),
    "labevents": _s(("subject_id", L), ("hadm_id", L), ("itemid", I), ("charttime", TS), ("value", S),
                    ("valuenum", D)),
    "services": _s(("subject_id", L), ("hadm_id", L), ("transfertime", TS), ("prev_service", S),
                   ("curr_service", S)),
    "admissions": _s(("hadm_id", L), ("admission_location", S), ("admission_type", S)),
}

TABLES = tuple(SCHEMAS)
