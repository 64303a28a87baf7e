"""Tiny hand-written clinical tables (one row per ledger case)."""

from datetime import datetime, timedelta

from clinframe.sources.schema import SCHEMAS

T0 = datetime(2024, 1, 1, 8, 0, 0)


def ts(hours=0.0, micros=0):
    return T0 + timedelta(hours=hours, microseconds=micros)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, SCHEMAS[table])


def chart_row(stay, item, v, hours=1.0, value=None, error=0, subject=1, hadm=10):
    return (subject, hadm, stay, item, ts(hours), value, v, None, error)
