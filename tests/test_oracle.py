"""Every registered query equals its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SMOKE_DIR
from oracle_compare import compare, duck

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


def test_every_query_of_the_study_has_an_oracle():
    assert set(E.QUERIES) <= set(ORACLE) and set(ORACLE) <= set(E.queries())


def test_preview_is_ten_stays(spark):
    assert E.queries()["preview"](spark, SMOKE_DIR).first().n == 10


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(E.queries()[name](spark, SMOKE_DIR), con, ORACLE[name])
    assert not problems, problems


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["subject_id", "hadm_id", "icustay_id", "charttime", "pao2"]
    assert df.count() >= 0
