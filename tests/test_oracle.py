"""Every registered query equals its DuckDB oracle on the smallest test data."""

import pytest

import __spark_entry__ as E
from hourgrid import oracle as O
from hourgrid import queries as Q
from helpers import canon, rows_of

from conftest import SF_SMALL

NAMES = sorted(Q.queries())


def test_every_query_has_an_oracle():
    assert set(O.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(E.queries()) and set(NAMES) <= set(E.oracle_sql())


ORDERED = {"hourly_summary": ["subject_id", "hadm_id", "icustay_id"], "one_pass_summary": ["subject_id", "hadm_id", "icustay_id"],
           "vitals_with_stay": ["subject_id", "hadm_id", "icustay_id", "hr"],
           "vitals_with_inout": ["icustay_id", "hr"],
           "vitals_with_admission_labs_top100": ["subject_id", "hadm_id", "icustay_id", "hour", "rn"]}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_output_order(spark, duck, name):
    cols = ORDERED[name]
    got = [tuple(r) for r in Q.queries()[name](spark, SF_SMALL).select(*cols).collect()]
    assert got == sorted(got)
    rel = duck.sql(O.oracle_sql()[name])
    at = [rel.columns.index(c) for c in cols]
    assert got == [tuple(r[i] for i in at) for r in rel.fetchall()]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    idx = [rel.columns.index(c) for c in cols]
    want = canon([tuple(r[i] for i in idx) for r in rel.fetchall()])
    got = rows_of(df, cols)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
    assert len(df.columns) == 63
