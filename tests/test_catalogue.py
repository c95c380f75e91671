"""Queries against SQL on the smallest tables, as far as they are at hand."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (int, str)) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ["q_domain_rollup", "q_aggregate", "q_length_rollup", "q_audit_counts", "q_coverage_grid", "q_balanced_sample", "q_overlap_counts", "q_leaderboard_pivot", "q_rejection_reason", "q_gold_attach", "q_trajectory_grade", "q_adapt_mcqa", "q_adapt_multiif", "q_adapt_apps"])
def test_same_as_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(([norm(r[k]) for k in cols] for r in df.collect()), key=str)
    res = c.execute(entry.oracle_sql()[name])
    names = [x[0] for x in res.description]
    want = sorted(([norm(r[names.index(k)]) for k in cols] for r in res.fetchall()), key=str)
    assert got == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_reliability_same_as_sql(spark):
    test_same_as_sql(spark, "q_reliability")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
