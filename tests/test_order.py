"""Queries that promise an order give their rows in it."""

import calendar

import pytest

from starloom.plans import QUERIES, load_all
from tests.conftest import SMALL

load_all()
MONTHS = {name: i for i, name in enumerate(calendar.month_name)}
#: Of each query: the sort key of a row. Keys are unique within each result.
KEYS = {
    "sort_multi_key": lambda r: (r.c_nationkey, -r.c_acctbal, r.c_custkey),
    "top_n": lambda r: (-r.o_totalprice, r.o_orderkey),
    "q2_weighted_monthly_avg": lambda r: (r.year, MONTHS[r.month_name], r.o_orderstatus),
    "q3_pivot": lambda r: MONTHS[r.month_name],
    "q4_conditional_shares": lambda r: (r.p_brand, r.l_linestatus),
    "q5_rank_window": lambda r: (r.year, r.quarter, r.s_nationkey, r.l_returnflag),
    "q7_grouping_sets": lambda r: (r.region_name, r.nation_name is not None, r.nation_name or ""),
}


@pytest.mark.parametrize("name", sorted(KEYS))
def test_rows_come_in_order(spark, name):
    got = [KEYS[name](r) for r in QUERIES[name](spark, SMALL).collect()]
    assert len(got) > 1 and len(set(got)) == len(got)
    assert got == sorted(got)
