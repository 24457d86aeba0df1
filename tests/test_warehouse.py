"""Stored facts read by year, order of reports, and views refreshed from new files."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starloom.functions import flag
from starloom.operators.matview import ManifestView, MaterializedAggregate
from starloom.plans import QUERIES, load_all, warehouse
from starloom.plans.warehouse import Warehouse, in_year
from starloom.sources.files import append_table, data_files
from tests.conftest import SMALL

load_all()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q2_weighted_monthly_avg", "q3_pivot", "q5_rank_window", "q7_grouping_sets"])
def test_reports_read_one_year_of_a_stored_fact(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 1997|dynamicpruning", plan), plan
    assert "orders.parquet" not in plan and "lineitem.parquet" not in plan


def test_a_filter_known_only_at_run_time_prunes_too(spark):
    w = Warehouse(spark, SMALL)
    # the years that have a first of April on a Tuesday
    known = w.dates("orders", "o_orderdate").filter("day_name = 'Tuesday' AND month = 4").select("date_key", F.col("year").alias("d_year"))
    fact = w.fact("monthly")
    joined = fact.join(F.broadcast(known), (fact["month_key"] == known["date_key"]) & (fact["year"] == known["d_year"]))
    assert "dynamicpruning" in plan_of(joined)


@pytest.mark.parametrize("build, tables", [(warehouse.monthly_fact, ["orders", "customer"]), (warehouse.quarter_fact, ["lineitem", "supplier"]),
                                           (warehouse.yearly_fact, ["orders", "customer"]), (warehouse.observation_fact, ["lineitem", "supplier", "part"])])
def test_each_fact_scans_each_table_once(spark, build, tables):
    w = Warehouse(spark, SMALL)
    plan = plan_of(build(w))
    for t in tables:
        assert len(re.findall(rf"FileScan parquet.*{t}\.parquet", plan)) == 1


def test_facts_are_built_once_and_anew_for_other_inputs(spark, tmp_path):
    rows = [(i, i % 3, "F", 1000.0 * i, dt.datetime(1996 + i % 2, 1 + i % 2, 1), "1-URGENT") for i in range(20)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(i, i) for i in range(3)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    w = Warehouse(spark, str(tmp_path))
    first = sorted(map(tuple, w.fact("monthly").collect()))
    files = data_files(spark, w.folder("monthly", "orders", "customer"))
    assert sorted(map(tuple, w.fact("monthly").collect())) == first
    assert data_files(spark, w.folder("monthly", "orders", "customer")) == files
    assert {r.year for r in in_year(w.fact("monthly"), w.dates("orders", "o_orderdate").select("date_key", "year"), "month_key", 1997).collect()} == {1997}
    append_table(spark.createDataFrame([(99, 1, "P", 5.0, dt.datetime(1998, 3, 1), "x")], names), f"{tmp_path}/orders.parquet")
    assert w.fact("monthly").filter("year = 1998").count() == 1


def rows_of(name, spark):
    return [r.asDict() for r in QUERIES[name](spark, SMALL).collect()]


def test_reports_come_in_their_order(spark):
    q2 = rows_of("q2_weighted_monthly_avg", spark)
    months = [dt.datetime.strptime(r["month_name"], "%B").month for r in q2]
    assert [(m, r["o_orderstatus"]) for m, r in zip(months, q2)] == sorted((m, r["o_orderstatus"]) for m, r in zip(months, q2))
    q3 = [dt.datetime.strptime(r["month_name"], "%B").month for r in rows_of("q3_pivot", spark)]
    assert q3 == sorted(q3) and len(q3) > 1
    q7 = [(r["region_name"], r["nation_name"] is not None, r["nation_name"] or "") for r in rows_of("q7_grouping_sets", spark)]
    assert q7 == sorted(q7)
    q5 = [(r["year"], r["quarter"], r["s_nationkey"], r["l_returnflag"]) for r in rows_of("q5_rank_window", spark)]
    assert q5 == sorted(q5)


def counted(rows):
    return sorted((r.kind, r.n, r.high) for r in rows)


def test_view_takes_each_file_once(spark, tmp_path):
    source, aggregate = f"{tmp_path}/source", MaterializedAggregate(["kind"], {"high": flag(F.col("v") > 5)}, "n")
    view = ManifestView(spark, f"{tmp_path}/view", aggregate, source, lambda df: df.filter("v >= 0"))
    with pytest.raises(FileNotFoundError):
        view.refresh()
    part = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("k"), (F.col("id") % 2).cast("string")).alias("kind"), (F.col("id") - 1).alias("v")).coalesce(1)
    append_table(part(0, 10), source)
    assert view.refresh() == 1 and view.refresh() == 0
    opened = view.read()
    append_table(part(10, 14), source)
    assert view.refresh() == 1
    assert counted(opened.collect()) == [("k0", 4, 1), ("k1", 5, 2)]
    assert counted(view.read().collect()) == [("k0", 6, 3), ("k1", 7, 4)]
    assert view.refresh() == 0
    part(0, 3).write.mode("overwrite").parquet(source)  # what was added is gone: the view starts anew
    assert view.refresh() == 1
    assert counted(view.read().collect()) == [("k0", 1, 0), ("k1", 1, 0)]
