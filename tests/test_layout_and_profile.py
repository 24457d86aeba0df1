"""Bucketed tables, profiles gathered while writing, lenient dates, and the order of sorted results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import to_nullable_date
from starloom.operators import quality
from starloom.plans import QUERIES, load_all
from starloom.sources.files import bucket_count
from tests.conftest import SMALL

load_all()


def test_bucketed_facts_join_and_group_without_a_shuffle(spark):
    plan = QUERIES["bucketed_star_join"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_buckets_grow_with_the_rows(spark):
    few, many = (QUERIES["bucketed_star_join"](spark, SMALL, **more) for more in ({}, {"bucket_rows": 300}))
    assert few.rdd.getNumPartitions() == 8 and many.rdd.getNumPartitions() >= 20
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    rows = spark.range(1000)
    assert (bucket_count(rows, rows.limit(3), rows=300), bucket_count(rows), bucket_count(rows.limit(0), least=2)) == (8, 8, 2)
    assert bucket_count(rows.limit(3), rows, rows=99, least=2) == 11


def test_profile_comes_from_the_one_pass_that_writes(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        reads.add(1)
        return x

    df = spark.range(40).select(counted("id").alias("id"), F.when(F.col("id") % 4 == 0, F.lit("x")).alias("a.b"), F.create_map(F.lit("k"), "id").alias("m"))
    got = quality.write_observed(df, f"{tmp_path}/t")
    assert got == {"id": (40, 0, "0", "39"), "a.b": (40, 30, "x", "x"), "m": (40, 0, None, None)}
    assert reads.value == 40 and spark.read.parquet(f"{tmp_path}/t").count() == 40
    assert quality.write_observed(df.limit(0), f"{tmp_path}/empty")["id"] == (0, 0, None, None)


@pytest.mark.parametrize("text, want", [
    ("2024-03-05", dt.date(2024, 3, 5)), ("2024-3-5", dt.date(2024, 3, 5)), ("2024-03-05T23:59:59Z", dt.date(2024, 3, 5)), (" 2024-03-05 10:00 ", dt.date(2024, 3, 5)),
    ("20240305", dt.date(2024, 3, 5)), ("3/5/2024", dt.date(2024, 3, 5)), ("03-05-2024", dt.date(2024, 3, 5)), ("5-Mar-2024", dt.date(2024, 3, 5)),
    ("Mar 5, 2024", dt.date(2024, 3, 5)), ("March 5, 2024", dt.date(2024, 3, 5)), ("5 March 2024", dt.date(2024, 3, 5)), ("2024/03/05", dt.date(2024, 3, 5)),
    ("13/13/2024", None), ("2024-02-30", None), ("", None), (None, None), ("soon", None), ("2024-03-05x", None)])
def test_lenient_dates(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(to_nullable_date("t").alias("d")).first().d == want


def test_dates_and_timestamps_stay(spark):
    row = spark.sql("SELECT DATE '2024-03-05' AS d, TIMESTAMP '2024-03-05 10:00:00' AS t").select(to_nullable_date("d").alias("d"), to_nullable_date("t").alias("t")).first()
    assert row.d == row.t == dt.date(2024, 3, 5)


def test_multi_key_sort_is_in_order(spark):
    rows = QUERIES["sort_multi_key"](spark, SMALL)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    order = plan[plan.index("Sort ["):].split("]")[0]
    got = rows.collect()
    assert len(got) > 1 and order.count("#") >= 2
    names = [x.split("#")[0].strip() for x in order[len("Sort ["):].split(",")]
    descending = ["DESC" in x for x in order[len("Sort ["):].split(",")]
    for a, b in zip(got, got[1:]):
        for n, down in zip(names, descending):
            if a[n] != b[n]:
                assert (a[n] > b[n]) == down
                break
