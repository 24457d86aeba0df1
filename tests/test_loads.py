"""Dense ids at size, incremental loads, splits of transport files, storage checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import period_start_join, validity_join
from starloom.operators.keys import dense_ids, next_start
from starloom.operators.scd import scd2_merge, scd2_versions
from starloom.operators.upsert import combo_upsert
from starloom.sources.files import append_table, overwrite_table, path_exists
from starloom.session import scratch_path


def test_dense_ids_with_payload_are_gapless_at_two_million_rows(spark):
    df = spark.range(2_000_000).select(((F.col("id") * 48271) % 2147483647).alias("k"), F.xxhash64("id").alias("payload"))
    got = dense_ids(df, ["k"], "n").agg(F.min("n"), F.max("n"), F.countDistinct("n"), F.count("*")).first()
    assert tuple(got) == (1, 2_000_000, 2_000_000, 2_000_000)
    stored = spark.range(1, 11).withColumnRenamed("id", "n")
    some = dense_ids(df.limit(1000), ["k"], "n", start=next_start(stored, "n")).agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(some) == (11, 1010, 1000)


D = dt.date


def test_null_and_empty_are_one_state(spark):
    s = spark.createDataFrame([(1, D(2024, 1, 1), None), (1, D(2024, 1, 2), ""), (1, D(2024, 1, 3), None), (1, D(2024, 1, 4), "x")], "k int, d date, a string")
    assert scd2_versions(s, "k", "d", ["a"]).count() == 2


def test_replay_is_no_op_and_null_keys_stay_out(spark):
    first = spark.createDataFrame([(1, D(2024, 1, 1), "a")], "k int, d date, a string")
    batch = spark.createDataFrame([(1, D(2024, 1, 5), "b"), (None, D(2024, 1, 5), "z"), (2, D(2024, 1, 6), "c")], "k int, d date, a string")
    dim = scd2_versions(first, "k", "d", ["a"])
    for _ in range(3):  # each load writes the dimension, the next one reads it
        path = scratch_path(spark, "dim")
        overwrite_table(scd2_merge(dim, batch, "k", "d", ["a"]), path)
        dim = spark.read.parquet(path)
    assert sorted((r.k, r.a, r.version_no, r.is_current) for r in dim.collect()) == [(1, "a", 1, False), (1, "b", 2, True), (2, "c", 1, True)]


def test_combo_upsert_replay(spark):
    stored = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, p string, q string")
    batch = spark.createDataFrame([("a", ""), ("c", None), ("b", "x"), ("b", "y")], "p string, q string")
    path = scratch_path(spark, "combos")
    overwrite_table(combo_upsert(stored, batch, ["p", "q"], "id"), path)
    once = spark.read.parquet(path)
    assert sorted((r.id, r.p, r.q) for r in once.collect()) == [(1, "a", None), (2, "b", "x"), (3, "b", "y"), (4, "c", None)]
    assert combo_upsert(once, batch, ["p", "q"], "id").count() == 4


def test_validity_join_of_a_hot_key(spark):
    versions = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 6, 15), "v1"), (1, D(2020, 6, 16), None, "v2"), (2, D(2020, 3, 1), None, "w1")],
                                     "k int, start_date date, end_date date, v string")
    facts = spark.range(900).select(F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("k"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("d"), "id")
    got = validity_join(facts, versions, "k", "d").collect()
    want = sum(1 for i in range(900) if i % 3 or i >= 60)
    assert len(got) == want
    assert all((r.v == "v1") == (r.d <= D(2020, 6, 15)) for r in got if r.k == 1)
    assert validity_join(facts, versions, "k", "d", how="left").count() == 900


def test_full_calendar_keeps_all_rows(spark):
    df = spark.createDataFrame([(1, D(2024, 2, 7)), (2, D(2024, 5, 1)), (3, None)], "i int, d date")
    got = period_start_join(df, df.limit(0), "d", "quarter", "q", calendar="full").collect()
    assert sorted((r.i, r.q) for r in got) == [(1, 20240101), (2, 20240401)]
    with pytest.raises(ValueError):
        period_start_join(df, df, "d", "week")


def test_path_exists_and_sinks(spark):
    path = scratch_path(spark, "sink")
    assert not path_exists(spark, path)
    overwrite_table(spark.range(5).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    append_table(spark.range(5, 7).withColumn("p", F.col("id") % 2), path, partition_by=["p"])
    assert path_exists(spark, path) and path_exists(spark, path + "/p=0") and spark.read.parquet(path).count() == 7
    overwrite_table(spark.range(2).withColumn("p", F.lit(9)), path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 2
