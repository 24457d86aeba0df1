"""Dimensions rewritten by bucket, and hash deltas against an index by prefix."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators.scd import scd2_merge, scd2_versions
from starloom.operators.stores import HashIndex, Scd2Store
from starloom.sources.files import data_files


def states(spark, rows):
    return spark.createDataFrame([(k, dt.date(2024, 1, d), a) for k, d, a in rows], "k long, day date, a string")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    first = states(spark, [(k, 1 + k % 3, f"a{k % 2}") for k in range(40)] + [(None, 1, "x")])
    store = Scd2Store(spark, f"{tmp_path}/dim", "k", "day", ["a"], buckets=8)
    store.build(first)
    before = {f[0]: f for f in data_files(spark, store.path)}
    batch = states(spark, [(3, 20, "new"), (3, 25, None), (77, 5, "fresh"), (5, 1, "too old"), (None, 9, "x")])
    want = scd2_merge(scd2_versions(first.filter("k is not null"), "k", "day", ["a"]), batch, "k", "day", ["a"])
    touched = store.apply(batch)
    assert 1 <= len(touched) <= 2
    assert sorted(map(str, store.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    after = {f[0]: f for f in data_files(spark, store.path)}
    same = {p for p in before if not any(f"bucket={b}/" in p for b in touched)}
    assert same and all(after[p] == before[p] for p in same)
    assert all(p not in after for p in before if p not in same)


def test_an_applied_batch_rewrites_nothing(spark, tmp_path):
    store = Scd2Store(spark, f"{tmp_path}/dim", "k", "day", ["a"], buckets=4)
    store.build(states(spark, [(1, 1, "a"), (2, 1, "a")]))
    batch = states(spark, [(1, 2, "b")])
    assert len(store.apply(batch)) == 1
    files = data_files(spark, store.path)
    assert store.apply(batch) == [] and store.apply(batch.limit(0)) == []
    assert data_files(spark, store.path) == files


def test_a_small_batch_reads_few_hashes(spark, tmp_path):
    rows = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("row_hash"), "id")
    index = HashIndex(spark, f"{tmp_path}/index")
    assert index.new_rows(rows).count() == 3000
    index.add(rows)
    small = rows.filter("id in (5, 6)").unionByName(spark.range(9000, 9001).select(F.sha2(F.col("id").cast("string"), 256).alias("row_hash"), "id"))
    assert [r.id for r in index.new_rows(small).collect()] == [9000]
    assert index.candidates(small).count() < 100
    assert "PartitionFilters: [prefix" in index.candidates(small)._jdf.queryExecution().executedPlan().toString()
    index.add(rows.filter("id < 10"))  # again, as after a failure
    assert index.new_rows(rows).count() == 0
