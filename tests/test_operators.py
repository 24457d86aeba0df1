"""Properties of the compound operators."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import dedup, quality, reports
from starloom.operators.conform import SourceSpec, conform_columns, integrate
from starloom.operators.dims import dim_date
from starloom.operators.joins import nullsafe_join, period_start_join, validity_join
from starloom.operators.keys import dense_ids, next_start
from starloom.operators.lookups import DuplicateMapKey, Resolution, assert_unique, build_map, resolve, seed_frame
from starloom.operators.matview import MaterializedAggregate
from starloom.operators.scd import (first_seen_combinations, lag_within_key, last_state_per_day, late_states,
                                    scd2_merge, scd2_versions)
from tests.conftest import SMALL


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")


def test_keep_first_is_idempotent_and_picks_minimum(spark):
    ev = events(spark).select("user_id", F.to_date("ts").alias("d"), "event_type", "event_id")
    once = dedup.keep_first(ev, ["user_id", "d", "event_type"], [F.col("event_id")])
    twice = dedup.keep_first(once, ["user_id", "d", "event_type"], [F.col("event_id")])
    assert rows(once, "event_id") == rows(twice, "event_id")
    expect = ev.groupBy("user_id", "d", "event_type").agg(F.min("event_id").alias("event_id"))
    assert rows(once.select("user_id", "d", "event_type", "event_id"), "event_id") == \
        rows(expect.select("user_id", "d", "event_type", "event_id"), "event_id")


def test_delta_of_same_batch_is_empty(spark):
    b = events(spark).select("event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("row_hash"))
    assert dedup.new_rows(b, b).count() == 0
    half = b.filter(F.col("event_id") % 2 == 0)
    assert dedup.new_rows(b, half).count() == b.count() - half.count()


def _versions(spark):
    daily = last_state_per_day(events(spark), "user_id", "ts", "event_id", ["event_type"])
    return daily, scd2_versions(daily, "user_id", "state_date", ["event_type"])


def test_scd2_intervals_are_disjoint_and_cover(spark):
    _, v = _versions(spark)
    assert v.filter("is_current").groupBy("user_id").count().filter("count <> 1").count() == 0
    assert v.groupBy("user_id").count().count() == v.filter("is_current").count()
    w = Window.partitionBy("user_id").orderBy("start_date")
    gaps = v.withColumn("next_start", F.lead("start_date").over(w)).filter(
        F.col("next_start").isNotNull() & (F.date_add("end_date", 1) != F.col("next_start")))
    assert gaps.count() == 0
    assert v.filter(F.col("end_date") < F.col("start_date")).count() == 0


def test_scd2_merge_equals_full_rebuild_and_rerun_is_noop(spark):
    daily, full = _versions(spark)
    cut = dt.date(2024, 1, 15)
    first = scd2_versions(daily.filter(F.col("state_date") < cut), "user_id", "state_date", ["event_type"])
    merged = scd2_merge(first, daily.filter(F.col("state_date") >= cut), "user_id", "state_date", ["event_type"])
    cols = ["user_id", "event_type", "start_date", "end_date", "is_current", "version_no"]
    assert rows(merged.select(*cols), "user_id", "start_date") == rows(full.select(*cols), "user_id", "start_date")
    again = scd2_merge(merged, daily.filter(F.col("state_date") >= cut), "user_id", "state_date", ["event_type"])
    assert rows(again.select(*cols), "user_id", "start_date") == rows(merged.select(*cols), "user_id", "start_date")


def test_late_states_are_those_the_history_contradicts(spark):
    day = lambda n: dt.date(2024, 1, n)
    dim = scd2_versions(spark.createDataFrame([(1, day(5), "a"), (1, day(10), "b"), (2, day(7), None)], "k int, d date, a string"), "k", "d", ["a"])
    batch = [(1, day(5), "a"), (1, day(7), "a"), (1, day(7), "x"), (1, day(7), "x"), (1, day(3), "a"), (1, day(10), "b"), (1, day(12), "c"),
             (2, day(7), ""), (3, day(1), "new"), (None, day(1), "z"), (1, None, "q")]
    df = spark.createDataFrame(batch, "k int, d date, a string")
    assert sorted(tuple(r) for r in late_states(dim, df, "k", "d", ["a"]).collect()) == [(1, day(3), "a"), (1, day(7), "x")]
    assert late_states(scd2_merge(dim, df, "k", "d", ["a"]), df.filter("a = 'c' OR k = 3"), "k", "d", ["a"]).count() == 0
    assert late_states(dim, df.limit(0), "k", "d", ["a"]).count() == 0


def test_bucketed_lag_equals_plain_lag_even_for_a_hot_key(spark):
    ev = events(spark)
    # make one user hold most rows (a hot key) and add anonymous rows
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 != 0, F.lit(1)).otherwise(F.col("user_id")))
    hot = hot.withColumn("user_id", F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("user_id")))
    a = lag_within_key(hot, "user_id", ["ts", "event_id"], ["event_type", "value"])
    b = lag_within_key(hot, "user_id", ["ts", "event_id"], ["event_type", "value"], bucket=F.to_date("ts"))
    cols = ["event_id", "event_type_past", "value_past"]
    assert rows(a.select(*cols), "event_id") == rows(b.select(*cols), "event_id")


def test_dense_ids_equal_global_row_number(spark):
    ev = events(spark).select("event_type", "user_id").distinct()
    got = dense_ids(ev, ["event_type", "user_id"], "id", num_partitions=5)
    want = ev.withColumn("id", F.row_number().over(Window.orderBy("event_type", "user_id")).cast("bigint"))
    assert rows(got.select("id", "event_type", "user_id"), "id") == rows(want.select("id", "event_type", "user_id"), "id")
    more = dense_ids(ev.limit(3), ["event_type", "user_id"], "id", start=next_start(got, "id"))
    assert more.agg(F.min("id")).first()[0] == ev.count() + 1


def test_matview_refresh_equals_full_aggregate(spark):
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    mv = MaterializedAggregate(["l_returnflag"], {"qty": F.col("l_quantity").cast("decimal(18,2)")})
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    path = mv.build(spark, li.filter(F.col("l_shipdate") < cut))
    path = mv.refresh(spark, path, li.filter(~(F.col("l_shipdate") < cut) | F.col("l_shipdate").isNull()))
    assert rows(spark.read.parquet(path), "l_returnflag") == rows(mv.aggregate(li), "l_returnflag")


def test_drilldown_parent_equals_sum_of_children(spark):
    c = spark.read.parquet(f"{SMALL}/customer.parquet").withColumn("region", F.col("c_nationkey") % 5)
    out = reports.drilldown(c, ["region"], "c_nationkey", {"n": F.count(F.lit(1))})
    parents = out.filter(F.col("c_nationkey").isNull()).select("region", "n")
    children = out.filter(F.col("c_nationkey").isNotNull()).groupBy("region").agg(F.sum("n").alias("n"))
    assert rows(parents, "region") == rows(children, "region")
    assert set(r[0] for r in out.select("geography_level").distinct().collect()) == {"Country Level", "State Level"}


def test_shares_sum_to_hundred(spark):
    ev = events(spark).withColumn("b", F.col("user_id") % 4)
    s = reports.share_within(ev, ["b", "event_type"], ["b"], "n", "share")
    tot = s.groupBy("b").agg(F.sum(F.regexp_replace("share", " %", "").cast("decimal(10,2)")).alias("t"))
    for (t,) in tot.select("t").collect():
        assert abs(float(t) - 100.0) <= 0.05


def test_nullsafe_join_matches_null_and_blank(spark):
    left = spark.createDataFrame([(1, None), (2, ""), (3, "a")], "id int, k string")
    right = spark.createDataFrame([("", "blank"), ("a", "A")], "k2 string, label string")
    got = rows(nullsafe_join(left, right, [("k", "k2")]).select("id", "label"), "id")
    assert got == [(1, "blank"), (2, "blank"), (3, "A")]


def test_validity_join_open_end(spark):
    facts = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (1, dt.date(2024, 3, 1))], "k int, d date")
    vers = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 1, 31), 1),
                                  (1, dt.date(2024, 2, 1), None, 2)], "k int, start_date date, end_date date, v int")
    assert rows(validity_join(facts, vers, "k", "d").select("d", "v"), "d") == \
        [(dt.date(2024, 1, 5), 1), (dt.date(2024, 3, 1), 2)]


def test_validity_join_stands_versions_only_where_facts_are(spark):
    # an open version of ten years, facts in two months: the version is met twice, not 120 times
    vers = spark.createDataFrame([(1, dt.date(2014, 1, 1), None, 1), (2, dt.date(2014, 1, 1), dt.date(2014, 1, 31), 2)],
                                 "k int, start_date date, end_date date, v int")
    facts = spark.createDataFrame([(1, dt.date(2014, 1, 1), 0), (1, dt.date(2023, 12, 31), 1), (1, None, 2), (None, dt.date(2014, 1, 1), 3),
                                   (2, dt.date(2014, 1, 31), 4), (2, dt.date(2014, 2, 1), 5)], "k int, d date, i int")
    assert sorted((r.i, r.v) for r in validity_join(facts, vers, "k", "d").collect()) == [(0, 1), (1, 1), (4, 2)]
    assert sorted((r.i, r.v) for r in validity_join(facts, vers, "k", "d", how="left").collect() if r.v is None) == [(2, None), (3, None), (5, None)]
    plan = validity_join(facts, vers, "k", "d")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_period_start_join_is_strict(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 9),), (dt.date(2024, 2, 9),)], "d date")
    dd = dim_date(df, "d")
    got = rows(period_start_join(df, dd, "d", "month", "mk").select("d", "mk"), "d")
    assert got == [(dt.date(2024, 1, 1), 20240101), (dt.date(2024, 1, 9), 20240101)]   # February has no day 1


def test_map_builder_and_resolution(spark):
    master = seed_frame(spark, [(1, "Yes"), (2, "No"), (0, "Not Found")], "id int, value string")
    seed = seed_frame(spark, [("y", "Yes"), ("YES", "Yes"), ("n", "No"), ("", "Not Found")], "raw string, final string")
    m = assert_unique(build_map(seed, "raw", "final", master, "value", "id"), ["raw_key"])
    codes = seed_frame(spark, [("1", "Yes"), ("2", "No")], "code string, label string")
    df = spark.createDataFrame([(1, "1.0"), (2, " y. "), (3, "maybe"), (4, None), (5, "")], "i int, raw string")
    out = resolve(df, [Resolution("raw", "r1", code_labels=codes, text_map=m),
                       Resolution("raw", "r2", text_map=m, fallback_raw=True)])
    assert rows(out.select("i", "r1", "r2"), "i") == [
        (1, "Yes", "1.0"), (2, "Yes", "Yes"), (3, "Not Found", "maybe"), (4, "Not Found", "Not Found"),
        (5, "Not Found", "Not Found")]
    bad = seed_frame(spark, [("y", "Yes"), ("Y.", "No")], "raw string, final string")
    try:
        assert_unique(build_map(bad, "raw", "final", master, "value", "id"), ["raw_key"])
        raise AssertionError("expected DuplicateMapKey")
    except DuplicateMapKey:
        pass


def test_conform_and_integrate(spark):
    df = spark.createDataFrame([("1", "x", "junk")], "a string, b string, c string")
    out = conform_columns(df, {"a": "id", "b": "name", "zz": "missing"},
                          [("id", "int"), ("name", "string"), ("missing", "string"), ("extra", "double")])
    assert out.columns == ["id", "name", "missing", "extra"]
    assert tuple(out.first()) == (1, "x", None, None)
    u = integrate([(df, SourceSpec("s1", {"id": F.col("a")})), (df, SourceSpec("s2", defaults={"id": 7}))],
                  [("source_system", "string"), ("id", "int")])
    assert rows(u, "source_system") == [("s1", 1), ("s2", 7)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"]), "k") == [(1, 2)]
    assert rows(quality.null_counts(df, ["k", "v"]), "column_name") == [("k", 0), ("v", 1)]
    parent = spark.createDataFrame([(1,)], "pk int")
    assert rows(quality.orphans(df, parent, ["k"], ["pk"]), "k") == [(2, None)]


def test_first_seen_combinations(spark):
    df = spark.createDataFrame([("a", None), ("a", dt.date(2024, 1, 2)), ("b", dt.date(2024, 1, 3))], "x string, d date")
    assert rows(first_seen_combinations(df, ["x"], "d"), "x") == [("a", dt.date(1900, 1, 1)), ("b", dt.date(2024, 1, 3))]
