"""NULL and the empty text are one value of a combination dimension, and facts keep their rows."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.joins import nullsafe_join
from starloom.operators.keys import dense_ids
from starloom.operators.scd import first_seen_combinations
from starloom.operators.upsert import combo_upsert

D = dt.date


def test_one_row_for_null_and_empty_and_a_fact_of_as_many_rows(spark):
    ev = spark.createDataFrame([(1, "a", None, D(2024, 1, 3)), (2, "a", "", D(2024, 1, 2)), (3, "b", "x", None), (4, None, "x", D(2024, 1, 1)), (5, "", "x", D(2024, 1, 9))],
                               "id int, t string, k string, d date")
    combos = first_seen_combinations(ev, ["t", "k"], "d")
    got = sorted((tuple(r) for r in combos.collect()), key=str)
    assert got == [("", "x", D(2024, 1, 1)), ("a", "", D(2024, 1, 2)), ("b", "x", D(1900, 1, 1))]
    keyed = dense_ids(combos, ["t", "k"], "combo_id").select("combo_id", F.col("t").alias("ct"), F.col("k").alias("ck"))
    fact = nullsafe_join(ev, keyed, [("t", "ct"), ("k", "ck")])
    assert fact.count() == 5
    assert quality.duplicate_keys(fact, ["id"]).count() == 0


def test_all_null_stays_null(spark):
    ev = spark.createDataFrame([(None, 1, D(2024, 1, 1)), (None, 1, None)], "t string, n int, d date")
    assert [tuple(r) for r in first_seen_combinations(ev, ["t", "n"], "d").collect()] == [(None, 1, D(1900, 1, 1))]


def test_upsert_of_a_batch_with_both(spark):
    stored = spark.createDataFrame([(1, "a", "", D(2024, 1, 1))], "id long, t string, k string, first_seen date")
    batch = spark.createDataFrame([("a", None, D(2024, 2, 1)), ("c", None, D(2024, 2, 3)), ("c", "", D(2024, 2, 2)), ("c", "", D(2024, 2, 5))], "t string, k string, first_seen date")
    got = combo_upsert(stored, batch, ["t", "k"], "id")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", "", D(2024, 1, 1)), (2, "c", "", D(2024, 2, 2))]
    again = combo_upsert(got, batch, ["t", "k"], "id")
    assert again.count() == 2
