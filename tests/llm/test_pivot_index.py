"""The pivot-permutation index against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import pivot_index
from starloom.llm.pivot_index import Settings

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, least=0.9):
    """Every pair compared: id, links, smallest id reached."""
    def sound(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    x = [pivot_index.unit(np.array([v]))[0] if sound(v) else None for _, v, *_ in rows]
    near = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]) and x[i] @ x[j] >= least] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def found(spark, rows, s=Settings()):
    got = pivot_index.near_groups(spark.createDataFrame(rows, KIND).repartition(4), s).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)


def turned(rng, x, cosine):
    z = rng.normal(size=x.shape)
    z -= (z @ x) * x
    return cosine * x + math.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)


def corpus(rng, n=250, d=24):
    """Lone vectors, copies, a tight crowd, a loose crowd, and a chain."""
    base = pivot_index.unit(rng.normal(size=(n, d)))
    out = list(base)
    out += [base[3]] * 5
    out += [turned(rng, base[0], 0.995) for _ in range(90)]
    out += [turned(rng, base[1], rng.uniform(0.93, 0.99)) for _ in range(60)]
    link = base[2]
    for _ in range(6):
        link = turned(rng, link, 0.92)
        out.append(link)
    return [(int(i), (v * rng.uniform(0.1, 9)).tolist(), 0) for i, v in zip(rng.permutation(len(out)) + 100, out)]


def test_all_links_where_lists_hold_everything(spark):
    """All pivots describe every vector: the index can miss nothing, so all counts must be exact."""
    rows = corpus(np.random.default_rng(0))
    s = Settings(named=1000, apart=0.95)
    assert found(spark, rows, s) == brute(rows)


def test_long_lists_meet_block_by_block(spark):
    rows = corpus(np.random.default_rng(1), n=120)
    # the tight crowd of 91 is a clique longer than a block
    assert found(spark, rows, Settings(named=1000, apart=0.95, block=50)) == brute(rows)
    assert found(spark, rows, Settings(named=3, apart=0.5, block=20))[0][0] == 100


def test_default_settings_never_link_below_and_find_nearly_all(spark):
    rng = np.random.default_rng(2)
    base = pivot_index.unit(rng.normal(size=(1500, 64)))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    rows += [(2000 + i, turned(rng, base[i], rng.uniform(0.901, 0.96)).tolist(), 0) for i in range(400)]
    want, got = {r[0]: r[1] for r in brute(rows)}, {r[0]: r[1] for r in found(spark, rows)}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.95 * sum(want.values())


def test_recall_is_measured_against_all_rows(spark):
    rng = np.random.default_rng(4)
    base = pivot_index.unit(rng.normal(size=(300, 32)))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)] + [(1000 + 20 * i, turned(rng, base[i], 0.91).tolist(), 0) for i in range(100)]
    df = spark.createDataFrame(rows, KIND)
    assert 0.9 <= pivot_index.recall(spark, df) <= 1.0
    assert pivot_index.recall(spark, df, Settings(named=2)) < 0.9


def test_bad_vectors_lengths_and_null_ids(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 0), (4, None, 0), (5, [], 0), (6, [0.0, 0.0], 0), (7, [1.0, None], 0),
            (8, [math.nan, 1.0], 0), (9, [math.inf, 1.0], 0), (9, [1.0, 0.0], 0), (None, [0.0, 1e-300], 0), (None, [0.0, 1e300], 0), (12, [1e308, 1e308], None),
            (13, [1.0, 1.0], 0), (13, [1.0, 1.0], 0)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(5, [1.0], 0)]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_clashing_columns(spark):
    rows = corpus(np.random.default_rng(3), n=30)
    df = spark.createDataFrame(rows, KIND).select("*", *[F.lit("u").alias(c) for c in ("x", "v", "weight", "named", "clique", "dim", "n_links", "root")])
    s = Settings(named=1000, apart=0.95)
    got = sorted(tuple(r)[:3] for r in pivot_index.near_groups(df, s).collect())
    assert got == sorted(brute(rows))
