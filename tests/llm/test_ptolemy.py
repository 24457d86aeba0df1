"""Ptolemaic clustering against plain integers."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import ptolemy
from starloom.llm.ptolemy import Settings

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, s):
    """Every centroid checked, in Python's integers."""
    kept = [(i, [math.floor(s.scale * x) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == s.dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: hashlib.sha256(f"{s.seed}:{r[0]}".encode()).hexdigest())
    centroids = [v for _, v in order[:s.clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(s.rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for k, vs in own.items():
            centroids[k] = [sum(col) // len(vs) for col in zip(*vs)]
    return sorted((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), centroids


def test_matches_brute_force_on_ties_bad_rows_and_repeated_rows(spark):
    rng = np.random.default_rng(3)
    s = Settings(clusters=5, dims=6, pivots=4, pairs=6, candidates=20)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist() if i % 3 else rng.normal(size=6).tolist(), 0) for i in range(300)]
    rows += [(7, rows[7][1], 0), (900, None, 0), (901, [1.0] * 5, 0), (902, [1.0] * 5 + [None], 0), (903, [math.nan] + [0.0] * 5, 0),
             (904, [math.inf] + [0.0] * 5, 0), (905, [], 0), (906, [0.0] * 6, None)]
    found, centroids = ptolemy.cluster(spark.createDataFrame(rows, KIND).repartition(5), s)
    want, final = brute(rows, s)
    assert sorted(map(tuple, found.collect())) == want
    assert centroids.tolist() == final


def test_bounds_never_exceed_distances_and_do_prune():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(16, 64))
    x = ptolemy.integers(centres[rng.integers(0, 16, 4000)] + 0.05 * rng.normal(size=(4000, 64)), 64)
    c = ptolemy.integers(centres, 64)
    pivots = ptolemy._apart(x[:256], 8)
    bounds = ptolemy.Bounds(pivots, 12)
    xp, cp = ptolemy.to_pivots(x, pivots), ptolemy.to_pivots(c, pivots)
    true = np.stack([ptolemy.squared(x, k[None, :]) for k in c], axis=1)
    assert (bounds.lower(xp, cp) ** 2 <= true * (1 + 1e-12)).all()
    found, distance, checked = ptolemy.assign(x, xp, c, cp, bounds)
    assert (found == true.argmin(1)).all() and (distance == true.min(1)).all()
    assert checked < true.size / 2


def test_large_components_and_null_ids(spark):
    s = Settings(clusters=2, dims=2, pivots=2, pairs=1, candidates=4, rounds=1)
    rows = [(1, [1e300, 0.0], 0), (2, [-1e300, 0.0], 0), (None, [0.0, 0.0], 0), (4, [2.0 ** 40, 1.0], 0)]
    got = ptolemy.report(spark.createDataFrame(rows, KIND), s).collect()
    assert len(got) == 4 and all(0 <= r["distance"] <= ptolemy.LARGEST for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)]])
def test_nothing_usable(spark, rows):
    assert ptolemy.report(spark.createDataFrame(rows, KIND), Settings()).collect() == []


def test_clashing_columns_and_inertia(spark):
    s = Settings(clusters=3, dims=2, pivots=3, pairs=3, candidates=8)
    rows = [(i, [float(i % 7), float(i % 5)], 0) for i in range(60)]
    df = spark.createDataFrame(rows, KIND).select("*", *[F.lit("x").alias(c) for c in ("cluster", "distance", "x", "to_pivots", "c", "k")])
    got = ptolemy.report(df, s).collect()
    assert {r["inertia"] for r in got} == {sum(r["distance"] for r in got)}
    for r in got:
        assert r["cluster_inertia"] == sum(q["distance"] for q in got if q["cluster"] == r["cluster"])
