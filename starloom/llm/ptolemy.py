"""Centroid clustering of integer vectors, with Ptolemaic pivot bounds.

Fixed pivots are taken from the vectors once, and every vector's distances
to them are written beside it.  For a pivot pair ``p, q`` Ptolemy's
inequality gives

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

so a round knows, without looking at a vector's components, which centroids
can't be its nearest.  The bounds are rounded down by more than their
floating-point error, and whatever they leave is checked in exact integers,
so the result is that of checking every centroid.

Centroids, pivots and sums per cluster are the only things that reach the
driver; their number is a parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import store

#: Components beyond it are cut off, so that squares fit 64 bits.
MOST = 1 << 30
#: Distances from here on are given as the largest 64-bit number.
FAR = 2.0 ** 62
LARGEST = np.iinfo(np.int64).max
#: Vectors assigned at once.
BLOCK = 4096
#: Spacing of doubles at 1; bounds give way by some of it.
EPS = 2.0 ** -52


@dataclass(frozen=True)
class Settings:
    """``pivots`` are chosen, each far from those before, among ``candidates`` vectors; the bounds use ``pairs`` pairs of them."""

    clusters: int = 16
    rounds: int = 3
    seed: int = 1
    dims: int = 64
    scale: int = 64
    pivots: int = 8
    pairs: int = 12
    candidates: int = 256


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles, cut off at ``MOST``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -MOST, MOST).astype(np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``x`` and those of ``c``."""
    d = x - c
    if np.abs(d).max(initial=0) < 1 << 28:
        return np.einsum("ij,ij->i", d, d)
    rough = (d.astype(np.float64) ** 2).sum(1)
    with np.errstate(over="ignore"):
        return np.where(rough < FAR, (d * d).sum(1), LARGEST)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every vector to every pivot."""
    return np.sqrt(np.stack([squared(x, p[None, :]) for p in pivots], axis=1).astype(np.float64))


class Bounds:
    """Lower bounds of distances to centroids from distances to pivots."""

    def __init__(self, pivots: np.ndarray, pairs: int):
        between = to_pivots(pivots, pivots) if len(pivots) else np.zeros((0, 0))
        chosen = [(between[i, j], i, j) for i in range(len(pivots)) for j in range(i) if between[i, j] > 0]
        chosen = sorted(chosen, reverse=True)[:pairs]
        self.apart = np.array([d for d, _, _ in chosen])
        self.p = np.array([i for _, i, _ in chosen], np.int64)
        self.q = np.array([j for _, _, j in chosen], np.int64)

    def lower(self, x: np.ndarray, c: np.ndarray) -> np.ndarray:
        """At most the distance of every row of ``x`` to every row of ``c``, both given by pivot distances."""
        out = np.zeros((len(x), len(c)))
        for d, p, q in zip(self.apart, self.p, self.q):
            a, b = np.outer(x[:, p], c[:, q]), np.outer(x[:, q], c[:, p])
            np.maximum(out, (np.abs(a - b) - 16 * EPS * (a + b)) / d * (1 - 16 * EPS), out=out)
        return out


def assign(x: np.ndarray, x_pivots: np.ndarray, centroids: np.ndarray, c_pivots: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number) and squared distance of every row; and how many exact distances that took."""
    lower = bounds.lower(x_pivots, c_pivots)
    lower *= lower * (1 - 16 * EPS)
    guess = lower.argmin(1)
    best = squared(x, centroids[guess])
    row, number = np.nonzero(lower <= best[:, None].astype(np.float64) * (1 + 16 * EPS))
    exact = np.full(lower.shape, LARGEST)
    exact[row, number] = squared(x[row], centroids[number])
    exact[np.arange(len(x)), guess] = best
    found = exact.argmin(1)
    return found, exact[np.arange(len(x)), found], len(row)


def _matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(len(column), width)


def usable(vectors: DataFrame, s: Settings, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the vectors with ``dims`` components, all of them finite numbers."""
    x = F.col(embedding).cast("array<double>")
    sound = (F.size(x) == s.dims) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col(vec_id).alias("vec_id"), x.alias("x")).filter(F.coalesce(sound, F.lit(False)))


def _first(kept: DataFrame, s: Settings) -> np.ndarray:
    """The integers of the vectors whose seeded id has the smallest hashes: initial centroids first, then pivot candidates."""
    digest = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "x").select("x").limit(max(s.clusters, s.candidates)).collect()
    return integers(np.array([r["x"] for r in rows], np.float64).reshape(-1, s.dims), s.scale)


def _apart(points: np.ndarray, n: int) -> np.ndarray:
    """``n`` of the points, each the farthest from those before it."""
    if not len(points):
        return points
    chosen, near = [0], to_pivots(points, points[:1])[:, 0]
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, to_pivots(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def cluster(vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of every usable vector, and the final centroids' integers.

    Components become ``floor(scale * x)``.  The first centroids are the
    ``clusters`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>``
    (null ids last, ties by components; fewer vectors: fewer centroids).
    Each round assigns all vectors to the nearest centroid by squared
    Euclidean distance (ties: smaller number) and puts the floor of the mean
    in place of every centroid that has vectors; a last assignment follows.

    Null vectors, those of another length and those with a null or
    non-finite component give no row; repeated rows each give one; other
    columns are ignored; an empty table gives no rows.  Integers beyond
    2^30 count as 2^30, distances from 2^62 on as the largest long.
    """
    kept = usable(vectors, s, vec_id, embedding)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    first = _first(kept, s)
    centroids, pivots = first[:s.clusters].copy(), _apart(first[:s.candidates], s.pivots)
    if not len(centroids):
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    width = len(pivots)

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            to = to_pivots(integers(_matrix(batch.column(1), s.dims), s.scale), pivots)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(to.ravel()), width).cast(pa.list_(pa.float64()))],
                                             ["vec_id", "x", "to_pivots"])

    cached = store(kept.mapInArrow(measured, f"vec_id {id_type}, x array<double>, to_pivots array<double>"), "pivot_distances")
    bounds = Bounds(pivots, s.pairs)

    def nearest(batches: Iterable[pa.RecordBatch], at: int, now: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        c_pivots = to_pivots(now, pivots)
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                x = integers(_matrix(batch.column(at), s.dims), s.scale)
                found, distance, _ = assign(x, _matrix(batch.column(at + 1), width), now, c_pivots, bounds)
                yield batch, x, found, distance

    for _ in range(s.rounds):
        now = centroids

        def sums(batches: Iterable[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            n, total = np.zeros(len(now), np.int64), np.zeros(now.shape, np.int64)
            for _, x, found, _ in nearest(batches, 0, now):
                n += np.bincount(found, minlength=len(now))
                np.add.at(total, found, x)
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n[own]), pa.array(total[own].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "total"])

        parts = cached.select("x", "to_pivots").mapInArrow(sums, "cluster long, n long, total array<long>")
        whole = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(s.dims)]
        centroids = now.copy()
        for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *whole).collect():  # a row for each centroid at most
            centroids[r["cluster"]] = [int(r[f"t{i}"]) // r["n"] for i in range(s.dims)]

    final = centroids

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, found, distance in nearest(batches, 1, final):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return cached.mapInArrow(last, f"vec_id {id_type}, cluster int, distance long"), centroids


def report(vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``cluster``'s rows with ``cluster_inertia``, ``inertia`` and the centroid's components as ``centroid``."""
    found, centroids = cluster(vectors, s, vec_id, embedding)
    found = store(found, "clusters")
    sums = found.groupBy(F.col("cluster").alias("c")).agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    of_all = sums.agg(F.sum("own")).scalar()
    most = F.lit(int(LARGEST)).cast("decimal(38,0)")
    rows = [(i, [int(v) for v in c]) for i, c in enumerate(centroids)]
    known = found.sparkSession.createDataFrame(rows, "k int, centroid array<long>")
    # both have a row for each centroid
    facts = sums.join(F.broadcast(known), F.col("c") == F.col("k")).select(
        "c", "centroid", F.least("own", most).cast("long").alias("cluster_inertia"), F.least(of_all, most).cast("long").alias("inertia"))
    return found.join(F.broadcast(facts), F.col("cluster") == F.col("c")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: list[int]) -> str:
    """SHA-256 of a centroid's components as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
