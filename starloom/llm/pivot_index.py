"""Links between close vectors, by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), nearest
first.  Every pivot has an inverted list of the vectors that name it; two
vectors that share at least ``shared`` pivots are candidates, and candidates
are verified by their cosine in double precision.

The pivots are picked from a hash sample of the distinct vectors, and a
sampled vector near one picked before isn't taken, so that a dense crowd of
vectors has one pivot rather than many that would divide it.  Their number
grows with the square root of the vectors, as do the lists.

Pairs are never written out.  Copies meet as one vector with a weight.
Vectors so near one pivot that the triangle inequality of angles alone links
them all form a clique that is counted, not compared.  Everything else is
compared in blocks inside a list; a block returns, for each of its vectors,
the weight of its links and one link towards the smallest vector it reaches
there.  Long lists are cut into blocks that meet pairwise in tasks of their
own.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import store
from starloom.llm.components import components

#: Rows whose products with a block are held at once.
SLAB = 512
#: A clique is left out of comparisons as a whole from so many members in a sublist; smaller ones are masked.
RUN = 64


@dataclass(frozen=True)
class Settings:
    """``per_root`` times the square root of the distinct vectors are sampled for pivots, at most ``most_sampled``.

    ``named`` nearest pivots describe a vector, and candidates share two of
    them; pivots are at a cosine below ``apart`` of each other; a list longer
    than ``block`` is cut.
    """

    cosine: float = 0.9
    named: int = 8
    per_root: float = 2.0
    apart: float = 0.75
    most_sampled: int = 16384
    block: int = 4096


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; large and tiny ones don't overflow on the way."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


def spread(x: np.ndarray, apart: float) -> np.ndarray:
    """Of unit rows, in order, those at a cosine below ``apart`` of all taken before."""
    taken, n = np.empty_like(x), 0
    for row in x:
        if not n or (taken[:n] @ row).max() < apart:
            taken[n], n = row, n + 1
    return taken[:n]


def classes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows with their number, and distinct usable vectors as ``v, x, least, weight``.

    Unusable vectors (null, empty, zero, with a null or non-finite
    component) have a null ``x`` in the rows and no class.
    """
    x = F.col(embedding)
    sound = (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.when(F.coalesce(sound, F.lit(False)), x).alias("x"))
    distinct = rows.filter("x is not null").groupBy("x").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
    # the numbers are fixed by being written
    return rows, store(distinct.select(F.monotonically_increasing_id().alias("v"), "x", "least", "weight"), "vector_classes")


def pivots(distinct: DataFrame, s: Settings) -> dict[int, np.ndarray]:
    """Pivots by vector length, from a sample of at most ``most_sampled`` distinct vectors, those with the smallest hashes."""
    n = distinct.count()
    size = min(s.most_sampled, math.ceil(s.per_root * math.sqrt(n)))
    found: dict[int, list[list[float]]] = {}
    for r in distinct.select("x").orderBy(F.xxhash64("x"), "x").limit(size).collect():
        found.setdefault(len(r["x"]), []).append(r["x"])
    return {d: spread(unit(np.array(rows, np.float64)), s.apart) for d, rows in found.items()}


def describe(distinct: DataFrame, points: dict[int, np.ndarray], s: Settings) -> DataFrame:
    """``v, x, weight, dim, named, clique``: a vector's nearest pivots, ascending by number, and its clique or -1.

    A clique is named by its pivot: its vectors are within half the linking
    angle of it, so any two of them are linked.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(points)  # most_sampled vectors at most
    near = math.cos(math.acos(s.cosine) / 2 - 1e-7)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pa.compute.list_value_length(batch.column(1)))
            for d in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == d)
                part = batch.take(pa.array(own))
                x = unit(np.asarray(part.column(1).flatten()).astype(np.float64).reshape(len(own), d))
                p = shared.value.get(d, np.zeros((0, d)))
                k = min(s.named, len(p))
                products = x @ p.T
                # ties go to the smaller pivot number
                order = np.argsort(-products, axis=1, kind="stable")[:, :k]
                clique = np.full(len(own), -1, np.int64)
                if k:
                    best = order[:, 0]
                    clique = np.where(products[np.arange(len(own)), best] >= near, best, -1)
                names = pa.array(np.sort(order, axis=1).tolist(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(own), d, np.int32)), names, pa.array(clique)],
                                                 ["v", "x", "weight", "dim", "named", "clique"])

    kind = distinct.schema["x"].dataType.simpleString()
    return distinct.select("v", "x", "weight").mapInArrow(run, f"v long, x {kind}, weight long, dim int, named array<int>, clique long")


class Found:
    """Link weights of a list's vectors, and links that join what it connects."""

    def __init__(self, n: int):
        self.weight = np.zeros(n, np.int64)
        self.root = np.arange(n)

    def add(self, rows: np.ndarray, columns: np.ndarray, weights: np.ndarray) -> None:
        np.add.at(self.weight, rows, weights[columns])
        np.add.at(self.weight, columns, weights[rows])
        root = self.root
        while True:
            a, b = root[rows], root[columns]
            if (a == b).all():
                return
            low = np.minimum(a, b)
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            while (root[root] != root).any():
                root[:] = root[root]


def _sublist(x: np.ndarray, lower: np.ndarray, clique: np.ndarray, side: np.ndarray, members: np.ndarray, cosine: float, weights: np.ndarray, found: Found) -> None:
    """Compare the members of a list that also name a second pivot, where no other shared pivot comes before that.

    ``lower``: for each vector of the list, whether it names each of the
    pivots before the second (the list's own left out).  ``side``: 0 and 1
    are two blocks, of which only pairs across count here; 2 is a block of
    its own.
    """
    order = members[np.argsort(clique[members], kind="stable")]
    label = clique[order]
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(label)) + 1, [len(order)]))
    large = [(i, j) for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if label[i] >= 0 and j - i >= RUN]
    rest = np.ones(len(order), bool)
    for i, j in large:
        rest[i:j] = False
    jobs = [(np.arange(i, j), np.concatenate((np.arange(j, len(order)), np.flatnonzero(rest[:i]))), False) for i, j in large]
    small = np.flatnonzero(rest)
    jobs.append((small, small, True))
    for left, right, same in jobs:
        for at in range(0, len(left), SLAB):
            a = order[left[at:at + SLAB]]
            b = order[right[at:] if same else right]
            if not len(a) or not len(b):
                continue
            r, c = np.nonzero(x[a] @ x[b].T >= cosine)
            if same:
                r, c = r[r < c], c[r < c]
            if not len(r):
                continue
            i, j = a[r], b[c]
            once = (clique[i] < 0) | (clique[i] != clique[j])
            once &= (side[i] == 2) | (side[i] != side[j])
            once[once] = ~(lower[i[once]] & lower[j[once]]).any(1)
            found.add(i[once], j[once], weights)


def compare(pivot: int, x: np.ndarray, named: list[np.ndarray], clique: np.ndarray, weights: np.ndarray, side: np.ndarray, s: Settings) -> Found:
    """All links of a list's vectors that are this list's to find: its pivot is the smallest that both name."""
    n = len(x)
    found = Found(n)
    owner = np.repeat(np.arange(n), [len(k) for k in named])
    flat = np.concatenate(named) if n else np.zeros(0, np.int32)
    seconds, number = np.unique(flat, return_inverse=True)
    names = np.zeros((n, len(seconds)), bool)
    names[owner, number] = True
    own = int(np.searchsorted(seconds, pivot))
    if len(seconds) == 1:
        _sublist(x, names[:, :0], clique, side, np.arange(n), s.cosine, weights, found)
        return found
    names[:, own] = False  # all name it
    for k in range(own + 1, len(seconds)):
        members = np.flatnonzero(names[:, k])
        if len(members) > 1:
            _sublist(x, names[:, :k], clique, side, members, s.cosine, weights, found)
    return found


def _lists(described: DataFrame, s: Settings) -> DataFrame:
    """A row for each vector in each task that compares it: ``dim, pivot, i, j, side`` and the vector.

    A clique longer than a block has blocks of its own, which never meet
    each other: its vectors only meet the rest of the list.
    """
    # vectors of a length without pivots share one list
    pivot = F.explode(F.when(F.size("named") > 0, F.col("named")).otherwise(F.array(F.lit(-1))))
    entries = described.select("dim", pivot.alias("pivot"), "v", "x", "weight", "named", "clique")
    sizes = described.select("dim", pivot.alias("pivot"), "clique").groupBy("dim", "pivot", "clique").count()
    crowd = (F.col("clique") >= 0) & (F.col("count") > s.block)
    cut = F.ceil(F.col("count") / s.block).cast("int")
    # an entry for each clique of over s.block vectors in a list
    plans = sizes.groupBy(F.col("dim").alias("d"), F.col("pivot").alias("p")).agg(
        F.ceil(F.sum(F.when(crowd, 0).otherwise(F.col("count"))) / s.block).cast("int").alias("rest"), F.sum("count").alias("all"),
        F.sort_array(F.collect_list(F.when(crowd, F.struct("clique", cut.alias("cut"))))).alias("crowds")).filter(F.col("all") > 1)
    placed = entries.join(plans, (F.col("dim") == F.col("d")) & (F.col("pivot") == F.col("p")))
    before = F.aggregate(F.filter("crowds", lambda c: c["clique"] < F.col("clique")), F.col("rest"), lambda n, c: n + c["cut"])
    mine = F.element_at(F.filter("crowds", lambda c: c["clique"] == F.col("clique")), 1)["cut"]
    placed = placed.withColumn("mine", F.when(F.exists("crowds", lambda c: c["clique"] == F.col("clique")), mine)).withColumn("before", before)
    placed = placed.withColumn("own", F.when(F.col("mine").isNull(), F.pmod(F.xxhash64("v"), F.col("rest")))
                               .otherwise(F.col("before") + F.pmod(F.xxhash64("v"), F.col("mine"))).cast("int"))
    every = F.sequence(F.lit(0), F.aggregate("crowds", F.col("rest"), lambda n, c: n + c["cut"]) - 1)
    met = F.filter(every, lambda k: F.col("mine").isNull() | (k < F.col("before")) | (k >= F.col("before") + F.col("mine")))
    tasks = F.transform(met, lambda k: F.struct(
        F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"),
        F.when(k == F.col("own"), 2).when(k > F.col("own"), 0).otherwise(1).alias("side")))
    return placed.withColumn("t", F.explode(tasks)).select(
        "dim", "pivot", F.col("t.i").alias("i"), F.col("t.j").alias("j"), F.col("t.side").alias("side"), "v", "x", "weight", "named", "clique")


def links(described: DataFrame, s: Settings) -> DataFrame:
    """``v, weight, root``: per list, the weight that a vector is linked to and the smallest vector that the list connects it with."""

    def run(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot")[0].as_py()
        d = table.column("dim")[0].as_py()
        x = unit(np.asarray(table.column("x").combine_chunks().flatten()).astype(np.float64).reshape(table.num_rows, d))
        v = np.asarray(table.column("v"))
        order = np.argsort(v, kind="stable")  # roots are then smallest vectors
        named = [np.array(k, np.int32) if k else np.array([-1], np.int32) for k in table.column("named").to_pylist()]
        found = compare(pivot, x[order], [named[i] for i in order], np.asarray(table.column("clique"))[order], np.asarray(table.column("weight"))[order],
                        np.asarray(table.column("side"))[order], s)
        v = v[order]
        own = np.flatnonzero(found.weight)
        return pa.table({"v": v[own], "weight": found.weight[own], "root": v[found.root[own]]})

    return _lists(described, s).groupBy("dim", "pivot", "i", "j").applyInArrow(run, "v long, weight long, root long")


def near_groups(vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``n_links``: other rows at a cosine of at least ``s.cosine`` that the
    index finds (copies included); ``component_id``: the smallest vec_id
    that links reach, itself included (null if none there has one);
    ``kept``: whether that is the row's own.  No pair below the threshold is
    linked.  Vectors of different lengths are never linked.  Null, empty and
    zero vectors and those with null or non-finite components are linked to
    nothing.  Repeated rows are linked to each other like copies; other
    columns are ignored; an empty table gives no rows.
    """
    rows, distinct = classes(vectors, vec_id, embedding)
    described = store(describe(distinct, pivots(distinct, s), s), "described")
    found = store(links(described, s), "links")
    # a clique is one star around its smallest vector; there are no more cliques than pivots
    crowd = described.filter("clique >= 0").groupBy(F.col("dim").alias("d"), F.col("clique").alias("q")).agg(
        F.min("v").alias("first"), F.sum("weight").alias("crowd"))
    in_crowd = described.filter("clique >= 0").select("v", "dim", "clique", "weight").join(
        F.broadcast(crowd), (F.col("dim") == F.col("d")) & (F.col("clique") == F.col("q")))
    stars = store(in_crowd.select("v", (F.col("crowd") - F.col("weight")).alias("weight"), F.col("first").alias("root")), "stars")
    both = found.unionByName(stars)
    labels = components(both.select(F.col("v").alias("a"), F.col("root").alias("b")))
    total = both.groupBy("v").agg(F.sum("weight").alias("linked"))
    ids = distinct.select(F.col("v").alias("n"), F.col("least"))
    linked = labels.join(ids, F.col("node") == F.col("n")).select("node", "root", "least")
    smallest = linked.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("smallest"))
    named = linked.join(smallest, F.col("root") == F.col("r")).select("node", "smallest", F.lit(True).alias("hit"))
    facts = store(distinct.join(total.withColumnRenamed("v", "t"), F.col("v") == F.col("t"), "left")
                  .join(named, F.col("v") == F.col("node"), "left")
                  .select(F.col("x").alias("y"), (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                          F.when(F.col("hit"), F.col("smallest")).otherwise(F.col("least")).alias("component_id")), "facts")
    out = rows.join(facts, F.col("x") == F.col("y"), "left")
    component = F.when(F.col("x").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def recall(spark: SparkSession, vectors: DataFrame, s: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> float:
    """Share of all links that the index finds, measured for the rows whose id is divisible by 20 against all rows.

    The queries are compared with every row in blocks, exactly.  1.0 without any link.
    """
    rows, _ = classes(vectors, vec_id, embedding)
    rows = store(rows.filter("x is not null"), "recall_rows")
    asked = rows.filter(F.col("vec_id") % 20 == 0)
    blocks = max(1, math.ceil(asked.count() / s.block))
    sent = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    n_found = near_groups(vectors, s, vec_id, embedding).filter(F.col("vec_id") % 20 == 0).agg(F.sum("n_links")).first()[0]
    total = 0
    for part in range(blocks):
        held = [(len(r["x"]), r["x"]) for r in sent.filter(F.col("part") == part).select("x").collect()]
        queries = {d: unit(np.array([x for k, x in held if k == d], np.float64)) for d in {k for k, _ in held}}
        shared = spark.sparkContext.broadcast(queries)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = 0
                by_length: dict[int, list] = {}
                for x in batch.column(0).to_pylist():
                    by_length.setdefault(len(x), []).append(x)
                for d, xs in by_length.items():
                    if d in shared.value:
                        n += int((unit(np.array(xs, np.float64)) @ shared.value[d].T >= s.cosine).sum())
                yield pa.RecordBatch.from_arrays([pa.array([n])], ["n"])

        total += (rows.select("x").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0) - len(held)
    return 1.0 if not total else (n_found or 0) / total
