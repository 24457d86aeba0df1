"""SimHash near-duplicate groups, with pigeonring candidate filtering.

Texts get a 64-bit fingerprint; fingerprints that differ in few bits are
linked; a group is what links reach.

Candidates come from the pigeonring principle.  Cut into ``k + 1`` segments
in a ring, two fingerprints with at most ``k`` differing bits have a
segment from which every chain of ``l`` consecutive segments differs in at
most ``l * k / (k + 1)`` bits.  The first two budgets (none, then one bit)
are part of the join key: one side gives its two-segment values, the other
also their one-bit variants.  The longer chains are checked in the join,
and the full distance last.  Texts with one fingerprint meet as one row, so
copies make no pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import bytes_of, number_of, numbered, small_batches, store
from starloom.llm.components import components

BITS = 64
#: Shingle hashes whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of a text: a bit is set if it is set in over half the shingles' XXH64; 0 without words."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    text = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(text, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:n - shingle])).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    hashes = np.array([digest(text[i:j], seed) for i, j in zip(starts, stops)], dtype="<u8")
    set_in = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` is the fingerprint as a signed long. A null text has no words."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle, seed) for x in bytes_of(batch.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"),
                       F.col(text).cast("binary").alias("raw"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _mask(bits: int) -> int:
    """``bits`` as the signed long with those bits."""
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def close_pairs(points: DataFrame, distance: int = 4, fp: str = "fp") -> DataFrame:
    """``a, b``: all pairs ``a < b`` of the distinct fingerprints in ``points`` that differ in 1 to ``distance`` bits."""
    k, m = distance, distance + 1
    edges = [BITS * i // m for i in range(m + 1)]
    widths = [edges[i + 1] - edges[i] for i in range(m)]

    def segment(x: Column, i: int) -> Column:
        return F.shiftrightunsigned(x, edges[i % m]).bitwiseAND(F.lit((1 << widths[i % m]) - 1))

    def key(x: Column, i: int, flip: int = 0) -> Column:
        # segment i, then segment i + 1 with at most one bit flipped
        second = segment(x, i + 1).bitwiseXOR(F.lit(flip)) if flip else segment(x, i + 1)
        return F.struct(F.lit(i).alias("i"), F.shiftleft(segment(x, i), 32).bitwiseOR(second).alias("key"))

    p = points.select(F.col(fp).alias("fp"))
    one = p.select(F.col("fp").alias("x"), F.explode(F.array(*[key(F.col("fp"), i) for i in range(m)])).alias("k"))
    flips = [key(F.col("fp"), i, f) for i in range(m) for f in [0, *(1 << j for j in range(widths[(i + 1) % m]))]]
    other = p.select(F.col("fp").alias("y"), F.explode(F.array(*flips)).alias("v"))
    one = one.select("x", F.col("k.i").alias("i"), F.col("k.key").alias("key"))
    other = other.select("y", F.col("v.i").alias("j"), F.col("v.key").alias("other_key"))

    within = F.lit(True)
    differ = F.col("x").bitwiseXOR(F.col("y"))
    for length in range(3, m + 1):
        masks = [_mask(sum(((1 << widths[(i + s) % m]) - 1) << edges[(i + s) % m] for s in range(length))) for i in range(m)]
        chain = F.element_at(F.array(*map(F.lit, masks)), F.col("i") + 1)
        within = within & (F.bit_count(differ.bitwiseAND(chain)) <= length * k // m)
    same = (F.col("i") == F.col("j")) & (F.col("key") == F.col("other_key")) & (F.col("x") < F.col("y"))
    # Spark sizes both sides as if nothing had been exploded, and would send the larger one through the driver
    near = one.hint("merge").join(other.hint("merge"), same & within & (F.bit_count(differ) <= k))
    return near.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _classes(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, component_id`` of every distinct fingerprint: the smallest doc_id that links reach."""
    classes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    if distance > 0:
        labels = components(close_pairs(classes, distance))
    else:
        labels = classes.select(F.col("fp").alias("node"), F.col("fp").alias("root")).limit(0)
    linked = labels.join(classes, labels["node"] == classes["fp"]).select("node", "root", "least")
    smallest = linked.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("smallest"))
    joined = store(labels.join(store(smallest, "smallest"), F.col("root") == F.col("r")).select("node", "smallest", F.lit(True).alias("hit")), "linked")
    return store(classes.join(joined, classes["fp"] == joined["node"], "left")
                 .select("fp", F.when(F.col("hit"), F.col("smallest")).otherwise(F.col("least")).alias("component_id")), "classes")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` of every row.

    ``component_id`` is the smallest doc_id of the group, null if no row of
    the group has one.  Null and empty texts have fingerprint 0 and are
    linked like any other.  Repeated rows each give a row.  Other columns
    are ignored; an empty table gives no rows.
    """
    prints = store(fingerprints(docs, doc_id, text, shingle), "prints")
    classes = _classes(prints, distance).withColumnRenamed("fp", "class_fp")
    return prints.join(classes, prints["fp"] == classes["class_fp"]).select("doc_id", "text_hash", "fp", "component_id")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each group: that with the smallest doc_id (null last), with all its columns whatever their names.

    Of rows with that doc_id, one with the smallest text hash stays.
    """
    prints = store(fingerprints(docs, doc_id, text, shingle), "prints")
    classes = _classes(prints, distance).select(F.col("fp").alias("class_fp"), "component_id")
    member = prints.join(classes, prints["fp"] == classes["class_fp"])
    # rows without any doc_id in the group are told apart by their class
    group = [F.coalesce("component_id", F.col("fp")).alias("g"), F.col("component_id").isNull().alias("g_null")]
    pick = F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).alias("d"), F.col("text_hash").alias("t"))
    winners = store(member.groupBy(*group).agg(F.min(pick).alias("w"))
                    .select(F.col("w.z").alias("w_z"), F.col("w.d").alias("w_d"), F.col("w.t").alias("w_t")).distinct(), "winners")
    own = numbered(docs)
    id_ = F.col(number_of(docs, doc_id)).cast("long")
    keyed = own.withColumns({"z": id_.isNull(), "d": F.coalesce(id_, F.lit(0)), "t": F.xxhash64(F.col(number_of(docs, text)))})
    kept = keyed.join(winners, (F.col("z") == F.col("w_z")) & (F.col("d") == F.col("w_d")) & (F.col("t") == F.col("w_t")), "left_semi")
    # one of repeated rows; only rows that are repeated are grouped
    repeated = (prints.groupBy(F.col("doc_id").isNull().alias("r_z"), F.coalesce("doc_id", F.lit(0)).alias("r_d"),
                               F.col("text_hash").alias("r_t")).count().filter("count > 1").drop("count"))
    repeated = store(repeated, "repeated")
    if repeated.limit(1).count():
        again = (F.col("z") == F.col("r_z")) & (F.col("d") == F.col("r_d")) & (F.col("t") == F.col("r_t"))
        kept = kept.join(repeated, again, "left_anti").unionByName(kept.join(repeated, again, "left_semi").dropDuplicates(["z", "d", "t"]))
    return kept.select(*own.columns).toDF(*docs.columns)
