"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within each source and ranked there; the
fractional rank ``(rank + 1/2) / rows of the source`` spreads every source
evenly over (0, 1).  Sorting all rows by it and cutting into equal runs
gives shards whose sizes differ by at most one row and whose mixture of
sources is that of the whole.  DataFrame functions only.

Both rankings are exact and need no one-task sort.  Rows fall into buckets
of the sort key (the hash is uniform, so is the fractional rank), a small
table of bucket sizes gives each bucket's offset, and rows are numbered
inside their bucket.  A source with a third of all rows is spread over
``BUCKETS`` buckets like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import store, utf8

#: Buckets for each ranking: a hash prefix of three hexadecimal digits, and as many steps of the fractional rank.
BUCKETS = 4096


def _ranked(df: DataFrame, group: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """Add the 0-based rank within ``group`` by (``bucket``, ``order``)."""
    sizes = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(c).alias(f"__o_{c}") for c in [*group, bucket]],
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    same = F.lit(True)
    for c in [*group, bucket]:
        same = same & (F.col(c) == F.col(f"__o_{c}"))
    # without a group there is one row for each bucket
    joined = df.join(offsets if group else F.broadcast(offsets), same)
    within = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order))
    return joined.withColumn(name, F.col("__off") + within - 1).drop("__off", *[f"__o_{c}" for c in [*group, bucket]])


def interleave(docs: DataFrame, shards: int, seed: int = 17, source: str = "source", doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` of every row.

    ``size`` is the text's UTF-8 length plus 8 (a null text counts 8);
    ``slot`` numbers a shard's rows from 0 in interleaved order.  Rows
    without a source form a stratum of their own.  Ties of the hash (equal
    or null ids) fall to size and checksum; wholly equal rows are
    interchangeable.  Other columns are ignored, an empty table gives no
    rows, and with fewer rows than shards some shards are empty.
    """
    raw = utf8(text)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))).alias("key"))
    rows = rows.select("*", F.concat(F.col("source").isNull().cast("string"), F.coalesce("source", F.lit(""))).alias("stratum"),
                       F.conv(F.substring("key", 1, 3), 16, 10).cast("int").alias("b1"))
    tie = [F.col("key"), F.col("size"), F.col("text_crc32")]
    in_source = _ranked(rows, ["stratum"], "b1", tie, "rank").drop("b1")
    of_source = rows.groupBy(F.col("stratum").alias("s_stratum")).agg(F.count(F.lit(1)).alias("n_source"))
    # joined on the source and a salt, which splits a large source over tasks
    salts = 64
    salted = in_source.withColumn("salt", (F.col("rank") % salts).cast("int"))
    of_source = of_source.withColumn("s_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    placed = salted.join(of_source, (F.col("stratum") == F.col("s_stratum")) & (F.col("salt") == F.col("s_salt")))
    placed = placed.withColumn("frac", (F.col("rank") + F.lit(0.5)) / F.col("n_source"))
    placed = placed.withColumn("b2", F.floor(F.col("frac") * BUCKETS).cast("int"))
    placed = store(placed.select("doc_id", "source", "stratum", "size", "text_crc32", "key", "frac", "b2"), "interleave")
    total = placed.count()
    ordered = _ranked(placed, [], "b2", [F.col("frac"), F.col("stratum"), *tie], "place")
    exact = F.expr(f"int(place * {shards} div {max(total, 1)})")
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", exact).withColumn("slot", F.col("place") - first).select(
        "doc_id", "source", "size", "text_crc32", "shard", "slot")
