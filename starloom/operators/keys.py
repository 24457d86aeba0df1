"""Dense, deterministic surrogate keys at scale.

``row_number()`` over an unpartitioned window moves every row into one
task.  Instead the rows are range-partitioned and sorted on the ordering
columns, each row gets its position inside its partition, and that one
ordering is written to the shared folder.  A tiny table of per-partition
counts (one row per partition), taken from the written rows, turns
positions into global ids.  Positions and counts so come from one range
shuffle: planned twice, it would sample two sets of range bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.session import scratch_path

# monotonically_increasing_id(): partition id in the upper 31 bits, record
# number within the partition in the lower 33 bits (documented layout).
_LOCAL_BITS = 33


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str = "id", start: int | Column = 1,
              num_partitions: int | None = None) -> DataFrame:
    """Attach ids ``start, start+1, ...`` following the total order ``order``.

    ``order`` must be unique per row (e.g. the distinct key columns).
    ``start`` may be a literal or a scalar Column (e.g. current max id + 1)
    for incremental inserts.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select("*", F.shiftright(mid, _LOCAL_BITS).alias("__pid"),
                           mid.bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("__pos"))
    path = scratch_path(df.sparkSession, "dense_ids")
    tagged.write.parquet(path)
    tagged = df.sparkSession.read.schema(tagged.schema).parquet(path)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: the offset window is over n rows only
    offsets = counts.select("__pid", (F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    offsets = F.broadcast(offsets.fillna(0, subset=["__off"]))
    base = start if isinstance(start, Column) else F.lit(start)
    out = tagged.join(offsets, "__pid").withColumn(
        id_col, (base + F.col("__off") + F.col("__pos")).cast("bigint"))
    return out.drop("__pid", "__pos", "__off")


def next_start(existing: DataFrame, id_col: str = "id") -> Column:
    """Scalar subquery ``COALESCE(MAX(id), 0) + 1`` over an existing table."""
    return existing.select((F.coalesce(F.max(id_col), F.lit(0)) + 1).alias("s")).scalar()
