"""Hash-delta loading as a Structured Streaming job.

New files landing in a source folder are read as a stream; every
micro-batch is fingerprinted, de-duplicated on the fingerprint, filtered
against the fingerprints already stored (anti join on the hash column
only) and appended.  Re-running a micro-batch after a failure appends
nothing twice, because its rows are already stored, so the sink is
idempotent even though ``foreachBatch`` itself is at-least-once.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starloom.functions.hashing import row_hash
from starloom.operators import dedup
from starloom.session import checkpoint_root
from starloom.sources.files import append_table, path_exists


def _stored_hashes(spark: SparkSession, target: str, key: str) -> DataFrame | None:
    # no table yet: everything is new; any other failure to read stays one
    return spark.read.parquet(target).select(key) if path_exists(spark, target) else None


def delta_batch(spark: SparkSession, batch: DataFrame, target: str,
                hash_parts: Sequence[str | Column], key: str = "row_hash") -> DataFrame:
    """Rows of one batch that are not yet stored at ``target`` (deduplicated)."""
    hashed = batch.withColumn(key, row_hash(hash_parts))
    unique = dedup.keep_any(hashed, [key])
    stored = _stored_hashes(spark, target, key)
    return unique if stored is None else dedup.new_rows(unique, stored, key)


def start_delta_stream(spark: SparkSession, source: str, schema: StructType, target: str,
                       hash_parts: Sequence[str | Column], name: str = "delta_load",
                       transform: Callable[[DataFrame], DataFrame] | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Stream Parquet files from ``source`` into ``target`` by hash delta.

    The stream checkpoint lives below the shared checkpoint root, so a
    restarted driver resumes from the last committed micro-batch.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    if transform is not None:
        stream = transform(stream)

    def load(batch: DataFrame, epoch_id: int) -> None:
        append_table(delta_batch(spark, batch, target, hash_parts), target)

    writer = (stream.writeStream.foreachBatch(load)
              .option("checkpointLocation", os.path.join(checkpoint_root(spark), "streams", name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
