"""Stored tables that a load touches only where it must: type-2 dimensions by key bucket, row hashes by prefix.

Both are Parquet tables partitioned by a value drawn from the key.  A batch
names its partitions, of which there is a fixed number; only those are read,
and a dimension's changed buckets are put in place of the old ones by
dynamic partition overwrite, whose new files are all written before the old
ones go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import dedup
from starloom.operators.scd import scd2_merge, scd2_versions
from starloom.sources.files import path_exists

BUCKET = "bucket"
PREFIX = "prefix"


class Scd2Store:
    """A type-2 dimension at ``path`` in ``buckets`` parts of its keys."""

    def __init__(self, spark: SparkSession, path: str, key: str, date_col: str, attrs: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.key, self.date_col, self.attrs, self.buckets = spark, path, key, date_col, list(attrs), buckets

    def _bucket(self):
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int")

    def _stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def build(self, states: DataFrame) -> None:
        """Write the dimension anew from dated states; states without a key are left out."""
        versions = scd2_versions(states.filter(F.col(self.key).isNotNull()), self.key, self.date_col, self.attrs)
        versions.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def apply(self, batch: DataFrame) -> list[int]:
        """Apply dated states as ``scd2_merge`` does; the buckets that were rewritten.

        Only buckets with a state that changes something are read in full
        and written: a state is compared with its key's current version
        first, so a batch that is applied again rewrites nothing.
        """
        states = batch.filter(F.col(self.key).isNotNull()).select(self.key, self.date_col, *self.attrs).withColumn(BUCKET, self._bucket())
        asked = [r[0] for r in states.select(BUCKET).distinct().collect()]  # at most self.buckets numbers
        current = self._stored().filter(F.col(BUCKET).isin(asked) & F.col("is_current")).select(F.col(self.key).alias("__key"), F.col("start_date").alias("__start"))
        later = states.join(current, F.col(self.key) == F.col("__key"), "left").filter(F.col("__key").isNull() | (F.col(self.date_col) > F.col("__start")))
        touched = sorted(r[0] for r in later.select(BUCKET).distinct().collect())
        if not touched:
            return []
        old = self._stored().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = scd2_merge(old, states.filter(F.col(BUCKET).isin(touched)).drop(BUCKET), self.key, self.date_col, self.attrs)
        (merged.withColumn(BUCKET, self._bucket()).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BUCKET).parquet(self.path))
        return touched


class HashIndex:
    """The row hashes of a table (hexadecimal text), by their first ``digits`` digits.

    Hashes are added after the rows are: where a load failed between the
    two, add the table's own hashes again before the next one.
    """

    def __init__(self, spark: SparkSession, path: str, digits: int = 2, key: str = "row_hash"):
        self.spark, self.path, self.digits, self.key = spark, path, digits, key

    def _prefix(self):
        return F.substring(F.col(self.key), 1, self.digits)

    def candidates(self, batch: DataFrame) -> DataFrame | None:
        """Stored hashes that share a prefix with one of ``batch``; None without any index yet."""
        if not path_exists(self.spark, self.path):
            return None
        asked = [r[0] for r in batch.select(self._prefix().alias(PREFIX)).distinct().collect()]  # at most 16 ** digits texts
        stored = self.spark.read.schema(f"{self.key} string, {PREFIX} string").parquet(self.path)
        return stored.filter(F.col(PREFIX).isin(asked)).select(self.key)

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` whose hash isn't stored; only the batch's prefixes are read."""
        stored = self.candidates(batch)
        return batch if stored is None else dedup.new_rows(batch, stored, self.key)

    def add(self, rows: DataFrame) -> None:
        """Store the hashes of rows that were loaded. Adding one twice does no harm."""
        rows.select(self.key, self._prefix().alias(PREFIX)).repartition(PREFIX).write.mode("append").partitionBy(PREFIX).parquet(self.path)
