"""Materialised aggregates kept up to date incrementally.

Only re-aggregable measures (sums and counts) are stored.  A refresh
aggregates the delta alone, unions it with the stored partial aggregates
and re-aggregates by key: work is proportional to the delta plus the
(small) aggregate, never to the full history.  Each refresh is written to a
new folder below the shared checkpoint root; the previous version stays
readable until the caller switches to the new path.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.sources.files import data_files
from starloom.sources.versions import VersionedTable


@dataclass
class MaterializedAggregate:
    keys: Sequence[str]
    sums: Mapping[str, Column]          # stored measure -> per-row expression to sum
    count_col: str = "record_count"     # COUNT_BIG(*)

    def aggregate(self, df: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias(self.count_col)]
        aggs += [F.sum(e).alias(n) for n, e in self.sums.items()]
        return df.groupBy(*self.keys).agg(*aggs)

    def merge(self, stored: DataFrame, delta: DataFrame) -> DataFrame:
        part = self.aggregate(delta)
        both = stored.unionByName(part)
        aggs = [F.sum(self.count_col).alias(self.count_col)]
        aggs += [F.sum(n).alias(n) for n in self.sums]
        return both.groupBy(*self.keys).agg(*aggs)

    def build(self, spark: SparkSession, df: DataFrame, name: str = "matview") -> str:
        path = scratch_path(spark, name)
        self.aggregate(df).write.mode("errorifexists").parquet(path)
        return path

    def refresh(self, spark: SparkSession, path: str, delta: DataFrame, name: str = "matview") -> str:
        new_path = scratch_path(spark, name)
        self.merge(spark.read.parquet(path), delta).write.mode("errorifexists").parquet(new_path)
        return new_path


MANIFEST = "path string, length long, changed long"


class ManifestView:
    """A stored aggregate of an append-only table that knows which of its files it holds.

    The manifest (one row for each file added) is written beside the view
    and swapped with it, so a file is never counted twice or missed, whatever
    fails in between.  A refresh reads the files that are new and the stored
    view; if none is new it reads and writes nothing.  A file that was
    changed or removed makes the next refresh start anew.
    """

    def __init__(self, spark: SparkSession, path: str, aggregate: MaterializedAggregate, source: str, rows: Callable[[DataFrame], DataFrame] = lambda df: df):
        self.spark, self.aggregate, self.source, self.rows = spark, aggregate, source, rows
        self.table = VersionedTable(spark, path)

    def refresh(self) -> int:
        """Bring the view up to date; how many files were read for that."""
        now = data_files(self.spark, self.source)
        if not now:
            raise FileNotFoundError(f"no files in {self.source}")
        manifest = self.spark.createDataFrame(now, MANIFEST)
        stored = self.table.exists()
        if stored:
            held = {tuple(r) for r in self.table.read_beside("manifest").collect()}  # file names, as the driver lists them anyway
            if held == set(now):
                return 0
            stored = held <= set(now)
        new = [f for f in now if f not in held] if stored else now
        delta = self.rows(self._files([path for path, _, _ in new]))
        view = self.aggregate.merge(self.table.read(), delta) if stored else self.aggregate.aggregate(delta)
        self.table.swap(view, beside={"manifest": manifest})
        return len(new)

    def _files(self, paths: list[str]) -> DataFrame:
        """Some files of the source, with the source's schema and partition columns."""
        reader = self.spark.read.schema(self.spark.read.parquet(self.source).schema)
        if not paths[0].endswith(self.source.rstrip("/").rpartition("/")[2]):  # the source is a folder
            reader = reader.option("basePath", self.source)
        return reader.parquet(*paths)

    def read(self) -> DataFrame:
        """The stored view as of the last refresh."""
        return self.table.read()
