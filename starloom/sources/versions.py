"""Tables that are replaced as a whole, by a swap.

A table is a folder of versions, each a Parquet table of its own, and a log
of pointers: one small file for each swap, naming the version that counts
from then on.  A new version is written first and its pointer after it, so a
reader finds the old table or the new one, never half of either, and a swap
that fails leaves the old one in place.  Old versions are removed by the
next swaps; a reader that opened one has until then.

One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starloom.sources.files import list_folder, path_exists, remove_path

POINTER = "version long, folder string, schema string"


class VersionedTable:
    """A table at ``path`` with ``keep`` versions kept, the current one included."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        if keep < 1:
            raise ValueError("the current version is always kept")
        self.spark, self.path, self.keep = spark, path, keep

    def pointers(self) -> list[tuple[int, str, str]]:
        """Version, folder and schema of every swap that is still on record, oldest first."""
        if not path_exists(self.spark, f"{self.path}/pointers"):
            return []
        rows = self.spark.read.schema(POINTER).parquet(f"{self.path}/pointers").collect()  # a row for each swap
        return sorted(map(tuple, rows))

    def exists(self) -> bool:
        return bool(self.pointers())

    def _current(self) -> tuple[int, str, str]:
        known = self.pointers()
        if not known:
            raise FileNotFoundError(f"no version of {self.path}")
        return known[-1]

    def read(self) -> DataFrame:
        """The current version, fixed when this is called."""
        _, folder, schema = self._current()
        return self.spark.read.schema(StructType.fromDDL(schema)).parquet(f"{self.path}/{folder}")

    def read_beside(self, name: str) -> DataFrame:
        """A table that was written beside the current version."""
        return self.spark.read.parquet(f"{self.path}/{self._current()[1]}.{name}")

    def swap(self, df: DataFrame, partition_by: Sequence[str] = (), beside: Mapping[str, DataFrame] | None = None) -> int:
        """Write ``df`` as the next version, let it count, remove versions that no longer do; its number.

        ``df`` may read the current version.  Tables in ``beside`` change in
        the same moment.
        """
        known = self.pointers()
        version = known[-1][0] + 1 if known else 1
        folder = f"v{version}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/{folder}")
        for name, more in (beside or {}).items():
            more.write.mode("errorifexists").parquet(f"{self.path}/{folder}.{name}")
        row = [(version, folder, df.schema.toDDL())]
        self.spark.createDataFrame(row, POINTER).coalesce(1).write.mode("append").parquet(f"{self.path}/pointers")
        kept = {f for _, f, _ in [*known, *map(tuple, row)][-self.keep:]}
        for name in list_folder(self.spark, self.path):
            if name.startswith("v") and name.split(".")[0] not in kept:
                remove_path(self.spark, f"{self.path}/{name}")
        return version

    def append(self, df: DataFrame) -> None:
        """Add rows to the current version (``INSERT ... SELECT``); its columns stay. ``df`` may read it."""
        now = self.read()
        df.select(*now.columns).write.mode("append").parquet(f"{self.path}/{self._current()[1]}")
