"""File landing and table sinks.

CSV files are read with every column as text (no schema inference, which
would need an extra pass and can differ between file splits); typing
happens afterwards with explicit, NULL-on-failure casts.  Sinks are plain
DataFrame writes: task retries and atomic job commit come from Spark's
output committer, so no batch/retry loop is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv_text(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with all columns as strings.  With ``columns`` the header
    is still used for names, and a file missing one of them fails early."""
    reader = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns])) \
                       .option("enforceSchema", False)
    return reader.csv(path)


def _located(spark: SparkSession, path: str):
    """A path and the file system that its scheme names, as Spark's own readers see it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the store that its scheme names."""
    found, store = _located(spark, path)
    return store.exists(found)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    found, store = _located(spark, path)
    return sorted(x.getPath().getName() for x in store.listStatus(found))


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of change of every file of a table, as Spark's readers would list it (names with ``_`` or ``.`` first are left out)."""
    found, store = _located(spark, path)
    if not store.exists(found):
        return []
    out, todo = [], [store.getFileStatus(found)]
    while todo:
        status = todo.pop()
        if status.isDirectory():
            todo += [x for x in store.listStatus(status.getPath()) if not x.getPath().getName().startswith(("_", "."))]
        else:
            out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or a folder with all that is in it; whether it was there."""
    found, store = _located(spark, path)
    return store.delete(found, True)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with a header row and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh of a Parquet table (truncate-and-load)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Rows of a bucket: what a task holds to sort and to join one.
BUCKET_ROWS = 1 << 20


def bucket_count(*tables: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Buckets for tables that are joined by their buckets, of about ``rows`` rows each in the largest; scans are counted from the files' footers."""
    return max(least, -(-max(t.count() for t in tables) // rows))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a table in ``buckets`` files groups by the hash of ``key``, sorted by it, and read it from the catalogue.

    Tables of one key type and number of buckets join and group by the key
    where they lie.  Rows are dealt to the buckets before they are written,
    so a bucket is one file.  The layout is known by the table's name in the
    session's catalogue; the files are below ``path``.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table (``INSERT ... SELECT``)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
