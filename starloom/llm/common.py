"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import scratch_path
from starloom.sources.tables import read_table

#: Bytes, by estimate, of words or chunks that an operator remembers in a Python worker; beyond, it starts anew.
MEMO_BYTES = 96 << 20
#: What a remembered word takes beside its own bytes and its result's: two objects and a dictionary's entry.
MEMO_ENTRY = 220

#: Rows per Arrow batch sent to a Python worker. Long texts make Spark's default of 10,000 too heavy.
ARROW_ROWS = 512


_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept in this Python worker for ``key``.

    Workers outlive stages.  One keeps the state of one operator: asking
    for another drops it, so the stages of a job don't add up.
    """
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = make()
    return _HELD[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` where it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named ``c0, c1, ...``, so that an operator's own columns clash with none; ``toDF`` names them back."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def number_of(df: DataFrame, column: str) -> str:
    """The name that ``numbered`` gives a column."""
    return f"c{df.columns.index(column)}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir`` and read it back (cuts the lineage)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(col: str | Column) -> Column:
    """The UTF-8 bytes of a text column, as Python workers and byte counts want them."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """A binary Arrow column as Python bytes, null as empty."""
    return [x or b"" for x in column.to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one piece holds about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        start, size = 0, 0
        sizes = pa.compute.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_pylist()
        for i, n in enumerate(sizes):
            if size and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
