"""SAS transport (XPORT v5) files as a partitioned Spark data source.

The file layout is public: 80-byte header records, one 140-byte descriptor
("namestr") per variable, then fixed-width observations.  The driver reads
only the header (a few KB) to build the schema and to split the observation
area into byte ranges aligned to whole records; every task then decodes its
own range with numpy (IBM/370 floating point for numbers, fixed-width text
for characters) and hands Arrow batches to Spark.  The path must be on
storage every executor can read.

Usage::

    register_xport(spark)
    df = spark.read.format("xport").load("/shared/LLCP2024.XPT")
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

RECORD = 80
NAMESTR_LEN = 140
_MISSING_FIRST = set(b"._ABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass
class Variable:
    name: str
    numeric: bool
    length: int
    position: int


@dataclass
class Layout:
    variables: list[Variable]
    obs_start: int
    obs_length: int
    file_size: int


def local_path(path: str) -> str:
    """POSIX path of a ``file:`` URI (shared mounts are plain paths)."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def read_layout(path: str) -> Layout:
    """Parse the library/member headers and the variable descriptors."""
    with open(local_path(path), "rb") as fh:
        head = fh.read(RECORD * 3)
        if not head.startswith(b"HEADER RECORD*******LIBRARY HEADER RECORD"):
            raise ValueError(f"{path}: not a SAS transport file")
        pos = RECORD * 3
        fh.seek(pos)
        # member header: namestr length is in the last digits of the record
        member = fh.read(RECORD)
        if b"MEMBER  HEADER RECORD" not in member:
            raise ValueError(f"{path}: member header missing")
        namestr_len = int(member[74:78])
        pos += RECORD * 4          # member, descriptor header and two member-data records
        fh.seek(pos)
        nh = fh.read(RECORD)
        if b"NAMESTR HEADER RECORD" not in nh:
            raise ValueError(f"{path}: namestr header missing")
        nvars = int(nh[54:58])
        pos += RECORD
        fh.seek(pos)
        raw = fh.read(nvars * namestr_len)
        pos += -(-nvars * namestr_len // RECORD) * RECORD
        fh.seek(pos)
        obs = fh.read(RECORD)
        if b"OBS     HEADER RECORD" not in obs:
            raise ValueError(f"{path}: observation header missing (multi-member files are not supported)")
        fh.seek(0, 2)
        size = fh.tell()
    variables = []
    for i in range(nvars):
        d = raw[i * namestr_len:(i + 1) * namestr_len]
        ntype, _hfun, nlng, _varnum = struct.unpack(">hhhh", d[0:8])
        name = d[8:16].decode("latin-1").rstrip()
        npos = struct.unpack(">i", d[84:88])[0]
        variables.append(Variable(name, ntype == 1, nlng, npos))
    obs_length = sum(v.length for v in variables)
    return Layout(variables, pos + RECORD, obs_length, size)


def ibm_to_double(chunk: np.ndarray) -> np.ndarray:
    """Decode big-endian IBM/370 floats (rows x 8 bytes) to float64; the
    SAS missing-value codes become NaN."""
    v = chunk.view(">u8").ravel()
    sign = (v >> np.uint64(63)).astype(bool)
    expo = ((v >> np.uint64(56)) & np.uint64(0x7F)).astype(np.int64)
    mant = (v & np.uint64(0x00FFFFFFFFFFFFFF)).astype(np.float64)
    out = np.ldexp(mant, (4 * (expo - 64) - 56).astype(np.int32))
    out[sign] = -out[sign]
    first = chunk[:, 0]
    rest_zero = ~chunk[:, 1:].any(axis=1)
    missing = np.isin(first, list(_MISSING_FIRST)) & rest_zero
    out[missing] = np.nan
    return out


class _Range(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


def schema_of(layout: Layout) -> StructType:
    return StructType([StructField(v.name, DoubleType() if v.numeric else StringType()) for v in layout.variables])


def record_count(path: str, layout: Layout) -> int:
    """Observations in the file: blank padding in its last 80 bytes holds none, however the file is split."""
    n = (layout.file_size - layout.obs_start) // layout.obs_length
    tail = max(layout.obs_start, layout.file_size - RECORD)
    with open(local_path(path), "rb") as fh:
        fh.seek(tail)
        last = fh.read()
    blank_from = tail + len(last.rstrip(b" "))
    while n and layout.obs_start + (n - 1) * layout.obs_length >= blank_from:
        n -= 1
    return n


class XportReader(DataSourceReader):
    def __init__(self, path: str, layout: Layout, target_bytes: int, encoding: str):
        self.path, self.layout, self.target_bytes, self.encoding = path, layout, target_bytes, encoding

    def partitions(self):
        lay = self.layout
        nrec = record_count(self.path, lay)
        per = max(1, self.target_bytes // lay.obs_length)
        return [_Range(lay.obs_start + i * lay.obs_length,
                       lay.obs_start + min(nrec, i + per) * lay.obs_length)
                for i in range(0, max(nrec, 1), per)] if nrec else []

    def read(self, partition: _Range):
        lay = self.layout
        with open(local_path(self.path), "rb") as fh:
            fh.seek(partition.start)
            buf = fh.read(partition.end - partition.start)
        rows = np.frombuffer(buf, dtype=np.uint8).reshape(-1, lay.obs_length)
        cols = {}
        for v in lay.variables:
            field = rows[:, v.position:v.position + v.length]
            if v.numeric:
                full = np.zeros((len(rows), 8), dtype=np.uint8)
                full[:, :v.length] = field
                vals = ibm_to_double(full)
                cols[v.name] = pa.array(vals, mask=np.isnan(vals), type=pa.float64())
            else:
                # numpy drops the zero bytes at the end, the strip the blanks before them
                text = np.char.rstrip(np.ascontiguousarray(field).view(f"S{v.length}").ravel(), b" \x00")
                cols[v.name] = pa.array(np.char.decode(text, self.encoding).tolist(), type=pa.string())
        yield pa.RecordBatch.from_pydict(cols)


class XportDataSource(DataSource):
    """``spark.read.format("xport").option("partitionBytes", ...).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "xport"

    def _layout(self) -> Layout:
        return read_layout(self.options["path"])

    def schema(self):
        return schema_of(self._layout())

    def reader(self, schema):
        return XportReader(self.options["path"], self._layout(),
                           int(self.options.get("partitionBytes", 64 * 1024 * 1024)),
                           self.options.get("encoding", "latin-1"))


def register_xport(spark: SparkSession) -> None:
    spark.dataSource.register(XportDataSource)


def land_xport(spark: SparkSession, path: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Bulk landing job: transport file -> Parquet (or CSV with header), and
    the landed table back for row/column reporting."""
    register_xport(spark)
    df = spark.read.format("xport").load(path)
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.option("header", True).csv(out)
        return spark.read.option("header", True).csv(out)
    writer.parquet(out)
    return spark.read.parquet(out)
