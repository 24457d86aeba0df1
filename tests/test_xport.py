"""SAS transport landing: a file written from the customer table reads back
identically through the partitioned data source, and pandas' own transport
reader agrees."""

import math
import os
import struct

import pandas as pd

from starloom.session import scratch_path
from starloom.sources.xport import land_xport, local_path, register_xport
from tests.conftest import SMALL


def _ibm(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return b"." + bytes(7)
    if x == 0:
        return bytes(8)
    sign = 0x80 if x < 0 else 0
    x = abs(x)
    e = math.floor(math.log(x, 16)) + 1
    while x >= 16.0 ** e:
        e += 1
    while x < 16.0 ** (e - 1):
        e -= 1
    mant = int(round(x / 16.0 ** e * (1 << 56)))
    if mant >= 1 << 56:
        mant >>= 4
        e += 1
    return bytes([sign | (e + 64)]) + mant.to_bytes(7, "big")


def _pad(b):
    return b + b" " * (-len(b) % 80)


def write_xport(path, columns, rows):
    """columns: list of (name, 'num'|'char', length)."""
    hdr = lambda kind, digits="0" * 30: f"HEADER RECORD*******{kind:<8}HEADER RECORD!!!!!!!{digits}  ".encode()
    stamp = b"01JAN24:00:00:00"
    out = [hdr("LIBRARY "), _pad(b"SAS     SAS     SASLIB  6.06    bsd4.2" + b" " * 24 + stamp), _pad(stamp),
           hdr("MEMBER  ", "000000000000000001600000000140"), hdr("DSCRPTR "),
           _pad(b"SAS     CUSTOMERSASDATA 6.06    bsd4.2" + b" " * 24 + stamp), _pad(stamp),
           hdr("NAMESTR ", f"000000{len(columns):04d}" + "0" * 20)]
    names, pos = b"", 0
    for i, (name, kind, length) in enumerate(columns):
        d = struct.pack(">hhhh", 1 if kind == "num" else 2, 0, length, i + 1) + name.encode().ljust(8)
        d += b" " * 40 + b" " * 8 + struct.pack(">hhh", 0, 0, 0) + b"  " + b" " * 8 + struct.pack(">hh", 0, 0)
        d += struct.pack(">i", pos) + bytes(52)
        names += d
        pos += length
    out += [_pad(names), hdr("OBS     ")]
    data = b""
    for r in rows:
        for (name, kind, length), v in zip(columns, r):
            data += _ibm(v) if kind == "num" else (v or "").encode("latin-1").ljust(length)[:length]
    out.append(_pad(data))
    with open(path, "wb") as fh:
        fh.write(b"".join(out))


def test_xport_roundtrip(spark):
    cust = spark.read.parquet(f"{SMALL}/customer.parquet").orderBy("c_custkey")
    rows = [(float(r.c_custkey), r.c_name, float(r.c_nationkey), r.c_acctbal, r.c_mktsegment)
            for r in cust.collect()]
    rows.insert(5, (None, "", None, None, None))           # a row of missing values
    cols = [("CUSTKEY", "num", 8), ("NAME", "char", 20), ("NATION", "num", 8),
            ("ACCTBAL", "num", 8), ("SEGMENT", "char", 10)]
    folder = local_path(scratch_path(spark, "xport"))
    os.makedirs(folder)
    path = os.path.join(folder, "customer.xpt")
    write_xport(path, cols, rows)

    register_xport(spark)
    df = spark.read.format("xport").option("partitionBytes", 1000).load(path)
    got = [tuple(r) for r in df.collect()]
    assert [c for c, _, _ in cols] == df.columns
    assert len(got) == len(rows)
    for g, w in zip(got, rows):
        assert g[1] == (w[1] or "")
        for i in (0, 2, 3):
            assert (g[i] is None and w[i] is None) or abs(g[i] - w[i]) <= 1e-9 * max(1.0, abs(w[i]))

    ref = pd.read_sas(path, format="xport", encoding="latin-1")
    assert len(ref) == len(rows)
    assert ref["ACCTBAL"].fillna(-1).round(6).tolist() == [(-1 if r[3] is None else round(r[3], 6)) for r in rows]

    landed = land_xport(spark, path, scratch_path(spark, "xport_landed"))
    assert landed.count() == len(rows) and len(landed.columns) == len(cols)
