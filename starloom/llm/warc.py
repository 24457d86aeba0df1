"""WARC archives: writing with revisit records, and reading by boundary chains.

Writing.  Spark's text writer joins records with the blank lines that end a
WARC record, so every part file is a plain WARC file that any store Spark
writes to can hold.  Pages with equal payloads get one response record; the
others revisit it.

Reading.  Spark's text reader splits the files at the record magic, so a
file of any size is read in parts by many tasks.  The magic may also stand
in a payload, so a place where it stands is only a candidate.  Each task
emits its candidates with the offset of the successor that their header
claims, and shortens the chains within its part.  Pointer jumping over
parts, from each file's start, finds where the chain of real records enters
each part, and only records on that chain are kept.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, store
from starloom.session import scratch_path

MAGIC = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(raw: Column) -> Column:
    """A binary column's SHA-1 in bare upper-case base32 (five hexadecimal digits make four characters)."""
    digits = F.sha1(raw)
    chars = []
    for k in range(0, 40, 5):
        twenty = F.conv(F.substring(digits, k + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(BASE32), F.shiftright(twenty, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def classify(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, record_type, refers_to`` of every page.

    Of pages with equal payloads of ``least`` bytes or more, those with the
    largest page_id are responses and the others revisit it; pages with
    smaller payloads are responses, and so are all of a group without any
    page_id.  A null html is empty.
    """
    text = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text.alias("html"),
                        F.octet_length(text).cast("long").alias("payload_bytes"), F.sha1(text.cast("binary")).alias("sha1"))
    shared = (rows.filter(F.col("payload_bytes") >= least).groupBy("sha1", "payload_bytes")
              .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    shared = store(shared.select(F.col("sha1").alias("s"), F.col("payload_bytes").alias("b"), "last"), "payloads")
    joined = rows.join(shared, (F.col("sha1") == F.col("s")) & (F.col("payload_bytes") == F.col("b")), "left")
    again = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", "payload_bytes", base32_sha1(F.col("html").cast("binary")).alias("payload_digest"),
                         F.when(again, "revisit").otherwise("response").alias("record_type"),
                         F.when(again, F.col("last")).alias("refers_to"))


def write(classified: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write the rows of ``classify`` as WARC files below ``path``. A revisit record holds no payload."""
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    response = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.when(response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(response, F.col("html")).otherwise(F.lit("")))
    # a line break in a URL would start a header of its own
    uri = F.regexp_replace("url", "[\\r\\n]+", " ")
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit(MAGIC.decode()), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name("page_id")), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(response, F.lit("")).otherwise(F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", name("refers_to")))),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    classified.select(record.alias("value")).write.option("lineSep", END.decode()).text(path)


def _parse(after: bytes) -> dict | None:
    """The record whose magic stands before ``after``: fields, its length without the magic, whether ``after`` is all of it."""
    stop = after.find(END)
    if stop < 0:
        return None
    head = {}
    for h in after[:stop].split(b"\r\n"):
        key, colon, value = h.partition(b":")
        if not colon:
            return None
        head[key.strip().lower()] = value.strip()
    size = head.get(b"content-length", b"")
    if not size.isdigit():
        return None
    length = stop + len(END) + int(size) + len(END)
    out = {"length": length, "complete": len(after) == length and after.endswith(END), "record_type": head.get(b"warc-type", b"").decode("utf-8", "replace"),
           "page_id": _page(head.get(b"warc-record-id")), "refers_to": _page(head.get(b"warc-refers-to")),
           "uri": head[b"warc-target-uri"].decode("utf-8", "replace") if b"warc-target-uri" in head else None}
    if out["complete"]:
        body = after[stop + len(END):-len(END)]
        start = body.find(END)
        payload = body[start + len(END):] if start >= 0 else body
        if out["record_type"] == "revisit":  # both of the payload that it refers to
            said = head.get(b"x-payload-length", b"")
            out["payload_bytes"] = int(said) if said.isdigit() else None
            out["payload_digest"] = head.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:")
        else:
            out["payload_bytes"], out["payload_digest"] = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return out


def _page(name: bytes | None) -> int | None:
    digits = (name or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(digits) if digits.removeprefix(b"-").isdigit() else None


FIELDS = [("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("uri", pa.string()),
          ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
FIELDS_DDL = "record_type string, page_id long, refers_to long, uri string, payload_bytes long, payload_digest string"
LINES = pa.schema([("file", pa.string()), ("part", pa.int64()), ("at", pa.int64()), ("next", pa.int64()), ("exit", pa.int64()),
                   ("total", pa.int64()), ("complete", pa.bool_()), *FIELDS])
LINES_DDL = f"file string, part long, at long, next long, exit long, total long, complete boolean, {FIELDS_DDL}"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    small_batches(spark)
    return (spark.read.schema("value string").option("lineSep", MAGIC.decode()).text(path)
            .select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("part")))


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """``file, part, at, value``; ``at``: where the value's magic stands, counted from the part's first value."""
    now, at = None, 0
    for batch in batches:
        for value, file, part in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, part) != now:
                now, at = (file, part), 0
            yield file, part, at - len(MAGIC), value
            at += len(value) + len(MAGIC)


def _candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    now, total = None, 0

    def done() -> pa.RecordBatch:
        place = {r["at"]: r for r in rows}
        for r in reversed(rows):  # a successor lies behind its record
            r["total"] = total
            step = r.get("next")
            if step is not None:
                r["exit"] = step if step >= total - len(MAGIC) else place.get(step, {}).get("exit")
        return pa.RecordBatch.from_pylist(rows, LINES)

    for file, part, at, value in _parts(batches):
        if now is not None and (file, part) != now:
            yield done()
            rows = []
        now, total = (file, part), at + 2 * len(MAGIC) + len(value)
        found = _parse(value) or {"complete": False, "length": None}
        length = found.pop("length")
        rows.append({"file": file, "part": part, "at": at, "next": None if length is None else at + len(MAGIC) + length, **found})
    if rows:
        yield done()


def _on_chain(group: pa.Table) -> pa.Table:
    """Mark the records of one part that the chain from its entry visits."""
    follow = dict(zip(group["at"].to_pylist(), group["next"].to_pylist()))
    at, seen = group["entry"][0].as_py(), set()
    while at is not None and at in follow and at not in seen:
        seen.add(at)
        at = follow[at]
    real = pa.array([x in seen for x in group["at"].to_pylist()])
    return group.drop_columns(["entry"]).append_column("real", real)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files below ``path``.

    Columns: ``file, offset, record_type, page_id, refers_to, uri,
    payload_bytes, payload_digest``; payload figures are taken from the
    bytes read, for revisits from the header.  The magic within a payload
    starts no record.  A chain that breaks (a damaged file) ends there.  No
    files give no rows.
    """
    lines = store(_lines(spark, path).mapInArrow(_candidates, LINES_DDL), "warc_lines")
    before = Window.partitionBy("b_file").orderBy("b_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (lines.select(F.col("file").alias("b_file"), F.col("part").alias("b_part"), "total").distinct()
            .select("b_file", "b_part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))
    base = store(base, "warc_parts")
    placed = lines.join(base, (F.col("file") == F.col("b_file")) & (F.col("part") == F.col("b_part"))).drop("b_file", "b_part")
    placed = placed.withColumn("offset", F.col("base") + F.col("at")).filter("offset >= 0")  # nothing stands before a file's first magic

    # pointer jumping over parts: the places where chains from the files' starts enter a part
    entries = placed.filter("offset = 0").select("file", "offset").distinct()
    jump = store(placed.filter("exit is not null").select("file", "offset", (F.col("base") + F.col("exit")).alias("to")), "warc_jumps")
    while True:
        hop = entries.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        entries = store(entries.union(hop).distinct(), "warc_entries")
        then = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("far"))
        jump = store(jump.join(then, ["file", "to"]).select("file", "offset", F.col("far").alias("to")), "warc_jumps")
        if not jump.limit(1).count():
            break
    start = (placed.join(entries, ["file", "offset"]).groupBy(F.col("file").alias("e_file"), F.col("part").alias("e_part"))
             .agg(F.min("at").alias("entry")))
    start = store(start, "warc_starts")
    columns = ["file", "part", "at", "next", "complete", "base", *[n for n, _ in FIELDS]]
    with_entry = placed.join(start, (F.col("file") == F.col("e_file")) & (F.col("part") == F.col("e_part")), "left").select(*columns, "entry")
    marked = store(with_entry.groupBy("file", "part").applyInArrow(
        _on_chain, f"file string, part long, at long, next long, complete boolean, base long, {FIELDS_DDL}, real boolean"), "warc_records")
    fields = ["file", (F.col("base") + F.col("at")).alias("offset"), *[n for n, _ in FIELDS]]
    whole = marked.filter("real and complete").select(*fields)
    cut = marked.filter("real and not complete")
    return whole.unionByName(_joined(spark, path, marked)) if cut.limit(1).count() else whole


def _joined(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    """Records whose payload holds the magic: their pieces, read again and joined."""
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    few = marked.filter("not (real and complete)").withColumn("offset", F.col("base") + F.col("at"))
    last = F.last(F.when(F.col("real"), F.struct("offset", (F.col("base") + F.col("next")).alias("stop"))), ignorenulls=True)
    owned = few.withColumn("of", last.over(order)).filter("offset < of.stop")
    want = store(owned.select(F.col("file").alias("w_file"), F.col("part").alias("w_part"), F.col("at").alias("w_at"), "offset",
                              F.col("of.offset").alias("record")), "warc_pieces")

    def values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, part, at, value in _parts(batches):
            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([part]), pa.array([at]), pa.array([value], pa.binary())], ["file", "part", "at", "value"])

    again = _lines(spark, path).mapInArrow(values, "file string, part long, at long, value binary")
    parts = again.join(want, (F.col("file") == F.col("w_file")) & (F.col("part") == F.col("w_part")) & (F.col("at") == F.col("w_at")))

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("offset")
        found = _parse(MAGIC.join(group["value"].to_pylist())) or {}
        names = ["file", "offset", *[n for n, _ in FIELDS]]
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), *FIELDS])
        row = {"file": group["file"][0].as_py(), "offset": group["record"][0].as_py(), **{n: found.get(n) for n, _ in FIELDS}}
        return pa.Table.from_pylist([row] if found.get("complete") else [], schema).select(names)

    return parts.select("file", "offset", "record", "value").groupBy("file", "record").applyInArrow(join, f"file string, offset long, {FIELDS_DDL}")


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write ``pages`` to archives below ``spark.checkpoint.dir`` and read them back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(classify(pages, **names), path)
    return read(spark, path)
