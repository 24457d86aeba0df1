"""Token-id files in Simple-8b word-aligned coding.

A 64-bit word holds a 4-bit selector and 60 bits of data: as many ids as
fit at one width.  Ids of over 60 bits escape: a word with selector 0, then
the id's 64 bits.  A block holds whole documents with their lengths, its
words, where its escapes stand and how many ids of its part lie before it,
so that a block is decoded with array operations alone.

Files are Parquet tables of blocks, as Spark writes them to any store.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import MEMO_ENTRY, bytes_of, held, pieces, small_batches
from starloom.session import scratch_path

#: Ids in a word and bits for each, by selector from 1; selector 0 escapes. Fixed by the coding.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.uint64)
#: The largest id of each selector from 1.
LARGEST = (np.uint64(1) << WIDTHS[1:]) - np.uint64(1)
#: The first selector whose width holds an id, for ids of most vocabularies.
NEED = np.searchsorted(LARGEST, np.arange(1 << 18, dtype=np.uint64)).astype(np.uint8) + 1
HEAD = struct.Struct("<4sIQII")
TAG = b"S8B1"
#: Bytes, by estimate, of words that a Python worker remembers; a rare word costs ten times a known one.
MEMO_BYTES = 256 << 20
#: A block is closed when it has so many ids.
BLOCK_IDS = 1 << 15


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (unsigned 64-bit) as words, and the places of escaped words."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    # the first selector whose width holds each id; an id that none holds escapes
    small = n and ids.max() < len(NEED)
    need = NEED[ids.astype(np.int64)] if small else np.searchsorted(LARGEST, ids).astype(np.uint8) + 1
    # the widest need among as many ids as a selector takes, from each place on; the last word is filled up with zeros
    choice, span, widest = np.zeros(n, np.uint8), 1, np.concatenate((need, np.zeros(int(COUNTS.max()), np.uint8)))
    for s in range(len(COUNTS) - 1, 0, -1):
        more = int(COUNTS[s]) - span
        if more:
            widest = np.maximum(widest[:-more], widest[more:])
            span += more
        choice = np.where(widest[:n] <= s, np.uint8(s), choice)
    steps, at, starts = COUNTS.astype(np.uint8)[choice].tobytes(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    chosen = choice[starts]
    place = np.arange(len(starts)) + np.cumsum(chosen == 0) - (chosen == 0)  # an escape takes two words
    words = np.zeros(len(starts) + int((chosen == 0).sum()), np.uint64)
    padded = np.concatenate((ids, np.zeros(int(COUNTS.max()), np.uint64)))
    for s in np.unique(chosen).tolist():
        own = np.flatnonzero(chosen == s)
        if s == 0:
            words[place[own] + 1] = ids[starts[own]]
            continue
        each, word = starts[own], np.full(len(own), s << 60, np.uint64)
        for k in range(int(COUNTS[s])):
            word |= padded[each + k] << (np.uint64(k) * WIDTHS[s])
        words[place[own]] = word
    return words, place[chosen == 0].astype(np.uint32)


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of the words."""
    first = np.ones(len(words), bool)
    first[escapes.astype(np.int64) + 1] = False  # what follows an escape is an id as it is
    place = np.flatnonzero(first)
    selectors = (words[place] >> np.uint64(60)).astype(np.int64)
    selectors[np.isin(place, escapes)] = 0
    ends = np.cumsum(COUNTS[selectors])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(selectors).tolist():
        own = selectors == s
        starts = (ends - COUNTS[selectors])[own]
        if s == 0:
            out[starts] = words[place[own] + 1]
            continue
        shifts = np.arange(COUNTS[s]).astype(np.uint64) * WIDTHS[s]
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        out[starts[:, None] + np.arange(COUNTS[s])] = (words[place[own]][:, None] >> shifts) & mask
    return out[:n]


def to_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    words, escapes = pack(ids)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    names = np.array([x or 0 for x in doc_ids], "<i8")
    return b"".join((HEAD.pack(TAG, len(doc_ids), len(ids), len(words), len(escapes)), names.tobytes(), known.tobytes(),
                     np.array(lengths, "<u8").tobytes(), escapes.astype("<u4").tobytes(), words.astype("<u8").tobytes()))


def from_block(raw: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, their numbers of ids, all ids."""
    tag, docs, n, n_words, n_escapes = HEAD.unpack_from(raw)
    if tag != TAG:
        raise ValueError("not a block of token ids")
    at = HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    names, known, lengths = take("<i8", docs), take("<u1", docs), take("<u8", docs)
    escapes, words = take("<u4", n_escapes), take("<u8", n_words)
    return [x if k else None for x, k in zip(names.tolist(), known.tolist())], lengths.astype(np.int64), unpack(words, escapes, n)


#: Signs that end a word as a token of their own when only letters stand before them.
TAIL = b".,;:!?*$%#&|()-"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write for bytes: printable ones as they are, the others from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


#: Little-endian 32-bit bytes of so many ids.
_PACKED = [struct.Struct(f"<{n}I").pack for n in range(32)]


class WordIds(dict):
    """A tokenizer's ids by word, as little-endian 32-bit bytes.

    Where the tokenizer normalises by NFC and lower case and takes a run of
    letters as one unit, a word of lower-case letters goes straight to its
    model, which gives the same ids.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.size = 0
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenize = self.tokenizer.model.tokenize
        parts = json.loads(spec)
        steps = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
        units = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.plain = (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in units] == ["Split", "ByteLevel"]
                      and not units[1]["add_prefix_space"] and units[0]["pattern"].get("Regex", "").endswith("|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"))
        self.letters = _byte_letters()

    def __missing__(self, word: bytes) -> bytes:
        out = self.older.pop(word, None)
        if out is None:
            out = self._ids(word)
        self[word] = out
        self.size += len(word) + len(out) + MEMO_ENTRY
        return out

    def _ids(self, word: bytes) -> bytes:
        if self.plain:
            body = word.rstrip(TAIL)
            if body.isalpha() and body.islower():
                units = body.decode()
            else:
                text = body.decode()
                own = text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)
                units = body.decode("latin-1").translate(self.letters) if own else ""
            if units:
                if len(body) < len(word):
                    return self[body] + self[word[len(body):]]
                return self._packed([t.id for t in self.tokenize(units)])
        return self._packed(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return _PACKED[len(ids)](*ids) if len(ids) < len(_PACKED) else np.array(ids, "<u4").tobytes()

    def text(self, raw: bytes) -> bytes:
        """Ids of a whole text.

        The tokenizer drops white space and joins nothing across it, so a
        text's ids are its words' ids; lower-casing A-Z first changes none,
        except in its special tokens' names.
        """
        if 2 * self.size > MEMO_BYTES:
            # words of the last half that turn up again are kept, the others go
            self.older = dict(self)
            self.clear()
            self.size = 0
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))


def _words(spec) -> WordIds:
    return held(("token ids", spec), lambda: WordIds(spec.value))


def write(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
          partitions: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write the ids in ascending doc_id order (null first; ties by the text's hash).

    The tokenizer must drop white space between words, as
    ``word_bpe_49k.json`` does.  Null and empty texts have only the end id.
    Repeated rows are written each; other columns are ignored.  Ranges are
    cut by id and hash, so an id that a third of the rows share is several
    tasks' work.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw"), F.xxhash64(F.col(text)).alias("h"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id, or of none, may be many: the hash parts them
    ordered = rows.repartitionByRange(n, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "raw")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, block = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal before, block, names, ids, held
            flat = np.frombuffer(b"".join(ids), "<u4")
            raw = to_block(names, [len(x) // 4 for x in ids], flat)
            row = [part, block, before, len(flat), raw]
            before, block, names, ids, held = before + len(flat), block + 1, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "block", "before", "n_ids", "payload"])

        for batch in pieces(batches, "raw"):
            words = _words(spec)
            for name, raw in zip(batch.column(0).to_pylist(), bytes_of(batch.column(1))):
                names.append(name)
                ids.append(words.text(raw) + end)
                held += len(ids[-1]) // 4
                if held >= BLOCK_IDS:
                    yield close()
        if names:
            yield close()

    ordered.mapInArrow(run, "part long, block long, before long, n_ids long, payload binary").write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document of the files; ``start``: ids of all documents before it."""
    return _read(spark, path, "ids array<long>", lambda ids: ids.astype(np.int64).tolist(), pa.list_(pa.int64()))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the files."""
    out = _read(spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())
    return out.select("doc_id", "start", "n_tokens", "ids_crc32")


def _read(spark: SparkSession, path: str, column: str, value, kind: pa.DataType) -> DataFrame:
    small_batches(spark)
    blocks = spark.read.schema("part long, block long, before long, n_ids long, payload binary").parquet(path)
    # one row for each part that was written
    sizes = blocks.groupBy(F.col("part").alias("p")).agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select("p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_before"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                names, lengths, ids = from_block(raw)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(names), pa.int64()), pa.array(names, pa.int64()), pa.array(at + ends - lengths), pa.array(lengths),
                     pa.array([value(ids[e - k:e]) for e, k in zip(ends.tolist(), lengths.tolist())], kind)],
                    ["part", "doc_id", "at", "n_tokens", column.split()[0]])

    rows = blocks.select("part", "before", "payload").mapInArrow(run, f"part long, doc_id long, at long, n_tokens long, {column}")
    return (rows.join(F.broadcast(parts), F.col("part") == F.col("p"))
            .select("doc_id", (F.col("part_before") + F.col("at")).alias("start"), "n_tokens", column.split()[0]))


def round_trip(docs: DataFrame, tokenizer_file: str, **more) -> DataFrame:
    """Write the ids of ``docs`` below ``spark.checkpoint.dir`` and digest what the files hold."""
    path = scratch_path(docs.sparkSession, "token_ids")
    write(docs, tokenizer_file, path, **more)
    return digests(docs.sparkSession, path)
