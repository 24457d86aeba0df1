"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model is compiled into transducers over the tropical semiring: the
normaliser (white space to U+2581, a prefix mark), the pieces (a trie whose
final states write a piece's id) and byte fallback (a character without a
piece writes its bytes' ids).  A text composed with them is a lattice, and
its encoding is the lattice's shortest path.

Unigram models weigh a piece by its negative score.  Byte-pair models order
merges, which no sum of weights expresses; their machine has a further
transducer that remembers the last piece and gives infinite weight to a
neighbour with which it would have merged.  A path of finite weight is then
exactly what the merges leave, and each prefix has one.  Whether two pieces
may stand side by side is found by undoing the merges along their border,
latest first.

Many strings are composed at once: arcs and distances are arrays over all
positions of a batch.  Texts are cut where no piece reaches across, and the
paths of such chunks are remembered.
"""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import MEMO_BYTES, MEMO_ENTRY, bytes_of, held, pieces, small_batches

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
LONGEST = 400


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, raw[at:at + size]
        at += size


class Model:
    """Pieces and settings of a SentencePiece model file."""

    def __init__(self, raw: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.prefix, self.squeeze = UNIGRAM, True, True
        for field, value in _fields(raw):
            if field == 1:
                own = dict(_fields(value))
                self.pieces.append((own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                own = dict(_fields(value))
                if own.get(2):
                    raise ValueError("a model with a character map isn't supported; use one with the identity normaliser")
                self.prefix, self.squeeze = bool(own.get(3, 1)), bool(own.get(4, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")


class Table:
    """Integers by integer key, looked up for whole arrays; -1 where absent."""

    def __init__(self, entries: dict[int, int]):
        self.mask = (1 << max(4, (2 * len(entries)).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.full(self.mask + 1, -1, np.int64)
        self.probes = 1
        for k, v in entries.items():
            at, tries = int(self._slot(np.array([k], np.int64))[0]), 1
            while self.keys[at] >= 0:
                at, tries = (at + 1) & self.mask, tries + 1
            self.keys[at], self.values[at] = k, v
            self.probes = max(self.probes, tries)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.values[slot], -1)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        for step in range(1, self.probes):
            if not open_.size:
                break
            there = (slot[open_] + step) & self.mask
            hit = self.keys[there] == keys[open_]
            out[open_[hit]] = self.values[there[hit]]
            open_ = open_[~hit & (self.keys[there] >= 0)]
        return out


class Machine:
    """The compiled transducers of a model."""

    def __init__(self, raw: bytes):
        model = self.model = Model(raw)
        self.size = len(model.pieces)
        self.ids = {s: i for i, (s, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
        self.scores = np.array([s for _, s, _ in model.pieces])
        self.unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
        bytes_at = {int(s[3:5], 16): i for i, (s, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.byte_ids = [bytes_at[b] for b in range(256)] if len(bytes_at) == 256 else None
        self.is_byte = np.array([p[2] == BYTE for p in model.pieces])
        # a mark is a blank again; a byte is itself
        self.spelled = [bytes([int(s[3:5], 16)]) if kind == BYTE else " ⁇ ".encode() if kind == UNKNOWN
                        else b"" if kind == CONTROL else s.replace(MARK, " ").encode() for s, _, kind in model.pieces]
        letters = sorted(ord(s) for s in self.ids if len(s) == 1)
        if any(ord(c) not in set(letters) for c in {c for s in self.ids for c in s}):
            raise ValueError("a piece has a character that is no piece")
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.merges = model.kind == BPE
        usable = set(self.ids)
        if self.merges:
            usable = self._byte_pair()
        # chunks end where a mark follows another character, if no piece goes on across
        self.cuts = not any(MARK in s.lstrip(MARK) for s in self.ids)
        self.newline_alone = not any("\n" in s for s in self.ids)
        states: dict[int, int] = {}
        final = [-1]
        for s in usable:
            at = 0
            for c in s:
                key = at * self.width + int(self.classes[ord(c)])
                if key not in states:
                    states[key] = len(final)
                    final.append(-1)
                at = states[key]
            final[at] = self.ids[s]
        self.trie, self.final = Table(states), np.array(final, np.int64)
        self.longest_piece = max(map(len, usable))
        least = min((sc for _, sc, kind in model.pieces if kind in (NORMAL, USER)), default=0.0)
        self.weights = np.zeros(self.size) if self.merges else -self.scores
        self.weights[self.unknown] = 0.0 if self.merges else 10.0 - least
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.memo_size = 0

    def _byte_pair(self) -> set[str]:
        """Merge order, each piece's last merge and the pieces that merges reach."""
        tied: dict[float, int] = {}
        for s, i in self.ids.items():
            if len(s) > 1:
                tied[self.scores[i]] = tied.get(self.scores[i], 0) + 1
        # runs of marks share a score in some models: their merges go by place, not by rank
        self.by_place = {s for s, i in self.ids.items() if len(s) > 1 and tied[self.scores[i]] > 1}
        order = sorted((s for s in self.ids if len(s) > 1), key=lambda s: (-self.scores[self.ids[s]], self.ids[s]))
        self.rank = np.full(self.size, -1, np.int64)
        self.left, self.right = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        reached = {s for s in self.ids if len(s) == 1}
        pairs = {}
        for r, s in enumerate(order):
            found, last = self._merge(s)
            if found == [s]:
                i, a, b = self.ids[s], self.ids[last[0]], self.ids[last[1]]
                self.rank[i], self.left[i], self.right[i] = r, a, b
                pairs[a * self.size + b] = r
                reached.add(s)
        self.pairs = Table(pairs)
        self.known_pairs = np.full(1 << 20, -1, np.int64)  # key * 2 + verdict
        return reached

    def _merge(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain merging, best pair first and leftmost among equals; also the last merge."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, int]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(parts):
                whole = parts[i] + parts[j]
                if whole in self.ids:
                    heapq.heappush(heap, (-self.scores[self.ids[whole]], i, whole, j))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        last = None
        while heap:
            _, i, whole, j = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != whole:
                continue
            last = parts[i], parts[j]
            parts[i], parts[j] = whole, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None], last

    def _together(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces ``a`` and ``b`` stay side by side."""
        key = a * self.size + b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & (len(self.known_pairs) - 1)
        kept = self.known_pairs[slot]
        out = (kept & 1).astype(bool)
        miss = np.flatnonzero(kept >> 1 != key)
        if miss.size:
            fresh, back = np.unique(key[miss], return_inverse=True)
            verdict = self._border(fresh // self.size, fresh % self.size)
            out[miss] = verdict[back]
            self.known_pairs[slot[miss]] = key[miss] * 2 + out[miss]
        return out

    def _border(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        stays = np.ones(len(a), bool)
        live = np.arange(len(a))
        until = np.full(len(a), np.iinfo(np.int64).max)  # the border's pieces meet only before this rank
        while live.size:
            met = self.pairs.find(a * self.size + b)
            crossed = (met >= 0) & (met < until)
            stays[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            # undo the later merge; on its own rank, a merge further left comes first
            undo_a = ra > rb
            until = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return stays

    def _arcs(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and pieces of all arcs over the characters ``codes``; none reaches past ``ends``."""
        classes = self.classes[codes].astype(np.int64)
        odd = np.flatnonzero(classes == 0)
        found = [(odd, odd + 1, np.full(len(odd), self.unknown))]
        at, state = np.flatnonzero(classes > 0), np.zeros(int((classes > 0).sum()), np.int64)
        for length in range(1, self.longest_piece + 1):
            on = at + length <= ends[at]
            at, state = at[on], state[on]
            state = self.trie.find(state * self.width + classes[at + length - 1])
            on = state >= 0
            at, state = at[on], state[on]
            if not at.size:
                break
            piece = self.final[state]
            full = piece >= 0
            found.append((at[full], at[full] + length, piece[full]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def paths(self, chunks: list[str]) -> list[list[int]]:
        """The pieces of each chunk's shortest path."""
        sizes = np.array([len(c) for c in chunks], np.int64)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        of = np.repeat(np.arange(len(chunks)), sizes)
        first = np.cumsum(sizes) - sizes
        start, end, piece = self._arcs(codes, (first + sizes)[of])
        # a chunk of n characters has n + 1 nodes
        chunk = of[start]
        node_a, node_b = start + chunk, end + chunk
        step = end - first[chunk]
        order = np.lexsort((node_a, node_b, step))
        node_a, node_b, piece, step = node_a[order], node_b[order], piece[order], step[order]
        nodes = len(codes) + len(chunks)
        distance, last, back = np.full(nodes, np.inf), np.full(nodes, -1, np.int64), np.full(nodes, -1, np.int64)
        distance[first + np.arange(len(chunks))] = 0.0
        bounds = np.searchsorted(step, np.arange(1, int(sizes.max()) + 2)) if len(chunks) else []
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            a, b, p = node_a[lo:hi], node_b[lo:hi], piece[lo:hi]
            far = distance[a] + self.weights[p]
            if self.merges:
                held = np.flatnonzero(np.isfinite(far) & (last[a] >= 0) & (last[a] != self.unknown) & (p != self.unknown))
                apart = ~self._together(last[a[held]], p[held])
                far[held[apart]] = np.inf
            groups = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            least = np.minimum.reduceat(far, groups)
            best = np.flatnonzero(far == np.repeat(least, np.diff(np.append(groups, hi - lo))))
            best = best[np.concatenate(([True], b[best][1:] != b[best][:-1]))] if best.size else best
            distance[b[best]], last[b[best]], back[b[best]] = far[best], p[best], lo + best
        at = first + sizes + np.arange(len(chunks))
        if not np.isfinite(distance[at]).all():
            raise AssertionError("a chunk has no path")
        used = np.zeros(len(piece), bool)
        at = at[sizes > 0]
        while at.size:
            arc = back[at]
            used[arc] = True
            at = node_a[arc]
            at = at[back[at] >= 0]
        on = np.flatnonzero(used)
        on = on[np.argsort(node_a[on], kind="stable")]
        own = np.searchsorted((first + np.arange(len(chunks)))[1:], node_a[on], side="right") if len(chunks) > 1 else np.zeros(len(on), np.int64)
        flat, cut = piece[on].tolist(), np.searchsorted(own, np.arange(len(chunks) + 1)).tolist()
        return [flat[i:j] for i, j in zip(cut[:-1], cut[1:])]

    def _spell(self, chunk: str, path: list[int]) -> bytes:
        """A path's ids, with byte fallback for unknown characters."""
        if self.unknown in path and self.byte_ids:
            out, at = [], 0
            for p in path:
                if p == self.unknown:
                    out += [self.byte_ids[b] for b in chunk[at].encode("utf-8", "surrogatepass")]
                    at += 1
                else:
                    out.append(p)
                    at += len(self.model.pieces[p][0])
            path = out
        return np.array(path, "<i4").tobytes()

    def chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as little-endian 32-bit bytes."""
        plain = [i for i, c in enumerate(chunks) if not self.merges or len(c) <= LONGEST and not any(s in c for s in (self._ties if self._ties else ()))]
        out: list[bytes] = [b""] * len(chunks)
        for i, path in zip(plain, self.paths([chunks[i] for i in plain]) if plain else []):
            out[i] = self._spell(chunks[i], path)
        for i in set(range(len(chunks))) - set(plain):
            out[i] = self._spell(chunks[i], [self.ids.get(s, self.unknown) for s in self._merge(chunks[i])[0]])
        return out

    @property
    def _ties(self) -> list[str]:
        """The shortest pieces whose merges go by place; chunks with one are merged plainly."""
        if not hasattr(self, "_tie_list"):
            self._tie_list = [s for s in self.by_place if not any(o != s and o in s for o in self.by_place)]
        return self._tie_list

    def _chunks(self, raw: bytes) -> list[bytes]:
        """Cut a text where no piece reaches across.

        A chunk begins with its blanks; of a single blank, which most have,
        nothing is written, and a chunk without one begins with a line
        break.  The byte FF, which UTF-8 never has, stands before a chunk that
        is written in full.  ``_string`` gives a chunk's characters.
        """
        raw = raw.replace(MARK.encode(), b" ")
        if self.model.squeeze:
            raw = b" ".join(x for x in raw.split(b" ") if x)
        if not raw:
            return []
        if not self.cuts or not self.model.prefix or not self.newline_alone:
            return [b"\xff" + (b" " if self.model.prefix else b"") + raw]
        if not (raw[:1] == b" " or raw[-1:] == b" " or b"  " in raw or b" \n" in raw or b"\n" in raw[:1]):
            return raw.replace(b"\n", b" \n").split(b" ")
        found = re.findall(rb"\n[^ \n]*| *[^ \n]+| +", b" " + raw)
        return [x[1:] if x[:1] == b" " and len(x) > 1 and x[1:2] != b" " else x if x[:1] == b"\n" else b"\xff" + x for x in found]

    @staticmethod
    def _string(chunk: bytes) -> str:
        text = chunk[1:] if chunk[:1] == b"\xff" else chunk if chunk[:1] == b"\n" else b" " + chunk
        return text.decode("utf-8", "replace").replace(" ", MARK)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each UTF-8 text, as little-endian 32-bit bytes."""
        if 2 * self.memo_size > MEMO_BYTES:
            # chunks of the last half that turn up again are kept, the others go
            self.older, self.memo, self.memo_size = self.memo, {}, 0
        memo, older = self.memo, self.older
        cut = [self._chunks(x) for x in texts]
        new = list({c for x in cut for c in x if c not in memo})
        if older:
            again = {c: older[c] for c in new if c in older}
            memo.update(again)
            self.memo_size += sum(len(c) + len(x) + MEMO_ENTRY for c, x in again.items())
            new = [c for c in new if c not in again]
        if new:
            found = self.chunk_ids([self._string(c) for c in new])
            memo.update(zip(new, found))
            self.memo_size += sum(map(len, new)) + sum(map(len, found)) + MEMO_ENTRY * len(new)
        return [b"".join([memo[c] for c in x]) for x in cut]

    def decode(self, ids: list[int]) -> bytes:
        """The UTF-8 text of ids, without the blank that the prefix mark gave."""
        spelled = self.spelled
        out = b"".join([spelled[i] for i in ids])
        return out[1:] if self.model.prefix and out[:1] == b" " else out


def _machine(model) -> Machine:
    return held(("pieces", model), lambda: Machine(model.value))


def _shared(docs: DataFrame, model_file: str):
    small_batches(docs.sparkSession)
    with open(model_file, "rb") as f:
        raw = f.read()
    Model(raw)  # an unsupported model fails here
    return docs.sparkSession.sparkContext.broadcast(raw)


def encode(docs: DataFrame, model_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array of int) added, in place of one of that name.

    Null and empty texts have no ids.  White space and everything else are
    kept as the model's normaliser keeps them.
    """
    model = _shared(docs, model_file)
    rows = docs.drop(ids)
    at = rows.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces([batch], text):
                found = _machine(model).encode(bytes_of(part.column(at).cast(pa.binary())))
                yield part.append_column(pa.field(ids, pa.list_(pa.int32())), _lists(found))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def _lists(found: list[bytes]) -> pa.ListArray:
    flat = np.frombuffer(b"".join(found), "<i4")
    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found], dtype=np.int64)))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def decode(rows: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the column ``text`` decoded from ``ids`` added (null ids: empty), in place of one of that name."""
    model = _shared(rows, model_file)
    rows = rows.drop(text)
    at = rows.columns.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_machine(model).decode(x or []).decode("utf-8", "replace") for x in batch.column(at).to_pylist()]
            yield batch.append_column(pa.field(text, pa.string()), pa.array(found, pa.string()))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text, T.StringType())]))


def round_trip(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text and decode the ids again.

    ``doc_id, n_tokens, byte_tokens, ids, decoded_crc32, exact``: ids that
    stand for single bytes, the CRC-32 of the decoded text, and whether it
    is the text (with U+2581 as a blank, which the normaliser makes of it).
    """
    model = _shared(docs, model_file)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(model)
        for part in pieces(batches, "raw"):
            raw = bytes_of(part.column(1))
            found = machine.encode(raw)
            numbers = [np.frombuffer(x, "<i4") for x in found]
            back = [machine.decode(x.tolist()) for x in numbers]
            mark = MARK.encode()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) for x in numbers], pa.int64()), pa.array([int(machine.is_byte[x].sum()) for x in numbers], pa.int64()),
                 _lists(found), pa.array([zlib.crc32(x) for x in back], pa.int64()), pa.array([x == y.replace(mark, b" ") for x, y in zip(back, raw)], pa.bool_())],
                ["doc_id", "n_tokens", "byte_tokens", "ids", "decoded_crc32", "exact"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("raw"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, byte_tokens long, ids array<int>, decoded_crc32 long, exact boolean")
