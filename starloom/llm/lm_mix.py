"""Language-model scores by online logistic mixing of hashed-context predictors.

A lower-cased text is a row of units: a word (or nothing) and the white
space character or the end behind it.  Units are spelled in bits by a prefix
code built from the corpus' byte counts.  Four predictors give log odds for
the next bit, from what the training texts held at the same place in the
code after, hashed, the last byte, the last two, the last three, and the
whole unit so far; contexts begin with the unit.  The log odds, in steps of
``STEP``, are added up with weights; which set of weights is used depends on
how often the unit so far was seen (the gate).  The sum is refined by a map
from its size to a correction.  Weights and map belong to the text: they
begin as constants, and after every ``BEAT`` units move along the gradient
of these units' coding cost.  The sum of costs is the text's total bits.

Since contexts begin with the unit, a unit's log odds are the same wherever
it stands, and a text's odds are looked up once for each distinct unit.

Texts are cut once, in chunks of some megabytes, into their distinct units
and a row of their numbers; all else works on these.  The tables of the
first three predictors have a fixed number of slots.  The last predictor and
the word counts grow with the corpus: its units are held in ranges, a chunk
asks each range for its units, and gets back a byte for each bit.  What
follows a beginning that two ranges share is counted over all.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from starloom.llm.common import bytes_of, held, pieces, small_batches, store

#: Ends a text; UTF-8 has no such byte.
END = 0xFF
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32, END]] = True
#: Slots of the first three predictors' tables, as powers of two, and where each table begins.
SLOT_BITS = (16, 18, 20)
TABLES = np.cumsum([0, *(1 << b for b in SLOT_BITS)])
ORDERS = len(SLOT_BITS) + 1
#: Log odds are whole multiples of STEP, MOST at the most; this code means that nothing was seen.
STEP, MOST, UNSEEN = 0.2, 63, 255
#: Counts of the unit so far that part the gates.
SEEN = (1, 30)
GATES = len(SEEN) + 1
#: First weights by gate, learning rate of the weights; cells of the map and its rate; units after which both move.
WEIGHTS = ((0.0, 0.1, 0.8, 0.0), (0.0, 0.1, 0.3, 0.6), (0.0, 0.0, 0.1, 0.9))
RATE = 0.006
CELLS, MAP_RATE = 12, 0.006
BEAT = 4
#: Sums beyond this are taken for it.
FAR = 16.0
#: Texts mixed side by side, bits hashed together, symbols worked on at once, and slots in one row of counts.
LANES = 256
NEAR = 1 << 14
PIECE = 2 << 20
BLOCK = 1 << 14
#: Bytes of text in a chunk, ranges of units at least, distinct units in a range, units drawn for each range to find
#: its ends (they only balance), units asked of one group of a range, and units looked up together.
CHUNK = 16 << 20
RANGES = 16
RANGE_UNITS = 50_000
DRAWN = 40
ASKED_UNITS = 300_000
TOGETHER = 20_000
#: Bits of a context's hash.
HASHED = 48


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    """Rows that don't teach: crc32 of the id's text mod ``parts`` is ``part``. A row without an id doesn't teach either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


class Code:
    """A prefix code of the 256 symbols: for each, the inner nodes on its path and the bits taken there."""

    def __init__(self, counts: list[int]):
        heap = [(n + 1, s, s) for s, n in enumerate(counts)]  # each symbol has a code, seen or not
        heapq.heapify(heap)
        above: dict[int, tuple[int, int]] = {}
        following = len(counts)
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            above[x], above[y] = (following, 0), (following, 1)
            heapq.heappush(heap, (a + b, following, following))
            following += 1
        nodes, bits, self.sizes = [], [], np.zeros(len(counts), np.int64)
        for s in range(len(counts)):
            path, at = [], s
            while at in above:
                path.append(above[at])
                at = above[at][0]
            nodes += [n - len(counts) for n, _ in reversed(path)]
            bits += [b for _, b in reversed(path)]
            self.sizes[s] = len(path)
        self.nodes, self.bits = np.array(nodes, np.int64), np.array(bits, np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def spell(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each bit: its symbol's place, its node and itself."""
        sizes = self.sizes[symbols]
        place = np.repeat(np.arange(len(symbols)), sizes)
        at = np.arange(len(place)) + np.repeat(self.starts[symbols] - np.cumsum(sizes) + sizes, sizes)
        return place, self.nodes[at], self.bits[at]


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _prefixes(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes (mod 2^64) of each unit up to a symbol (without it), and of whole units."""
    n = len(symbols)
    # summed over all and scaled back to the unit's start
    summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * _powers(_BACK, n))))
    up = _powers(_ODD, n + 1)
    before = (summed[:-1] - np.repeat(summed[starts], sizes)) * up[:-1]
    ends = starts + sizes
    # scaled by the unit's size, so that equal units are equal wherever they stand
    return before, (summed[ends] - summed[starts]) * up[ends]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``sizes`` numbers from each of ``starts`` on."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _contexts(symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each symbol, the hash of its unit so far, of ``HASHED`` bits."""
    found = _prefixes(symbols, np.cumsum(sizes) - sizes, sizes)[0]
    found ^= found >> np.uint64(29)
    found *= _ODD
    return found >> np.uint64(64 - HASHED)


def _together(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Rows of at least ``least`` bytes together; the last may be fewer."""
    parts, size = [], 0
    for part in pieces(batches, "raw"):
        parts.append(part)
        size += part.nbytes
        if size >= least:
            yield pa.Table.from_batches(parts)
            parts, size = [], 0
    if parts:
        yield pa.Table.from_batches(parts)


def _added_up(context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal (context, symbol), ordered by both."""
    order = np.lexsort((symbol, context))
    context, symbol, n = context[order], symbol[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(n), 1), bool), (context[1:] != context[:-1]) | (symbol[1:] != symbol[:-1]))))
    return context[first], symbol[first], np.add.reduceat(n, first) if len(n) else n


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte, compressed."""
    return zlib.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes(), 1)


def _numbers(squeezed: bytes, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(squeezed), np.uint8).reshape(wide, -1).T).view(kind).ravel()


def _flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a binary column without nulls, and each value's size."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.uint8), np.array([len(x) for x in raw], np.int64)


def _binary(raw: bytes, sizes: np.ndarray) -> pa.Array:
    """The values that lie behind one another in ``raw`` as an Arrow column."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to about ``most``, one at least."""
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
        yield lo, hi
        lo = hi


def units(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct units of the lower-cased texts in order, which of them each unit is, and each text's number of units."""
    joined = b"".join([x.lower() + b"\xff" for x in texts])
    symbols = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(BLANK[symbols]) + 1
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    sizes = ends - starts
    hashes, firsts, whiches = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
    total = 0
    for lo, hi in _parts(sizes, PIECE):
        own = symbols[starts[lo]:ends[hi - 1]]
        _, whole = _prefixes(own, starts[lo:hi] - starts[lo], sizes[lo:hi])
        found, first, which = np.unique(whole, return_index=True, return_inverse=True)
        hashes.append(found)
        firsts.append(first + lo)
        whiches.append(which + total)
        total += len(found)
    _, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    unit = np.concatenate(firsts)[first]
    found = [joined[a:b] for a, b in zip(starts[unit].tolist(), ends[unit].tolist())]
    order = sorted(range(len(found)), key=found.__getitem__)
    rank = np.empty(len(found), np.int32)
    rank[order] = np.arange(len(found), dtype=np.int32)
    every = rank[which][np.concatenate(whiches)] if whiches else np.zeros(0, np.int32)
    last = np.flatnonzero(symbols[ends - 1] == END) + 1
    return [found[i] for i in order], every, np.diff(last, prepend=0)


def slots(symbols: np.ndarray, sizes: np.ndarray, place: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The slot of each bit in each of the first three predictors' tables (bits, predictors)."""
    starts = np.cumsum(sizes) - sizes
    depth = np.arange(len(symbols)) - np.repeat(starts, sizes)
    known = symbols.astype(np.uint64) + np.uint64(1)
    last = []
    for k in (1, 2, 3):
        shifted = np.zeros(len(known), np.uint64)
        shifted[k:] = known[:-k or None][:max(len(known) - k, 0)]
        last.append(np.where(depth >= k, shifted, np.uint64(0)))
    two = last[0] * np.uint64(300) + last[1]
    contexts = (last[0], two * _ODD, (two * np.uint64(300) + last[2] + np.uint64(7)) * _ODD)
    step = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out = np.empty((len(place), len(SLOT_BITS)), np.int32)
    for lo in range(0, len(place), NEAR):  # few enough at once to stay near the processor
        these, steps = place[lo:lo + NEAR], step[node[lo:lo + NEAR]]
        for i, (context, bits) in enumerate(zip(contexts, SLOT_BITS)):
            mixed = context.take(these)
            mixed += steps
            mixed ^= mixed >> np.uint64(29)
            mixed *= _ODD
            mixed >>= np.uint64(64 - bits)
            mixed += np.uint64(TABLES[i])
            out[lo:lo + NEAR, i] = mixed
    return out


def steps_of(counts: np.ndarray) -> np.ndarray:
    """The log odds of (zeros, ones), in steps."""
    odds = np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4))
    return np.clip(np.rint(odds / STEP), -MOST, MOST).astype(np.int8)


def coded(steps: np.ndarray, bit: np.ndarray, often: np.ndarray | int = 0) -> np.ndarray:
    """A byte for each bit: the log odds towards the bit that comes, and whether the context was seen often."""
    return ((np.where(bit, steps, -steps) + MOST) * 2 + often).astype(np.uint8)


def _decoded() -> tuple[np.ndarray, np.ndarray]:
    """Log odds and gate of each byte that ``coded`` gives."""
    byte = np.arange(256)
    odds = ((byte // 2 - MOST) * STEP).astype(np.float32)
    gate = 1 + byte % 2
    odds[UNSEEN], gate[UNSEEN] = 0, 0
    return odds, gate


ODDS, GATE = _decoded()
#: The log odds of two bytes at once.
PAIRS = ODDS.take(np.arange(1 << 16, dtype=np.uint16).view(np.uint8)).view(np.complex64)


def _chunks(rows: DataFrame, kind: T.DataType) -> DataFrame:
    """A row for each chunk of texts: its documents, distinct units in order, how often each teaches, and the texts as numbers of units.

    The chunk's name is drawn, so the rows must be stored before use.
    """
    docs = pa.struct([("doc_id", to_arrow_type(kind)), ("held_out", pa.bool_()), ("size", pa.int64()), ("units", pa.int64())])
    names = ["chunk", "n", "docs", "units", "sizes", "teach", "which"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, CHUNK):
            raws = bytes_of(some["raw"])
            found, which, each = units(raws)
            out = some["held_out"].to_numpy()
            teach = np.bincount(which[np.repeat(~out.astype(bool), each)], minlength=len(found))
            own = pa.StructArray.from_arrays([some["doc_id"].combine_chunks(), some["held_out"].combine_chunks(), pa.array([len(x) for x in raws], pa.int64()), pa.array(each, pa.int64())],
                                             fields=list(docs))
            yield pa.RecordBatch.from_arrays([
                pa.array([uuid.uuid4().hex]), pa.array([len(found)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(raws)], pa.int32()), own),
                *(pa.array([x], pa.binary()) for x in (zlib.compress(b"".join(found), 1), _squeezed(np.array([len(x) for x in found], np.int64)), _squeezed(teach), _squeezed(which)))], names)

    return rows.mapInArrow(run, f"chunk string, n long, docs array<struct<doc_id:{kind.simpleString()},held_out:boolean,size:bigint,units:bigint>>, "
                                "units binary, sizes binary, teach binary, which binary")


def _unit_counts(chunks: DataFrame) -> DataFrame:
    """``unit, n`` of the units that teach."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, sizes, teach in zip(*(batch[c].to_pylist() for c in ("units", "sizes", "teach"))):
                n = _numbers(teach, np.int64)
                found = _binary(zlib.decompress(raw), _numbers(sizes, np.int64))
                yield pa.RecordBatch.from_arrays([found, pa.array(n)], ["unit", "n"]).filter(pa.array(n > 0))

    return chunks.select("units", "sizes", "teach").mapInArrow(run, "unit binary, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols, sizes and counts of some units at a time."""
    for some in _together(batches, PIECE):
        yield *_flat(some["raw"]), some["n"].to_numpy()


def _byte_counts(counted: DataFrame) -> list[int]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for symbols, sizes, n in _counted(batches):
            total += np.bincount(symbols, weights=np.repeat(n, sizes), minlength=256).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], ["symbol", "n"])

    found = counted.mapInArrow(run, "symbol int, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()  # 256 rows
    counts = [0] * 256
    for r in found:
        counts[r["symbol"]] = r["n"]
    return counts


def _context_counts(counted: DataFrame, code: Code) -> np.ndarray:
    """(zeros, ones) of every slot over all units."""
    n_slots = int(TABLES[-1])
    blocks = -(-n_slots // BLOCK)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * BLOCK * blocks, np.float64)
        for symbols, sizes, n in _counted(batches):
            starts = np.cumsum(sizes) - sizes
            for lo, hi in _parts(sizes, PIECE // 8):
                own = symbols[starts[lo]:starts[hi - 1] + sizes[hi - 1]]
                place, node, bit = code.spell(own)
                weight = np.repeat(n[lo:hi], sizes[lo:hi])[place].astype(np.float64)
                at = slots(own, sizes[lo:hi], place, node) * 2 + bit[:, None]
                for i in range(len(SLOT_BITS)):
                    np.add.at(total, at[:, i], weight)
        total = total.astype(np.int64)
        part = zlib.crc32(total.tobytes()) % 32  # tasks' tables are added up in some groups first
        for i, block in enumerate(total.reshape(blocks, -1)):
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([_squeezed(block)], pa.binary())], ["block", "part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(2 * BLOCK, np.int64)
        for x in group["counts"]:
            total += _numbers(x.as_py(), np.int64)
        return pa.table({"block": group["block"][:1], "part": group["part"][:1], "counts": pa.array([_squeezed(total)], pa.binary())})

    shape = "block int, part int, counts binary"
    tables = counted.mapInArrow(run, shape).groupBy("block", "part").applyInArrow(add, shape)
    tables = tables.groupBy("block").applyInArrow(add, shape)
    out = np.zeros((blocks, 2 * BLOCK), np.int64)
    for r in tables.toLocalIterator():  # one row a block, as many as TABLES need at every size
        out[r["block"]] = _numbers(bytes(r["counts"]), np.int64)
    return out.reshape(-1, 2)[:n_slots]


def _range_ends(counted: DataFrame, n: int, ranges: int) -> list[bytes]:
    """Units that part the corpus' units into about equal ranges, from a drawn sample."""
    if not n:
        return []
    drawn = sorted({bytes(r["raw"]) for r in counted.select("raw").sample(min(1.0, DRAWN * ranges / n), 7).collect()})  # about DRAWN for each range
    return sorted({drawn[i * len(drawn) // ranges] for i in range(1, ranges)}) if drawn else []


def _beginnings(ends: list[bytes]) -> np.ndarray:
    """Hashes of the contexts that the neighbours of a range's end may share: what the end begins with."""
    sizes = np.array([len(x) for x in ends], np.int64)
    return np.unique(_contexts(np.frombuffer(b"".join(ends), np.uint8), sizes)) if len(sizes) else np.zeros(0, np.uint64)


def _shared_counts(counted: DataFrame, ends: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What followed each beginning of the ranges' ends how often: contexts, symbols and counts."""
    wanted = _beginnings(ends)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, sizes, n in _counted(batches):
            context = _contexts(symbols, sizes)
            hit = np.isin(context, wanted)
            context, symbol, times = _added_up(context[hit], symbols[hit], np.repeat(n, sizes)[hit])
            yield pa.RecordBatch.from_arrays([pa.array(context.astype(np.int64)), pa.array(symbol.astype(np.int32)), pa.array(times)], ["context", "symbol", "n"])

    found = counted.mapInArrow(run, "context long, symbol int, n long").groupBy("context", "symbol").agg(F.sum("n").alias("n"))
    got = [(r["context"], r["symbol"], r["n"]) for r in found.toLocalIterator()]  # some for each range
    context, symbol, n = (np.array(x, np.int64) for x in zip(*got)) if got else (np.zeros(0, np.int64),) * 3
    return _added_up(context.astype(np.uint64), symbol.astype(np.uint8), n)


class Known:
    """What followed each context of a range's units."""

    def __init__(self, code: Code, symbols: np.ndarray, sizes: np.ndarray, n: np.ndarray, ends: list[bytes], shared: tuple[np.ndarray, np.ndarray, np.ndarray]):
        context, symbol, times = _added_up(_contexts(symbols, sizes), symbols, np.repeat(n, sizes))
        beginnings = _beginnings(ends)
        own, every = ~np.isin(context, beginnings), np.isin(shared[0], beginnings)
        context, symbol, times = _added_up(*(np.concatenate((a[own], b[every])) for a, b in zip((context, symbol, times), shared)))
        self.code = code
        self.contexts, which = np.unique(context, return_inverse=True)
        #: how often each context was a whole word
        self.words = np.bincount(which, weights=times * BLANK[symbol], minlength=len(self.contexts)).astype(np.int64)
        place, node, bit = code.spell(symbol)
        self.cells, cell = np.unique(which[place] * 256 + node, return_inverse=True)
        self.total = np.zeros((len(self.cells) + 1, 2))
        for b in (0, 1):
            self.total[:-1, b] = np.bincount(cell, weights=times[place] * (bit == b), minlength=len(self.cells))
        seen = self.total.sum(1)
        self.steps, self.often, self.seen = steps_of(self.total), seen >= SEEN[1], seen >= SEEN[0]

    def answer(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For units: a byte for each bit, the bits of each unit, and how often its word was seen."""
        found = _contexts(symbols, sizes)
        context = np.searchsorted(self.contexts, found)
        context[np.append(self.contexts, np.uint64(1 << HASHED))[context] != found] = len(self.contexts)
        words = np.append(self.words, 0)[context[np.cumsum(sizes) - 1]]
        place, node, bit = self.code.spell(symbols)
        wanted = context[place] * 256 + node
        cell = np.searchsorted(self.cells, wanted)
        cell[np.append(self.cells, -1)[cell] != wanted] = len(self.cells)
        out = coded(self.steps[cell], bit, self.often[cell])
        out[~self.seen[cell]] = UNSEEN
        return out, np.add.reduceat(self.code.sizes[symbols], np.cumsum(sizes) - sizes), words


def _answers(chunks: DataFrame, counted: DataFrame, code: Code, ends: list[bytes], shared) -> DataFrame:
    """``chunk, range, words, codes``: for the units that a chunk has in a range, in order, how often each word was seen and a byte for each bit.

    A range holds a bounded number of distinct units.  What all chunks ask
    of it grows with the corpus, so each range's units go to as many groups
    as keep the units asked of one group bounded, too.
    """
    total = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    copies = max(1, -(-total // ((len(ends) + 1) * ASKED_UNITS)))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, raw, sizes in zip(*(batch[c].to_pylist() for c in ("chunk", "units", "sizes"))):
                raw, sizes = zlib.decompress(raw), _numbers(sizes, np.int64)
                stop = np.concatenate(([0], np.cumsum(sizes)))
                own = [raw[a:b] for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())]
                cut = [0, *(bisect_left(own, x) for x in ends), len(own)]
                used = [i for i in range(len(cut) - 1) if cut[i] < cut[i + 1]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([chunk] * len(used), pa.string()), pa.array(used, pa.int32()),
                    pa.array([zlib.compress(raw[stop[cut[i]]:stop[cut[i + 1]]], 1) for i in used], pa.binary()),
                    pa.array([_squeezed(sizes[cut[i]:cut[i + 1]]) for i in used], pa.binary())], ["chunk", "range", "units", "sizes"])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _together(batches, PIECE):
            raw, n = some["raw"].to_pylist(), some["n"].to_pylist()
            by_range: dict[int, list[int]] = {}
            for i, x in enumerate(raw):
                by_range.setdefault(bisect_right(ends, x), []).append(i)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(by_range), pa.int32()), pa.array([zlib.compress(b"".join([raw[i] for i in own]), 1) for own in by_range.values()], pa.binary()),
                pa.array([_squeezed(np.array([len(raw[i]) for i in own], np.int64)) for own in by_range.values()], pa.binary()),
                pa.array([_squeezed(np.array([n[i] for i in own], np.int64)) for own in by_range.values()], pa.binary())], ["h_range", "units", "sizes", "n"])

    def look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"chunk": pa.array([], pa.string()), "range": pa.array([], pa.int32()), "words": pa.array([], pa.binary()), "codes": pa.array([], pa.binary())})
        at = left["range"][0].as_py()
        join = lambda t, c, kind: np.concatenate([np.zeros(0, kind), *(_numbers(x, kind) for x in t[c].to_pylist())])
        blob = lambda t: np.frombuffer(b"".join([zlib.decompress(x) for x in t["units"].to_pylist()]), np.uint8)
        known = Known(code, blob(right), join(right, "sizes", np.int64), join(right, "n", np.int64), ends[max(at - 1, 0):at + 1], shared)
        symbols, sizes = blob(left), join(left, "sizes", np.int64)
        starts = np.cumsum(sizes) - sizes
        whole = np.concatenate([np.zeros(0, np.uint64), *(_prefixes(symbols[starts[a]:starts[b - 1] + sizes[b - 1]], starts[a:b] - starts[a], sizes[a:b])[1] for a, b in _parts(sizes, PIECE))])
        _, first, which = np.unique(whole, return_index=True, return_inverse=True)
        codes, bits, words = [np.zeros(0, np.uint8)], [], []
        for a in range(0, len(first), TOGETHER):  # each distinct unit once, whatever the chunks that ask for it
            some = first[a:a + TOGETHER]
            found = known.answer(symbols[_ranges(starts[some], sizes[some])], sizes[some])
            for to, x in zip((codes, bits, words), found):
                to.append(x)
        codes, bits, words = (np.concatenate(x) for x in (codes, bits, words))
        begin, lo, out = np.cumsum(bits) - bits, 0, []
        for x in left["sizes"].to_pylist():
            own = which[lo:lo + len(_numbers(x, np.int64))]
            out.append((words[own].tobytes(), codes[_ranges(begin[own], bits[own])].tobytes()))
            lo += len(own)
        return pa.table({"chunk": left["chunk"], "range": left["range"], "words": pa.array([a for a, _ in out], pa.binary()), "codes": pa.array([b for _, b in out], pa.binary())})

    asked = chunks.select("chunk", "units", "sizes").mapInArrow(ask, "chunk string, range int, units binary, sizes binary")
    asked = asked.withColumn("copy", F.pmod(F.xxhash64("chunk"), F.lit(copies)).cast("int"))
    holds = counted.mapInArrow(place, "h_range int, units binary, sizes binary, n binary").withColumn("h_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return asked.groupBy("range", "copy").cogroup(holds.groupBy("h_range", "h_copy")).applyInArrow(look_up, "chunk string, range int, words binary, codes binary")


class Model:
    """The code, and the log odds of each slot of the first three predictors in steps."""

    def __init__(self, byte_counts: list[int], steps: np.ndarray):
        self.code, self.steps = Code(byte_counts), steps

    def codes(self, symbols: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Four bytes for each bit of the units, one for each predictor; ``last`` are those of the last one."""
        out = np.empty((len(last), ORDERS), np.uint8)
        out[:, -1] = last
        starts, lo = np.cumsum(sizes) - sizes, 0
        for a, b in _parts(sizes, PIECE // 8):
            own = symbols[starts[a]:starts[b - 1] + sizes[b - 1]]
            place, node, bit = self.code.spell(own)
            out[lo:lo + len(bit), :-1] = coded(self.steps[slots(own, sizes[a:b], place, node)], bit[:, None])
            lo += len(bit)
        return out

    def bits(self, symbols: np.ndarray, sizes: np.ndarray, last: np.ndarray, which: np.ndarray, each: np.ndarray) -> np.ndarray:
        """Total bits of each text: ``each`` numbers of units of ``which``, the units given by symbols and sizes."""
        codes = self.codes(symbols, sizes, last).view(np.uint32).ravel()
        n = np.add.reduceat(self.code.sizes[symbols], np.cumsum(sizes) - sizes) if len(sizes) else sizes
        first, begin = np.cumsum(n) - n, np.cumsum(each) - each
        out = np.zeros(len(each))
        order = np.argsort(-each, kind="stable")  # long texts first
        for lo in range(0, len(order), LANES):
            lanes = order[lo:lo + LANES]
            out[lanes] = mixed(codes, first, n, which, begin[lanes], each[lanes])
        return out / np.log(2)


def mixed(codes: np.ndarray, first: np.ndarray, n: np.ndarray, which: np.ndarray, begin: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Coding cost (in nats) of texts that are mixed side by side; ``each``, their numbers of units, falls."""
    lanes = len(each)
    weights = np.tile(np.array(WEIGHTS, np.float32), (lanes, 1))
    wide = weights.view(np.complex128).ravel()  # a bit's four weights move as one 16-byte value
    shift = np.zeros(lanes * CELLS, np.float32)
    cost = np.zeros(lanes)
    for t in range(0, int(each[0]), BEAT):
        live = int(np.searchsorted(-each, -t, side="left"))
        taken = np.minimum(each[:live] - t, BEAT)
        unit = which[_ranges(begin[:live] + t, taken)]
        size = n[unit]
        stop = np.cumsum(size)[np.cumsum(taken) - 1]
        start = np.concatenate(([0], stop[:-1]))
        lane = np.repeat(np.arange(live), stop - start)
        four = codes.take(_ranges(first[unit], size))
        x = PAIRS.take(four.view(np.uint16)).view(np.float32)
        own = GATE.take(four >> 24)
        own += lane * GATES
        moved = wide.take(own).view(np.float32)
        moved *= x
        moved = moved.view(np.complex64)  # two sums at once
        z = (moved[0::2] + moved[1::2]).view(np.float32)
        z = z[0::2] + z[1::2]
        np.minimum(z, FAR, out=z)
        np.maximum(z, -FAR, out=z)
        sign = np.copysign(np.float32(1), z)
        sign *= z != 0  # neither bit is likelier then
        cell = np.minimum(np.abs(z), CELLS - 1).astype(np.int64)
        cell += lane * CELLS
        further = shift.take(cell)
        further *= sign
        further += z
        refined = np.exp(-further)
        one = refined + 1
        cost[:live] += np.add.reduceat(np.log(one).astype(np.float64), start)
        refined /= one
        refined *= sign
        shift[:live * CELLS] += MAP_RATE * np.bincount(cell, weights=refined, minlength=live * CELLS)
        off = np.exp(-z)
        off /= off + 1
        off *= np.float32(RATE)
        for i in range(ORDERS):
            weights[:live * GATES, i] += np.bincount(own, weights=x[i::ORDERS] * off, minlength=live * GATES)
    return cost


def _model(shared) -> Model:
    return held(("mixing", shared), lambda: Model(*shared.value))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 7, part: int = 2) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every row.

    ``score`` is the model's log10 probability of the lower-cased text and
    its end, ``bits_per_byte`` its bits over the text's bytes (null for
    none).  A null text is empty.  Without training texts all counts are 0.
    Repeated rows each count and give a row; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out_of = held_out(F.col(doc_id), parts, part)
    rows = docs.select(F.col(doc_id).alias("doc_id"), out_of.alias("held_out"), F.col(text).cast("binary").alias("raw"))
    kind = rows.schema["doc_id"].dataType

    chunks = store(_chunks(rows, kind), "unit_chunks")
    counted = store(_unit_counts(chunks), "unit_counts").withColumnRenamed("unit", "raw")
    byte_counts = _byte_counts(counted)
    # a unit is a word and the sign behind it
    word = F.expr("substring(raw, 1, octet_length(raw) - 1)")
    per_word = counted.filter(F.octet_length("raw") > 1).groupBy(word.alias("word")).agg(F.sum("n").alias("n"))
    sums = per_word.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    texts = byte_counts[END]  # one end for each training text
    train_tokens, distinct_tokens = sums["n"] + texts, sums["v"] + (texts > 0)

    n_units = counted.count()
    ends = _range_ends(counted, n_units, max(RANGES, -(-n_units // RANGE_UNITS)))
    model = spark.sparkContext.broadcast((byte_counts, steps_of(_context_counts(counted, Code(byte_counts)))))
    answers = _answers(chunks, counted, Code(byte_counts), ends, _shared_counts(counted, ends))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        docs = left["docs"].combine_chunks().flatten()
        symbols = np.frombuffer(zlib.decompress(left["units"][0].as_py()), np.uint8)
        sizes, which = _numbers(left["sizes"][0].as_py(), np.int64), _numbers(left["which"][0].as_py(), np.int32)
        each = docs.field("units").to_numpy()
        right = right.sort_by("range")
        words, last = (np.frombuffer(b"".join(right[c].to_pylist()), kind) for c, kind in (("words", np.int64), ("codes", np.uint8)))
        bits = _model(model).bits(symbols, sizes, last, which, each)
        owner = np.repeat(np.arange(len(docs)), each)
        add_up = lambda x: np.bincount(owner, weights=x[which], minlength=len(docs))
        is_word = sizes > 1
        n_tokens = add_up(is_word) + 1  # and the end
        n_known = add_up(is_word & (words > 0)) + (texts > 0)
        base = add_up(np.where(is_word, np.log10(words + 1.0), 0.0)) + np.log10(texts + 1) - n_tokens * np.log10(train_tokens + distinct_tokens + 1)
        size = docs.field("size").to_pylist()
        return pa.table({"doc_id": docs.field("doc_id"), "held_out": docs.field("held_out"), "n_tokens": n_tokens.astype(np.int64),
                         "n_known": n_known.astype(np.int64), "train_tokens": np.full(len(docs), train_tokens, np.int64),
                         "base_score": base, "score": -bits * np.log10(2),
                         "bits_per_byte": pa.array([b / n if n else None for b, n in zip(bits.tolist(), size)], pa.float64())})

    return chunks.select("chunk", "docs", "units", "sizes", "which").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        run, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
