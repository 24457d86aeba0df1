"""Benchmark decontamination with suffix arrays of the training text.

Each task treats a few megabytes of documents as a shard: it writes the
shard as word numbers of the benchmark's vocabulary, sorts its suffixes and
binary-searches every benchmark suffix in that array, one word deeper at a
time.  The array interval where a suffix stops is its longest verbatim
match with all its locations; the interval at the window length gives the
hits.  Shorter runs of benchmark words are searched, too, for the
longest match, which may be shorter than a window.

The benchmark is the query set.  It is sent to the tasks in blocks of
bounded size, and documents stream through one pass per block; nothing is
shuffled.  After every few blocks the rows are written and read again and
those blocks let go, so a benchmark of any size takes bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import bytes_of, held, number_of, numbered, pieces, small_batches, store

#: Separators become blanks, A-Z lower case; the rest of ASCII and all other bytes are word bytes.
WORDS = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b
              for b in range(256))
#: Benchmark bytes sent in one block, and training bytes in one suffix array.
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 8 << 20
#: Blocks that are with the tasks at one time.
CHAIN = 4

STATE = T.StructType([
    T.StructField("__sa_words", T.LongType()), T.StructField("__sa_hit", T.LongType()),
    T.StructField("__sa_spans", T.BinaryType()), T.StructField("__sa_items", T.ArrayType(T.StringType())),
    T.StructField("__sa_longest", T.LongType()), T.StructField("__sa_longest_item", T.StringType()),
    T.StructField("__sa_longest_at", T.LongType())])


def words(raw: bytes) -> list[bytes]:
    return raw.translate(WORDS).split()


class Queries:
    """A block of benchmark texts: all their suffixes, as word numbers with 0 behind each text."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        at = {name: i for i, name in enumerate(self.names)}
        text: list[int] = []
        item: list[int] = []
        rest: list[int] = []
        need: list[int] = []
        for name, raw in items:
            found = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(raw)]
            n = len(found)
            text += [*found, 0]
            item += [at[name]] * (n + 1)
            rest += range(n, -1, -1)
            need += [min(window, n)] * (n + 1)
        self.text = np.array(text, np.int64)
        rests, needs = np.array(rest, np.int64), np.array(need, np.int64)
        self.starts = np.flatnonzero(rests > 0)
        self.item = np.array(item, np.int64)[self.starts]
        self.rest, self.need = rests[self.starts], needs[self.starts]
        self.longest = int(self.rest.max()) if len(self.starts) else 0


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (0 ends a run) in the order of their first ``depth`` numbers, by prefix doubling."""
    rank = text.copy()
    order = np.argsort(rank, kind="stable")
    h = 1
    while h < depth:
        later = np.zeros_like(rank)
        later[:-h or None] = rank[h:]
        later[rank == 0] = 0
        key = rank * (int(rank.max()) + 1) + later
        order = np.argsort(key, kind="stable")
        steps = np.diff(key[order]) != 0
        fresh = np.empty_like(rank)
        # ends of runs keep rank 0, so that nothing reads past them
        fresh[order] = np.concatenate(([0], np.cumsum(steps))) + (1 if key.size and key[order[0]] else 0)
        rank = fresh
        if steps.all():
            break
        h *= 2
    return order


def _edge(text: np.ndarray, order: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, word: np.ndarray, after: bool) -> np.ndarray:
    """The first place in [lo, hi) whose number at ``depth`` is at least ``word`` (``after``: over it)."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) >> 1
        there = text[np.minimum(order[mid] + depth, len(text) - 1)]
        less = there <= word[open_] if after else there < word[open_]
        lo[open_[less]] = mid[less] + 1
        hi[open_[~less]] = mid[~less]
    return lo


def search(text: np.ndarray, order: np.ndarray, q: Queries) -> tuple[np.ndarray, ...]:
    """For each benchmark suffix: interval at its window length (empty: none); for each place in ``order``: the longest match of any suffix, and that suffix."""
    n = len(q.starts)
    at_lo, at_hi = np.zeros(n, np.int64), np.zeros(n, np.int64)
    reach, source = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    end_lo, end_hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    live, depth = np.arange(n), 0
    while live.size:
        word = q.text[q.starts[live] + depth]
        lo = _edge(text, order, end_lo[live], end_hi[live], depth, word, False)
        hi = _edge(text, order, lo, end_hi[live], depth, word, True)
        on = lo < hi
        live, lo, hi = live[on], lo[on], hi[on]
        depth += 1
        end_lo[live], end_hi[live] = lo, hi
        # intervals of one depth are equal or apart, and lie in those of the depth before
        own, first = np.unique(lo, return_index=True)
        where, which = _spread(own, hi[first])
        reach[where], source[where] = depth, live[first[which]]
        full = q.need[live] == depth
        at_lo[live[full]], at_hi[live[full]] = lo[full], hi[full]
        live = live[q.rest[live] > depth]
    return at_lo, at_hi, reach, source


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the intervals, and the interval of each."""
    sizes = hi - lo
    which = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[which], which


def scan(texts: list[bytes], q: Queries) -> tuple[np.ndarray, ...]:
    """One shard against one block: per-document word counts; hit ranges (document, from, to); (document, item)
    pairs; per document the longest match, its item and its first word."""
    number = q.numbers.get
    found = [[number(w, 0) for w in words(x)] for x in texts]
    counts = np.array([len(x) for x in found], np.int64)
    firsts = np.concatenate(([0], np.cumsum(counts + 1)))  # a 0 ends each document
    flat = np.zeros(int(firsts[-1]) + 1, np.int64)
    for at, x in zip(firsts, found):
        flat[at:at + len(x)] = x
    del found
    ends = np.flatnonzero(flat == 0)
    before = np.concatenate(([-1], ends[:-1]))
    runs = ends - before - 1
    long = runs > 0
    none = np.zeros(0, np.int64)
    best = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    if not long.any() or not len(q.starts):
        return counts, none, none, none, none, none, *best
    places, _ = _spread(before[long] + 1, ends[long] + 1)  # with the 0 that ends the run
    text = flat[places]
    order = suffix_array(text, q.longest)
    at_lo, at_hi, reach, source = search(text, order, q)

    # equal windows share an interval: each is spread once
    windows, same = np.unique(np.stack([at_lo, at_hi, q.need])[:, at_hi > at_lo], axis=1, return_inverse=True)
    items = np.unique(np.stack([same.ravel(), q.item[at_hi > at_lo]]), axis=1)
    where, which = _spread(windows[0], windows[1])
    hit = places[order[where]]
    doc = np.searchsorted(firsts, hit, side="right") - 1
    begin = hit - firsts[doc]
    held = np.unique(np.stack([doc, which]), axis=1)
    starts = np.searchsorted(items[0], np.arange(windows.shape[1] + 1))
    picked, row = _spread(starts[held[1]], starts[held[1] + 1])
    pairs = np.unique(np.stack([held[0][row], items[1][picked]]), axis=1)

    # the longest match of each document, below a window too
    met = np.flatnonzero(reach)
    spot = places[order[met]]
    in_doc = np.searchsorted(firsts, spot, side="right") - 1
    rank = np.lexsort((spot, -reach[met], in_doc))
    top = rank[np.concatenate(([True], np.diff(in_doc[rank]) != 0))] if rank.size else rank
    best[0][in_doc[top]], best[1][in_doc[top]], best[2][in_doc[top]] = reach[met[top]], q.item[source[met[top]]], spot[top] - firsts[in_doc[top]]
    return counts, doc, begin, begin + windows[2][which], pairs[0], pairs[1], *best


def _compiled(block, window: int) -> Queries:
    return held(("decontam", block, window), lambda: Queries(block.value, window))


def blocks(bench: DataFrame, item_id: str, text: str, most: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark's texts in blocks of about ``most`` bytes."""
    rows = bench.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.col(text).cast("binary").alias("t"))
    block, size = [], 0
    for r in rows.toLocalIterator():
        raw = bytes(r["t"] or b"")
        if block and size + len(raw) > most:
            yield block
            block, size = [], 0
        block.append((r["i"], raw))
        size += len(raw)
    yield block


def annotate(docs: DataFrame, bench: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
             window: int = 13, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, chain: int = CHAIN) -> DataFrame:
    """``docs`` with the columns of ``STATE``: words, words hit, hit ranges, items, longest match (words, item, first word).

    Null and empty texts have no words and no hit.  A benchmark text without
    words has no window; one without an id is listed as ``null``; repeated
    items count once.  An empty benchmark hits nothing.  Repeated documents
    are searched each; columns of ``docs`` named as those added give way.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.drop(*STATE.names)
    small_batches(spark)
    schema = T.StructType([*docs.schema.fields, *STATE.fields])
    out, live = docs, []
    for k, block in enumerate(blocks(bench, item_id, item_text, block_bytes)):
        if len(live) == chain:
            out = store(out, "decontam")
            for sent in live:
                sent.unpersist()
            live = []
        live.append(spark.sparkContext.broadcast(block))
        out = out.mapInArrow(_pass(docs.columns, text, live[-1], window, shard_bytes, k), schema)
    return out


def _gathered(batches: Iterable[pa.RecordBatch], at: int, most: int) -> Iterator[pa.RecordBatch]:
    """Successive batches as one as long as column ``at`` holds at most ``most`` bytes in them."""
    own, size = [], 0
    for batch in batches:
        n = pa.compute.sum(pa.compute.binary_length(batch.column(at))).as_py() or 0
        if own and size + n > most:
            yield from pa.Table.from_batches(own).combine_chunks().to_batches()
            own, size = [], 0
        own.append(batch)
        size += n
    if own:
        yield from pa.Table.from_batches(own).combine_chunks().to_batches()


def _pass(columns: list[str], text: str, block, window: int, shard_bytes: int, k: int):
    at = columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches, at, shard_bytes):
            raw = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.binary()), pa.array(np.arange(batch.num_rows))], ["raw", "row"])
            for part in pieces([raw], "raw", shard_bytes):
                lo = part.column(1)[0].as_py()
                rows = batch.slice(lo, part.num_rows)
                yield _marked(rows, len(columns), bytes_of(part.column(0)), _compiled(block, window), k)

    return run


def _marked(rows: pa.RecordBatch, own: int, texts: list[bytes], q: Queries, k: int) -> pa.RecordBatch:
    counts, doc, begin, end, pair_doc, pair_item, best, best_item, best_at = scan(texts, q)
    n = len(texts)
    items: list[set[str]] = [set() for _ in range(n)]
    old = [rows.column(own + i).to_pylist() for i in range(len(STATE.fields))] if k else None
    if old:  # what earlier blocks found
        spans = [np.frombuffer(x or b"", np.int64).reshape(-1, 2) for x in old[2]]
        doc = np.concatenate([doc, np.repeat(np.arange(n), [len(x) for x in spans])])
        begin, end = (np.concatenate([a, *[x[:, c] for x in spans]]) for c, a in enumerate((begin, end)))
        items = [set(x or ()) for x in old[3]]
    for d, i in zip(pair_doc.tolist(), pair_item.tolist()):
        items[d].add(q.names[i])
    # the union of each document's ranges
    firsts = np.concatenate(([0], np.cumsum(counts + 1)))
    marks = np.zeros(int(firsts[-1]) + 1, np.int64)
    np.add.at(marks, firsts[doc] + begin, 1)
    np.add.at(marks, firsts[doc] + end, -1)
    covered = np.concatenate(([0], (np.cumsum(marks) > 0).astype(np.int64), [0]))
    change = np.diff(covered)
    lo, hi = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    at = np.searchsorted(firsts, lo, side="right") - 1
    hits = np.zeros(n, np.int64)
    np.add.at(hits, at, hi - lo)
    bounds = np.searchsorted(at, np.arange(n + 1))
    flat = np.stack([lo - firsts[at], hi - firsts[at]], axis=1)
    name = [q.names[i] if b else None for b, i in zip(best.tolist(), best_item.tolist())]
    best, best_at = best.tolist(), best_at.tolist()
    if old:
        for i, (b, it, p) in enumerate(zip(old[4], old[5], old[6])):
            if b >= best[i]:
                best[i], name[i], best_at[i] = b, it, p
    state = [pa.array(counts), pa.array(hits), pa.array([flat[bounds[i]:bounds[i + 1]].tobytes() for i in range(n)], pa.binary()),
             pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(best, pa.int64()), pa.array(name, pa.string()),
             pa.array([p if b else None for p, b in zip(best_at, best)], pa.int64())]
    return pa.RecordBatch.from_arrays([*rows.columns[:own], *state], [*rows.schema.names[:own], *STATE.names])


def report(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 5, **more) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, items, contaminated`` and its longest match.

    ``contaminated``: hit words are at least ``percent`` in a hundred, and not none.
    """
    rows = annotate(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), bench, **more)
    return rows.select("doc_id", F.col("__sa_words").alias("n_words"), F.col("__sa_hit").alias("n_hit"), F.col("__sa_items").alias("items"),
                       _bad(percent).alias("contaminated"), F.col("__sa_longest").alias("longest_words"),
                       F.col("__sa_longest_item").alias("longest_item"), F.col("__sa_longest_at").alias("longest_at"))


def _bad(percent: int):
    return (F.col("__sa_hit") > 0) & (F.col("__sa_hit") * 100 >= F.col("__sa_words") * percent)


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", percent: int = 5, **more) -> DataFrame:
    """``docs`` without its contaminated rows; the others keep all their columns whatever their names."""
    own = numbered(docs)
    return annotate(own, bench, number_of(docs, text), **more).filter(~_bad(percent)).select(*own.columns).toDF(*docs.columns)
