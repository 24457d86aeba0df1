"""Spelling variants: words one edit apart, found in a bidirectional FM-index.

A vocabulary stands in an index as one delimited text, in both directions:
the ranks of its suffixes and those of the reversed text.  An interval of
suffix ranks stands for a string, kept in both directions at once, so a
string can grow at either end.

The search scheme for one error cuts a word into two halves, one of which
is right.  The first half is matched exactly, from its end to the delimiter
before it, leftwards; then the string grows rightwards over the other half,
allowing one inserted, deleted or replaced letter, up to the delimiter.
Words whose second half is right are found by the same search over the
reversed words.

Words that share the exact half share their first three letters (or last
three, read from the end), so words are dealt to buckets by these; a bucket
has an index of its own.  A bucket of many words is cut into several
indexes, each of which all words of the bucket ask.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import store

#: Code points of the shortest word: each half then holds the three that words are dealt by.
SHORTEST = 6
DEALT_BY = 3
#: Words of one index.
INDEX_WORDS = 16384
#: Words that search at once.
ASKING = 8192
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"


def _ranks(text: np.ndarray) -> np.ndarray:
    """The order of a text's rotations, by doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        key = rank * n + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        step = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = step
        if step[-1] == n - 1:
            return order
        width *= 2


class Direction:
    """Suffix ranks of a text in one direction: the letters before them, and how many of each come before a rank."""

    def __init__(self, text: np.ndarray, letters: int):
        n = len(text)
        self.order = _ranks(text)
        self.before = text[self.order - 1]  # the text is a ring
        self.n = n
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=letters))))
        self.places = np.sort(self.before.astype(np.int64) * n + np.arange(n))

    def rank(self, letter: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the suffixes that put ``letter`` before those of ranks below ``at`` end."""
        return np.searchsorted(self.places, letter * self.n + at)

    def step(self, low: np.ndarray, size: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each interval grown by one letter."""
        start = self.rank(letter, low)
        return start, self.rank(letter, low + size) - start

    def grow(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each interval grown by every letter that it can: parent, letter, new interval, and how many of the parent's suffixes put a smaller letter before them."""
        parent = np.repeat(np.arange(len(low)), size)
        inside = np.arange(len(parent)) - np.repeat(np.cumsum(size) - size, size)
        letter = self.before[low[parent] + inside].astype(np.int64)
        key, count = np.unique(parent * (int(self.before.max()) + 1) + letter, return_counts=True)
        parent, letter = np.divmod(key, int(self.before.max()) + 1)
        total = np.cumsum(count) - count
        starts = np.concatenate(([True], np.diff(parent) != 0)) if len(parent) else np.zeros(0, bool)
        smaller = total - np.maximum.accumulate(np.where(starts, total, 0))
        return parent, letter, self.rank(letter, low[parent]), count, smaller


def _join(parent: np.ndarray, letter: np.ndarray, state: np.ndarray, want: np.ndarray) -> np.ndarray:
    """The place among grown intervals of ``state`` grown by ``want``, or -1; parents and letters ascend."""
    if not len(parent):
        return np.full(len(state), -1)
    wide = int(max(letter.max(), want.max(initial=0))) + 1
    have, ask = parent * wide + letter, state * wide + want
    at = np.minimum(np.searchsorted(have, ask), len(have) - 1)
    return np.where(have[at] == ask, at, -1)


class Index:
    """A bidirectional FM-index over delimited words. Letters are numbers from 1 on; 0 is the delimiter."""

    def __init__(self, words: list[np.ndarray], letters: int):
        lengths = np.array([len(w) for w in words], np.int64)
        starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        text = np.zeros(int((lengths + 1).sum()), np.int32)
        for at, w in zip(starts.tolist(), words):
            text[at + 1:at + 1 + len(w)] = w
        self.forward = Direction(text, letters)
        self.backward = Direction(text[::-1].copy(), letters)
        # a reversed word and its delimiters begin, in the reversed ring, at the delimiter behind the word
        ends = (starts + lengths + 1) % len(text)
        owner = np.full(len(text), -1)
        owner[len(text) - 1 - ends] = np.arange(len(words))
        self.owner = owner[self.backward.order]

    def _halves(self, asked: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each asked word the interval (in reversed suffix ranks) of the delimiter and its first ``half`` letters: state, and the states' intervals.

        Grown leftwards, letter by letter, with equal strings as one state.
        """
        state = np.zeros(len(asked), np.int64)
        low, size, other = np.zeros(1, np.int64), np.array([self.forward.n]), np.zeros(1, np.int64)
        done_state, done_size, done_other = np.full(len(asked), -1), [], []
        for depth in range(int(half.max(initial=0)) + 1):
            parent, letter, grown, count, smaller = self.forward.grow(low, size)
            live = (state >= 0) & (done_state < 0)
            column = half - 1 - depth
            want = np.where(column >= 0, asked[np.arange(len(asked)), np.maximum(column, 0)], 0)
            at = np.full(len(asked), -1)
            at[live] = _join(parent, letter, state[live], want[live])
            state = at
            ends = (at >= 0) & (column < 0)
            if ends.any():
                kept, number = np.unique(at[ends], return_inverse=True)
                done_state[ends] = number + sum(map(len, done_size))
                done_size.append(count[kept])
                done_other.append((other[parent] + smaller)[kept])
                state[ends] = -1
            used, state_of = np.unique(state[state >= 0], return_inverse=True)
            state[state >= 0] = state_of
            low, size, other = grown[used], count[used], (other[parent] + smaller)[used]
            if not len(used):
                break
        return done_state, np.concatenate([*done_other, np.zeros(0, np.int64)]), np.concatenate([*done_size, np.zeros(0, np.int64)])

    def near(self, asked: np.ndarray, lengths: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (asked word, word of the index) with the same first ``half`` letters and exactly one edit behind them.

        ``asked``: a row of letters for each word, padded.
        """
        state, low, size = self._halves(asked, half)
        word = np.flatnonzero(state >= 0)
        state = state[word]
        at = half[word]
        out: list[np.ndarray] = []
        one: list[tuple[np.ndarray, ...]] = []  # strings with the error behind them: word, next letter, interval
        while len(word):
            used, state = np.unique(state, return_inverse=True)
            low, size = low[used], size[used]
            parent, letter, grown, count, _ = self.backward.grow(low, size)
            first = np.searchsorted(parent, np.arange(len(used)))
            n = np.searchsorted(parent, np.arange(len(used)), side="right") - first
            more = at < lengths[word]
            right = np.where(more, asked[word, np.minimum(at, asked.shape[1] - 1)], 0)
            # every child of every string
            each = np.repeat(np.arange(len(word)), n[state])
            child = first[state][each] + np.arange(len(each)) - np.repeat(np.cumsum(n[state]) - n[state], n[state])
            real = letter[child] > 0
            each, child = each[real], child[real]
            one.append((word[each], at[each], grown[child], count[child]))  # inserted
            swap = more[each] & (letter[child] != right[each])
            one.append((word[each[swap]], at[each[swap]] + 1, grown[child[swap]], count[child[swap]]))  # replaced
            one.append((word[more], at[more] + 1, low[state[more]], size[state[more]]))  # left out
            out.extend(self._finish(asked, lengths, *map(np.concatenate, zip(*one))))
            one = []
            on = _join(parent, letter, state, right)
            go = more & (on >= 0)
            word, at, state = word[go], at[go] + 1, on[go]
            low, size = grown, count
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.concatenate(out))
        return np.divmod(pairs, len(self.owner))

    def _finish(self, asked: np.ndarray, lengths: np.ndarray, word: np.ndarray, at: np.ndarray, low: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
        """Match the letters left of each word, then the delimiter."""
        while len(word):
            last = at >= lengths[word]
            letter = np.where(last, 0, asked[word, np.minimum(at, asked.shape[1] - 1)])
            low, size = self.backward.step(low, size, letter)
            ended = last & (size > 0)
            if ended.any():
                yield word[ended] * len(self.owner) + self.owner[low[ended]]
            go = ~last & (size > 0)
            word, at, low, size = word[go], at[go] + 1, low[go], size[go]


def _codes(words: list[str], backwards: bool, alphabet: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], np.int64)
    out = np.zeros((len(words), int(lengths.max(initial=1))), np.int64)
    for row, w in enumerate(words):
        out[row, :len(w)] = [alphabet[c] for c in (w[::-1] if backwards else w)]
    return out, lengths


def near_words(words: list[str], asked: list[str], backwards: bool = False) -> Iterator[tuple[int, int]]:
    """Pairs (number in ``asked``, number in ``words``) one edit apart, where the first half of the asked word is right.

    ``backwards``: the second half.  ``words`` are distinct.  The first half
    has half the letters, rounded down; the second half the others.
    """
    if not words or not asked:
        return
    alphabet = {c: k + 1 for k, c in enumerate(sorted(set("".join(words)) | set("".join(asked))))}
    grid, lengths = _codes(words, backwards, alphabet)
    index = Index([grid[i, :n] for i, n in enumerate(lengths.tolist())], len(alphabet) + 1)
    for start in range(0, len(asked), ASKING):
        letters, n = _codes(asked[start:start + ASKING], backwards, alphabet)
        half = n - n // 2 if backwards else n // 2
        for a, b in zip(*(x.tolist() for x in index.near(letters, n, half))):
            yield start + a, b


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 5, every: int = 199) -> DataFrame:
    """``word, n``: words of at least six letters and ``least`` occurrences in whole texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased.  A
    run loses a letter where ``every`` divides h, the CRC-32 of
    ``<doc_id>:<run>`` (a null doc_id is written as nothing): the one at h
    modulo its length.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = F.regexp_extract_all(F.translate(F.col(text), upper, upper.lower()), F.lit(LETTERS), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    # a run of fewer letters gives no word, whether it loses one or not
    rows = rows.filter(F.length("run") >= SHORTEST).withColumn("h", F.crc32(F.concat("d", F.lit(":"), "run")))
    cut = F.pmod(F.col("h"), F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return (rows.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter((F.length("word") >= SHORTEST) & (F.col("n") >= least)))


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: all ordered pairs of the distinct words in ``words`` (``word, n``) one edit apart.

    Words need six code points; shorter ones and null are left out.
    """
    words = words.filter(F.length("word") >= SHORTEST)
    total = words.count()
    buckets = max(1, math.ceil(2 * total / INDEX_WORDS))
    ends: list[Column] = [F.substring("word", 1, DEALT_BY), F.reverse(F.substring(F.reverse("word"), 1, DEALT_BY))]
    sides = F.explode(F.array(*[F.struct(F.lit(bool(k)).alias("backwards"), e.alias("end")) for k, e in enumerate(ends)]))
    dealt = words.select("word", "n", sides.alias("s")).select(
        "word", "n", F.col("s.backwards").alias("backwards"), F.pmod(F.xxhash64("s.backwards", "s.end"), F.lit(buckets)).alias("bucket"))
    # a row for each bucket
    sizes = dealt.groupBy(F.col("backwards").alias("b"), F.col("bucket").alias("k")).agg(F.ceil(F.count(F.lit(1)) / INDEX_WORDS).cast("int").alias("parts"))
    placed = dealt.join(sizes, (F.col("backwards") == F.col("b")) & (F.col("bucket") == F.col("k")))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    # every index of the bucket is asked by all its words, in portions of their own
    placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = placed.withColumn("portion", F.explode(F.when(F.col("own") == F.col("part"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))))

    def run(table: pa.Table) -> pa.Table:
        part, portion = table.column("part")[0].as_py(), table.column("portion")[0].as_py()
        own = np.asarray(table.column("own"))
        word, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        held = np.flatnonzero(own == part).tolist()
        asking = np.flatnonzero(own == portion).tolist()
        found = list(near_words([word[i] for i in held], [word[i] for i in asking], table.column("backwards")[0].as_py()))
        return pa.table({"word": pa.array([word[asking[a]] for a, _ in found], pa.string()), "near": pa.array([word[held[b]] for _, b in found], pa.string()),
                         "near_n": pa.array([n[held[b]] for _, b in found], pa.int64())})

    pairs = (rows.select("word", "n", "backwards", "bucket", "part", "portion", "own").groupBy("backwards", "bucket", "part", "portion")
             .applyInArrow(run, "word string, near string, near_n long"))
    # an edit between the halves is found from both sides
    return pairs.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word: forms followed to the last. Counts grow fivefold along a chain, so it ends."""
    now = store(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        above = now.select(F.col("word").alias("w"), F.col("root").alias("up"))
        jumped = store(now.join(above, F.col("root") == F.col("w")).select("word", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "roots")
        now = jumped.drop("moved")
        if not jumped.filter("moved").limit(1).count():
            return now


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 5, times: int = 5, every: int = 199) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the vocabulary.

    ``n_near``: words one inserted, deleted or replaced code point away.
    ``form``: of these the most frequent (ties: the smallest by code point),
    if it occurs at least ``times`` times as often as the word, else null.
    ``root``: forms followed to the last one.

    Null and empty texts have no words; repeated rows count again; a text of
    any length is taken whole; other columns are ignored; an empty table
    gives no rows.
    """
    words = store(vocabulary(docs, doc_id, text, least, every), "vocabulary")
    pairs = store(near_pairs(words), "near_words")
    # UTF-8 strings are compared by code point
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = pairs.groupBy(F.col("word").alias("w")).agg(F.count(F.lit(1)).alias("found"), best)
    joined = words.join(near, F.col("word") == F.col("w"), "left")
    taken = F.coalesce(-F.col("best.less") >= times * F.col("n"), F.lit(False))
    forms = store(joined.select("word", "n", F.coalesce("found", F.lit(0)).cast("long").alias("n_near"),
                                F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(forms).withColumnRenamed("word", "w")
    return forms.join(roots, F.col("word") == F.col("w")).select("word", "form", "root", "n", "n_near", "form_n")
