"""Toxicity scores from a bidirectional gated recurrent network.

A word enters as a vector of its own and the sum of vectors of its
character n-grams (3 to 5, with marks at the word's ends), so that an
unseen form of a known stem has a meaning.  Two gated recurrent units read
a window of words forward and backward, attention pools their states, and a
logistic layer scores the window.  Windows overlap by half and cover the
whole text; a text's score is that of its worst window.

The network is written and trained in numpy.  Labels are of texts, not of
windows: a labelled text teaches through its windows of the highest score,
chosen anew in each round.  The training sample is bounded by parameters:
so many labelled texts of each class, so many windows of each.  Rounds,
batches and their make-up (a quarter toxic) are parameters too, so training
costs the same at every size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import MEMO_BYTES, MEMO_ENTRY, bytes_of, held, number_of, numbered, pieces, small_batches, store

WORD_ROWS, GRAM_ROWS = 1 << 14, 1 << 16
GRAMS = (3, 4, 5)
#: Windows scored at once.
LANES = 2048
#: Words whose n-grams are worked on at once.
CHUNK = 20_000


@dataclass(frozen=True)
class Settings:
    """``toxic``, ``clean``: labelled texts of each class in the training sample; ``toxic_windows``,
    ``clean_windows``: windows of each; ``slow``: the vectors' share of the learning rate."""

    window: int = 32
    stride: int = 16
    toxic: int = 2000
    clean: int = 4000
    toxic_windows: int = 24
    clean_windows: int = 8
    width: int = 8
    hidden: int = 12
    attention: int = 8
    rounds: int = 5
    batches: int = 80
    batch: int = 128
    rate: float = 0.05
    slow: float = 0.1
    seed: int = 7


def words(raw: bytes) -> list[bytes]:
    """Lower-cased words: ASCII signs part them, as white space does; all other bytes belong to words."""
    return raw.translate(_WORDS).split()


_WORDS = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def windows(n: int, window: int, stride: int) -> list[tuple[int, int]]:
    """Overlapping ranges that cover ``n`` words; one empty range for none."""
    if n <= window:
        return [(0, n)]
    starts = list(range(0, n - window, stride)) + [n - window]
    return [(i, i + window) for i in starts]


def gram_rows(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-gram table for all words, one word after the other, and where each word's begin."""
    if len(vocabulary) > CHUNK:
        parts = [gram_rows(vocabulary[i:i + CHUNK]) for i in range(0, len(vocabulary), CHUNK)]
        before = np.cumsum([0, *(len(r) for r, _ in parts)])
        return np.concatenate([r for r, _ in parts]), np.concatenate([at + n for (_, at), n in zip(parts, before)])
    marked = [(b"\x02" + w + b"\x03").ljust(3, b"\x03") for w in vocabulary]
    flat = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) for w in marked], np.int64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(marked)), sizes)
    rows, owners = [], []
    for n in GRAMS:
        at = np.flatnonzero(np.arange(len(flat)) + n <= ends)
        hashed = np.full(len(at), n, np.uint64)
        for k in range(n):
            hashed = (hashed ^ flat[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        rows.append((hashed >> np.uint64(48)).astype(np.int32))
        owners.append(owner[at])
    rows, owners = np.concatenate(rows), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.searchsorted(owners[order], np.arange(len(marked)))


def word_rows(vocabulary: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(w) & (WORD_ROWS - 1) for w in vocabulary], np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _by_row(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in ``index`` and the sum of the values of each."""
    order = np.argsort(index, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], np.diff(index[order]) != 0)))
    return index[order][starts], np.add.reduceat(values[order], starts, axis=0)


class Network:
    """Parameters by name; ``score`` and ``learn`` work on windows of word vectors."""

    def __init__(self, s: Settings, parameters: dict[str, np.ndarray] | None = None):
        self.s = s
        rng = np.random.default_rng(s.seed)
        d, h, a = 2 * s.width, s.hidden, s.attention
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, np.float32)
        self.p = parameters or {
            "word": 0.05 * draw(WORD_ROWS, s.width) * np.sqrt(WORD_ROWS).astype(np.float32), "gram": 0.05 * draw(GRAM_ROWS, s.width) * np.sqrt(GRAM_ROWS).astype(np.float32),
            **{f"{k}{way}": v for way in "fb" for k, v in (("W", draw(d, 3 * h)), ("U", draw(h, 3 * h)), ("b", zero(3 * h)))},
            "Wa": draw(2 * h, a), "ba": zero(a), "va": draw(a), "wo": draw(2 * h), "bo": np.full(1, -2.0, np.float32)}

    def vectors(self, vocabulary: list[bytes]) -> np.ndarray:
        """Each word's own vector and the scaled sum of its n-grams' vectors."""
        if len(vocabulary) > CHUNK:
            return np.concatenate([self.vectors(vocabulary[i:i + CHUNK]) for i in range(0, len(vocabulary), CHUNK)])
        rows, starts = gram_rows(vocabulary)
        counts = np.diff(np.append(starts, len(rows)))
        summed = np.add.reduceat(self.p["gram"][rows], starts, axis=0) / np.sqrt(counts)[:, None].astype(np.float32)
        return np.concatenate((self.p["word"][word_rows(vocabulary)], summed), axis=1)

    def inputs(self, vectors: np.ndarray) -> np.ndarray:
        """What each word gives to the units of both directions."""
        return np.concatenate((vectors @ self.p["Wf"] + self.p["bf"], vectors @ self.p["Wb"] + self.p["bb"]), axis=1)

    def _unit(self, x: list[np.ndarray], held: list[np.ndarray] | None, u: np.ndarray, keep: list | None) -> list[np.ndarray]:
        h = self.s.hidden
        state = np.zeros((len(x[0]), h), np.float32)
        out = []
        for t, now in enumerate(x):
            turned = state @ u
            gates = _sigmoid(now[:, :2 * h] + turned[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            fresh = np.tanh(now[:, 2 * h:] + r * turned[:, 2 * h:])
            following = fresh + z * (state - fresh)
            if held is not None:  # a window's end keeps its state
                following = np.where(held[t], following, state)
            if keep is not None:
                keep.append((state, z, r, fresh, turned[:, 2 * h:]))
            state = following
            out.append(state)
        return out

    def forward(self, table: np.ndarray, at: np.ndarray, sizes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Scores (logits) of windows: ``at`` (windows, words) numbers rows of ``table``; words from ``sizes`` on don't count."""
        steps, h = at.shape[1], self.s.hidden
        full = bool((sizes == steps).all())
        real = np.arange(steps) < sizes[:, None]
        held = None if full else [real[:, t:t + 1] for t in range(steps)]
        x = [table[at[:, t]] for t in range(steps)]
        saved: tuple[list, list] | tuple[None, None] = ([], []) if keep is not None else (None, None)
        ahead = self._unit([v[:, :3 * h] for v in x], held, self.p["Uf"], saved[0])
        back = self._unit([v[:, 3 * h:] for v in x[::-1]], None if full else held[::-1], self.p["Ub"], saved[1])[::-1]
        states = np.stack([np.concatenate(v, axis=1) for v in zip(ahead, back)], axis=1)
        turned = np.tanh(states @ self.p["Wa"] + self.p["ba"])
        weights = np.exp(np.minimum(turned @ self.p["va"], 30.0)) * real
        weights /= np.maximum(weights.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("bt,bth->bh", weights, states)
        if keep is not None:
            keep.update(real=real, held=held, saved=saved, states=states, turned=turned, weights=weights, pooled=pooled)
        return pooled @ self.p["wo"] + self.p["bo"][0]

    def _unit_back(self, gradient: list[np.ndarray], held, u: np.ndarray, saved: list) -> tuple[list[np.ndarray], np.ndarray]:
        carry, du = np.zeros_like(gradient[0]), np.zeros_like(u)
        out: list[np.ndarray] = [None] * len(gradient)
        for t in range(len(gradient) - 1, -1, -1):
            state, z, r, fresh, turned = saved[t]
            g = gradient[t] + carry
            stay = np.zeros_like(g)
            if held is not None:
                stay, g = np.where(held[t], 0, g), np.where(held[t], g, 0)
            d_fresh = g * (1 - z) * (1 - fresh * fresh)
            d_z = g * (state - fresh) * z * (1 - z)
            d_r = d_fresh * turned * r * (1 - r)
            d_turned = np.concatenate((d_z, d_r, d_fresh * r), axis=1)
            du += state.T @ d_turned
            out[t] = np.concatenate((d_z, d_r, d_fresh), axis=1)
            carry = g * z + d_turned @ u.T + stay
        return out, du

    def gradients(self, vectors: np.ndarray, at: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Gradients of the mean log loss; ``vectors`` among them for the words' vectors."""
        k: dict = {}
        logits = self.forward(self.inputs(vectors), at, sizes, k)
        p, h = self.p, self.s.hidden
        chance = _sigmoid(logits)
        d_logit = ((chance - labels) / len(labels)).astype(np.float32)
        g = {"wo": k["pooled"].T @ d_logit, "bo": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["wo"]
        d_states = k["weights"][:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("bh,bth->bt", d_pooled, k["states"])
        d_score = k["weights"] * (d_weight - (k["weights"] * d_weight).sum(1, keepdims=True))
        d_turned = d_score[:, :, None] * p["va"] * (1 - k["turned"] ** 2)
        g["va"] = np.einsum("bt,bta->a", d_score, k["turned"])
        g["ba"] = d_turned.sum((0, 1))
        g["Wa"] = np.einsum("bth,bta->ha", k["states"], d_turned)
        d_states += d_turned @ p["Wa"].T
        steps = at.shape[1]
        ahead, g["Uf"] = self._unit_back([d_states[:, t, :h] for t in range(steps)], k["held"], p["Uf"], k["saved"][0])
        back, g["Ub"] = self._unit_back([d_states[:, t, h:] for t in range(steps)][::-1], None if k["held"] is None else k["held"][::-1], p["Ub"], k["saved"][1])
        each = np.stack([np.concatenate(x, axis=1) for x in zip(ahead, back[::-1])], axis=1).reshape(-1, 6 * h)
        touched, total = _by_row(at.ravel(), each)
        d_inputs = np.zeros((len(vectors), 6 * h), np.float32)
        d_inputs[touched] = total
        g["Wf"], g["Wb"] = vectors.T @ d_inputs[:, :3 * h], vectors.T @ d_inputs[:, 3 * h:]
        g["bf"], g["bb"] = d_inputs[:, :3 * h].sum(0), d_inputs[:, 3 * h:].sum(0)
        g["vectors"] = d_inputs[:, :3 * h] @ p["Wf"].T + d_inputs[:, 3 * h:] @ p["Wb"].T
        loss = -np.mean(np.log(np.maximum(np.where(labels > 0.5, chance, 1 - chance), 1e-9)))
        return g, float(loss)


class Sample:
    """Training windows, each with its text's number and label, over one vocabulary."""

    def __init__(self, texts: list[tuple[int, list[list[bytes]]]], s: Settings):
        vocabulary: dict[bytes, int] = {}
        at, sizes, self.text, labels = [], [], [], []
        for i, (label, own) in enumerate(texts):
            labels.append(label)
            for w in own:
                row = [vocabulary.setdefault(x, len(vocabulary)) for x in w]
                at.append(row + [0] * (s.window - len(row)))
                sizes.append(len(row))
                self.text.append(i)
        vocabulary.setdefault(b"", len(vocabulary))
        self.words = list(vocabulary)
        self.at, self.sizes = np.array(at, np.int64).reshape(-1, s.window), np.array(sizes, np.int64)
        self.text, self.labels = np.array(self.text, np.int64), np.array(labels, np.float32)
        self.word_rows = word_rows(self.words)
        self.gram_rows, self.gram_starts = gram_rows(self.words)
        self.gram_of = np.repeat(np.arange(len(self.words)), np.diff(np.append(self.gram_starts, len(self.gram_rows))))

    def evidence(self) -> tuple[np.ndarray, np.ndarray]:
        """Shrunk log odds of the texts that have a word or an n-gram, by row of either table."""
        share = max(float(self.labels.mean()), 1e-6) if len(self.labels) else 0.5
        bad = [np.zeros(WORD_ROWS), np.zeros(GRAM_ROWS)]
        good = [np.zeros(WORD_ROWS), np.zeros(GRAM_ROWS)]
        starts = np.append(self.gram_starts, len(self.gram_rows))
        for i, label in enumerate(self.labels.tolist()):
            own = slice(*np.searchsorted(self.text, (i, i + 1)))  # windows follow their texts' order
            at, sizes = self.at[own], self.sizes[own]
            used = np.unique(at[np.arange(at.shape[1]) < sizes[:, None]])
            place, _ = _ranges(starts[used], starts[used + 1])
            into = bad if label > 0.5 else good
            into[0][np.unique(self.word_rows[used])] += 1
            into[1][np.unique(self.gram_rows[place])] += 1
        odds = [np.log((b + 8 * share) / (g + 8 * (1 - share) + 1e-9)) - np.log(share / (1 - share + 1e-9)) for b, g in zip(bad, good)]
        return tuple(np.clip(x, -1.0, 4.0).astype(np.float32) for x in odds)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range of each."""
    sizes = hi - lo
    which = np.repeat(np.arange(len(lo)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[which], which


def train(texts: list[tuple[int, list[list[bytes]]]], s: Settings = Settings()) -> Network:
    """A network trained on ``(label, windows)`` of texts.

    The vectors' first numbers start from the log odds of the words and
    n-grams.  Without texts of both classes the network stays as it began.
    """
    net = Network(s)
    data = Sample(texts, s)
    if len(np.unique(data.labels)) < 2:
        return net
    word, gram = data.evidence()
    net.p["word"][:, 0] = word
    net.p["gram"][:, 0] = gram
    rng = np.random.default_rng(s.seed)
    squares = {k: np.full_like(v, 1e-3) for k, v in net.p.items()}
    summed = np.add.reduceat(gram[data.gram_rows], data.gram_starts) / np.sqrt(np.diff(np.append(data.gram_starts, len(data.gram_rows))))
    hint = word[data.word_rows] + summed
    real = np.arange(s.window) < data.sizes[:, None]
    scores = np.where(real, hint[data.at], -9.0).max(1)
    for turn in range(s.rounds):
        # a toxic text teaches by its worst window, a clean one by its worst two and by any other
        order = np.lexsort((rng.random(len(scores)), -scores, data.text))
        first = np.concatenate(([True], np.diff(data.text[order]) != 0))
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        toxic = data.labels[data.text[order]] > 0.5
        kinds = [order[toxic & (place == 0)], order[~toxic & (place == 0)], order[~toxic & (place <= 1)], order[~toxic]]
        for _ in range(s.batches):
            rows = np.concatenate([rng.choice(k, s.batch // len(kinds)) for k in kinds])
            _step(net, data, rows, squares, s.rate * (1 if turn < s.rounds - 2 else 0.4))
        scores = score_windows(net, net.inputs(net.vectors(data.words)), data.at, data.sizes)
    return net


def _step(net: Network, data: Sample, rows: np.ndarray, squares: dict[str, np.ndarray], rate: float) -> None:
    used, at = np.unique(data.at[rows], return_inverse=True)
    at = at.reshape(len(rows), -1)
    starts = np.append(data.gram_starts, len(data.gram_rows))
    sizes = starts[used + 1] - starts[used]
    place, which = _ranges(starts[used], starts[used + 1])
    grams = data.gram_rows[place]
    scale = (1 / np.sqrt(sizes)).astype(np.float32)[:, None]
    own = data.word_rows[used]
    width = net.s.width
    summed = np.add.reduceat(net.p["gram"][grams], np.cumsum(sizes) - sizes, axis=0) * scale
    vectors = np.concatenate((net.p["word"][own], summed), axis=1)
    g, _ = net.gradients(vectors, at, data.sizes[rows], data.labels[data.text[rows]])
    d = g.pop("vectors")
    for name, index, gradient in (("word", own, d[:, :width]), ("gram", grams, (d[:, width:] * scale)[which])):
        touched, total = _by_row(index, gradient)
        squares[name][touched] += total * total
        net.p[name][touched] -= net.s.slow * rate * total / np.sqrt(squares[name][touched])
    for name, gradient in g.items():
        squares[name] += gradient * gradient
        net.p[name] -= (rate * gradient / np.sqrt(squares[name])).astype(np.float32)


def score_windows(net: Network, table: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Logits of windows, ``LANES`` at a time, full windows apart from shorter ones."""
    out = np.zeros(len(at), np.float32)
    full = sizes == at.shape[1]
    for group in (np.flatnonzero(full), np.flatnonzero(~full)):
        group = group[np.argsort(sizes[group], kind="stable")]
        for lo in range(0, len(group), LANES):
            own = group[lo:lo + LANES]
            steps = max(1, int(sizes[own].max()))
            out[own] = net.forward(table, at[own, :steps], sizes[own])
    return out


class Scorer:
    """Scores whole texts; what words give to the units is remembered."""

    def __init__(self, s: Settings, parameters: dict[str, np.ndarray]):
        self.net = Network(s, parameters)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {b"": 0}
        self.table = self.net.inputs(self.net.vectors([b""]))

    def score(self, texts: list[bytes]) -> list[float]:
        if self.table.nbytes + MEMO_ENTRY * len(self.number) > MEMO_BYTES:
            self.clear()
        s = self.net.s
        cut = [words(x) for x in texts]
        new = list({w for x in cut for w in x if w not in self.number})
        if new:
            first = len(self.table)
            self.number.update(zip(new, range(first, first + len(new))))
            self.table = np.concatenate((self.table, self.net.inputs(self.net.vectors(new))))
        number = self.number
        flat = np.array([number[w] for x in cut for w in x], np.int64)
        base, starts, sizes, owner = 0, [], [], []
        for i, x in enumerate(cut):
            for lo, hi in windows(len(x), s.window, s.stride):
                starts.append(base + lo)
                sizes.append(hi - lo)
                owner.append(i)
            base += len(x)
        starts, sizes, owner = np.array(starts, np.int64), np.array(sizes, np.int64), np.array(owner, np.int64)
        padded = np.concatenate((flat, np.zeros(s.window, np.int64)))
        at = padded[starts[:, None] + np.arange(s.window)]
        logits = score_windows(self.net, self.table, at, sizes)
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, owner, logits)
        return _sigmoid(worst).tolist()


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Rows that don't teach: crc32 of the id's text mod ``parts`` is 0. A row without an id doesn't teach either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, s: Settings, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> list[tuple[int, list[list[bytes]]]]:
    """The training sample: of each class the labelled texts with the smallest id hashes, of each text the windows
    with the smallest hashes (at most ``toxic_windows`` or ``clean_windows``, from the whole text)."""
    small_batches(docs.sparkSession)
    key = F.col(doc_id)
    marked = (labels.filter(key.isNotNull() & F.col(label).isNotNull() & ~held_out(key))
              .groupBy(key.cast("long").alias("l_id")).agg(F.max(F.col(label).cast("int")).alias("l_toxic")))
    have = store(docs.select(key.cast("long").alias("d_id"), F.xxhash64(F.col(text)).alias("d_hash")).filter("d_id is not null")
                 .groupBy("d_id").agg(F.min("d_hash").alias("d_hash")).join(marked, F.col("d_id") == F.col("l_id"))
                 .select("d_id", "d_hash", "l_toxic", F.xxhash64("d_id").alias("h")), "labelled")
    some = [have.filter(F.col("l_toxic") == k).orderBy("h", "d_id").limit(n).select("d_id", "d_hash", "l_toxic") for k, n in ((1, s.toxic), (0, s.clean))]
    picked = F.broadcast(some[0].union(some[1]))  # at most s.toxic + s.clean rows
    rows = (docs.select(key.cast("long").alias("id"), F.xxhash64(F.col(text)).alias("hash"), F.col(text).cast("binary").alias("raw"))
            .join(picked, (F.col("id") == F.col("d_id")) & (F.col("hash") == F.col("d_hash"))).select("id", F.col("l_toxic").alias("label"), "raw"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, raw in zip(batch.column(1).to_pylist(), bytes_of(batch.column(2))):
                own = words(raw)
                most = s.toxic_windows if label else s.clean_windows
                cut = [own[i:j] for i, j in windows(len(own), s.window, s.stride)]
                if len(cut) > most:
                    cut = sorted(cut, key=lambda w: xxhash.xxh64_intdigest(b" ".join(w)))[:most]
                out.append([b" ".join(w) for w in cut])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))], ["id", "label", "windows"])

    found = {r["id"]: r for r in rows.mapInArrow(run, "id long, label int, windows array<binary>").toLocalIterator()}  # repeated rows once
    return [(found[i]["label"], [bytes(w).split() for w in found[i]["windows"]]) for i in sorted(found)]


def _scorer(s: Settings, parameters) -> Scorer:
    return held(("toxicity", s, parameters), lambda: Scorer(s, parameters.value))


def annotate(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
             score: str = "__toxic_score") -> DataFrame:
    """``docs`` with each text's score in 0 to 1 added.

    Trains on the labelled texts of ``docs`` that aren't held out.  Only the
    text is an input.  Null and empty texts get the score of an empty
    window.  Without labels of both classes all scores come from the
    untrained network.  Repeated rows are scored each; a column of ``docs``
    named like the score gives way.
    """
    docs = docs.drop(score)
    net = train(sample(docs, labels, s, doc_id, text, label), s)
    parameters = docs.sparkSession.sparkContext.broadcast(net.p)
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces([batch], text):
                found = _scorer(s, parameters).score(bytes_of(part.column(at).cast(pa.binary())))
                yield part.append_column(pa.field(score, pa.float64()), pa.array(found, pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())]))


def keep(docs: DataFrame, labels: DataFrame, most: float = 0.5, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that score below ``most``, repeated ones each, with all their columns whatever their names."""
    own = numbered(docs)
    known = labels.select(F.col(doc_id).alias(number_of(docs, doc_id)), F.col(label).alias("toxic"))
    kept = annotate(own, known, s, number_of(docs, doc_id), number_of(docs, text), "toxic").filter(F.col("__toxic_score") < most)
    return kept.select(*own.columns).toDF(*docs.columns)
