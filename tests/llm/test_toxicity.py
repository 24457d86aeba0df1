import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.llm import toxicity
from tests.llm.cases import documents, rows

TINY = toxicity.Settings(window=6, stride=3, width=3, hidden=4, attention=3, toxic=60, clean=90, rounds=2, batches=20, batch=32)


def test_windows_cover_all_words():
    for n in range(0, 90):
        found = toxicity.windows(n, 32, 16)
        assert sorted({i for a, b in found for i in range(a, b)}) == list(range(n)) and all(b - a <= 32 for a, b in found)
        assert all(b[0] - a[0] <= 16 for a, b in zip(found, found[1:]))


def test_gradients_match_differences():
    net = toxicity.Network(TINY)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((7, 2 * TINY.width))
    at, sizes, labels = rng.integers(0, 7, (5, 6)), np.array([6, 3, 1, 6, 0]), np.array([1.0, 0, 1, 0, 1])
    g, _ = net.gradients(vectors, at, sizes, labels)
    for name in ("Wf", "Ub", "bf", "Wa", "ba", "va", "wo", "bo", "vectors", "Uf", "Wb"):
        target = vectors if name == "vectors" else net.p[name]
        for _ in range(4):
            i = tuple(rng.integers(0, d) for d in target.shape)
            old = target[i]
            ends = []
            for step in (1e-3, -1e-3):
                target[i] = old + step
                ends.append(net.gradients(vectors, at, sizes, labels)[1])
            target[i] = old
            assert g[name][i] == pytest.approx((ends[0] - ends[1]) / 2e-3, abs=2e-4), name


def corpus():
    rng = random.Random(8)
    plain = [f"{a}{b}{c}" for a in "bdgk" for b in "aeiou" for c in "nrst"]
    data, labels = [], []
    for i in range(240):
        words = rng.choices(plain, k=rng.choice([4, 20, 70]))
        bad = i % 3 == 0
        for _ in range(1 + len(words) // 12 if bad else 0):
            words[rng.randrange(len(words))] = "zwolx" + rng.choice(["", "en", "us", "ya", "iro"])
        data.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    return data, labels


def test_learns_stems_and_leaves_clean_texts(spark):
    data, labels = corpus()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    s = toxicity.Settings(rounds=3, batches=40)
    got = toxicity.annotate(documents(spark, data), marks, s).collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = [(r["__toxic_score"] >= 0.5) == (r.doc_id % 3 == 0) for r in held]
    assert len(held) > 30 and sum(right) >= 0.95 * len(held)


def test_all_rows_edges_and_held_out(spark):
    df = documents(spark, clash=("score", "toxic"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, None), (None, 1), (3, 0), (100, 0), (109, 1)], "doc_id long, toxic int")
    got = toxicity.annotate(df, labels, TINY)
    assert got.columns == [*df.columns, "__toxic_score"] and got.count() == len(rows())
    assert all(0 <= r["__toxic_score"] <= 1 for r in got.collect())
    again = {(r.doc_id, r.text): r["__toxic_score"] for r in toxicity.annotate(df.repartition(1), labels, TINY).collect()}
    assert all(again[r.doc_id, r.text] == pytest.approx(r["__toxic_score"], abs=1e-4) for r in got.collect())
    assert toxicity.annotate(documents(spark, []), labels, TINY).count() == 0
    assert toxicity.keep(df, labels.limit(0), s=TINY).columns == df.columns
    flags = {r.doc_id: r.h for r in df.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(v == (k is None or zlib.crc32(str(k).encode()) % 5 == 0) for k, v in flags.items())


def brute_score(raw, s, p):
    """A text's score, window by window, word by word and number by number."""
    cut, word = [], b""
    for b in raw + b" ":
        c = chr(b).lower() if b < 128 else None
        if c is not None and not (c.isalnum()):
            if word:
                cut.append(word)
            word = b""
        else:
            word += bytes([b]) if c is None else c.encode()

    def vector(w):
        marked = b"\x02" + w + b"\x03"
        marked += b"\x03" * (3 - len(marked))
        rows = []
        for n in toxicity.GRAMS:
            for i in range(len(marked) - n + 1):
                h = n
                for x in marked[i:i + n]:
                    h = (h ^ x) * 0x9E3779B97F4A7C15 % 2 ** 64
                rows.append(h >> 48)
        own = p["word"][xxhash.xxh32_intdigest(w) % toxicity.WORD_ROWS].astype(float)
        return np.concatenate((own, sum(p["gram"][r].astype(float) for r in rows) / len(rows) ** 0.5))

    def run(vectors, way):
        h, state, out = s.hidden, np.zeros(s.hidden), []
        w, u, b = (p[k + way].astype(float) for k in "WUb")
        for v in vectors:
            x, turned = v @ w + b, state @ u
            z, r = (1 / (1 + np.exp(-(x[i * h:(i + 1) * h] + turned[i * h:(i + 1) * h]))) for i in (0, 1))
            fresh = np.tanh(x[2 * h:] + r * turned[2 * h:])
            state = (1 - z) * fresh + z * state
            out.append(state)
        return out

    best, lo = -np.inf, 0
    while True:
        hi = min(lo + s.window, len(cut))
        vectors = [vector(w) for w in cut[lo:hi]]
        states = [np.concatenate(x) for x in zip(run(vectors, "f"), run(vectors[::-1], "b")[::-1])]
        heat = [np.exp(np.tanh(x @ p["Wa"].astype(float) + p["ba"]) @ p["va"]) for x in states]
        pooled = sum(a * x for a, x in zip(heat, states)) / sum(heat) if states else np.zeros(2 * s.hidden)
        best = max(best, float(pooled @ p["wo"] + p["bo"][0]))
        if hi == len(cut):
            return 1 / (1 + np.exp(-best))
        lo = min(lo + s.stride, len(cut) - s.window)


@pytest.mark.parametrize("s", [TINY, toxicity.Settings()])
def test_scores_match_brute_force(s):
    rng = random.Random(4)
    net = toxicity.Network(s)
    draw = np.random.default_rng(9)
    for k in ("bf", "bb", "ba"):  # nothing is zero, as after training
        net.p[k] = draw.standard_normal(net.p[k].shape).astype(np.float32)
    net.p["wo"] *= 3
    texts = ["", " \n.,;!", "One", "a", "\u00c0\u00c9 \u00df\u4e2d\u6587 x\u00a0y", "it's x-ray 42%", "b" * 3000]
    texts += [" ".join(rng.choice("ab") * rng.randrange(1, 9) + str(rng.randrange(30)) for _ in range(n)) for n in (2, 5, 6, 7, 9, 31, 32, 33, 47, 48, 49, 80, 200)]
    raw = [t.encode() for t in texts]
    got = toxicity.Scorer(s, net.p).score(raw)
    assert got == pytest.approx([brute_score(x, s, net.p) for x in raw], abs=2e-5)
    assert max(got) - min(got) > 0.05
