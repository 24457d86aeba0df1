"""The bidirectional index against all edits, and variants against plain counting."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import spelling

KIND = "doc_id long, text string, lang string"


def one_edit(a, b):
    """Whether exactly one inserted, deleted or replaced letter parts two words."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = {}
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def salad(rng, n, letters="abé", least=6, most=10):
    return sorted({"".join(rng.choice(list(letters), rng.integers(least, most + 1))) for _ in range(n)})


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijklmnop"])
def test_search_finds_exactly_the_words_one_edit_away(letters):
    words = salad(np.random.default_rng(len(letters)), 500, letters)
    found = {p for back in (False, True) for p in spelling.near_words(words, words, back)}
    assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b)}


def test_each_search_keeps_its_half_exact():
    words = salad(np.random.default_rng(7), 300, "ab")
    for i, j in spelling.near_words(words, words):
        assert words[j].startswith(words[i][:len(words[i]) // 2])
    for i, j in spelling.near_words(words, words, True):
        assert words[j].endswith(words[i][len(words[i]) // 2:])


def test_one_word_and_runs_of_one_letter():
    assert list(spelling.near_words(["aaaaaa"], ["aaaaaa"])) == []
    words = ["a" * k for k in range(6, 12)]
    found = {p for back in (False, True) for p in spelling.near_words(words, words, back)}
    assert found == {(i, j) for i in range(6) for j in range(6) if abs(i - j) == 1}


def corpus(rng):
    words = salad(rng, 60, "abc") + ["Straßen", "straßen", "ÉcoleÉs", "écoleés", "colour", "color", "colours"]
    rows = [(int(i), " ".join(rng.choice(words, 40, p=(w := rng.pareto(1, len(words)) + 0.05) / w.sum())), "en") for i in rng.integers(0, 500, 120)]
    return rows + [(None, "colours colours COLOURS colourz", None), (3, None, "en"), (4, "", "en"), (5, " 12 ;", "en"), (6, "colour\n" * 3000, "en")]


@pytest.mark.parametrize("size", [spelling.INDEX_WORDS, 12])
def test_variants_match_brute_force(spark, monkeypatch, size):
    """With indexes of 12 words every bucket is cut into several."""
    monkeypatch.setattr(spelling, "INDEX_WORDS", size)
    rows = corpus(np.random.default_rng(11))
    df = spark.createDataFrame(rows, KIND).select("*", *[F.lit(1).alias(c) for c in ("word", "n", "run", "h", "d")])
    got = sorted(map(tuple, spelling.variants(df.repartition(4)).collect()))
    assert got == brute(rows) and any(r[1] for r in got)


def test_chains_are_followed_to_the_last(spark):
    rows = [(1, "abcdef " * 5 + "abcdeg " * 30 + "abcdhg " * 200 + "abcihg " * 2000, "en")]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(spark.createDataFrame(rows, KIND)).collect()}
    assert got == {r[0]: (r[1], r[2]) for r in brute(rows)}
    assert got["abcdef"] == ("abcdeg", "abcihg")


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], KIND)).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None, None), (2, "short", None)], KIND)).collect() == []
