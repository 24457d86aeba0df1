import math
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from starloom.llm import fertility
from tests.llm.cases import documents, prose, rows

FILES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILES[0])


def brute(text):
    raw = text or ""
    for c in "\t\n\x0b\x0c\r":
        raw = raw.replace(c, " ")
    words = [w for w in raw.split(" ") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    tokens = [t for w in words for t in LIBRARY.encode(w)]
    counts = Counter(tokens)
    entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in counts.values()) if tokens else 0.0
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit), failed,
            len(tokens), sum(LIBRARY.is_byte(t) for t in tokens), entropy)


def test_measures_match_brute_force(spark):
    import random
    rng = random.Random(9)
    part = prose(rng, 12)
    data = rows() + [(300, f"{part}\nx\n{part}\n\n{part} y\nx\n", "en", "s", 0), (301, "a b c d e f g h " * 9, "en", "s", 0),
                     (302, "#*$ %&| <a> 漢字 \U0001f600 " + prose(rng, 40), "en", "s", 0)]
    got = fertility.annotate(documents(spark, data, clash=("n_words", "kept")), *FILES).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "tokens", "fallback", "entropy")
    for r in got:
        want = brute(r.text)
        found = tuple(r["__q_" + n] for n in names)
        assert found[:-1] == want[:-1], r.doc_id
        assert found[-1] == pytest.approx(want[-1], abs=1e-9)


def test_bands_part_prose_from_salad(spark):
    import duckdb
    from tests.conftest import SMALL
    sf = SMALL.replace("0.001", "0.01")
    bad = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    label = dict(bad)
    kept = {r.doc_id for r in fertility.keep(spark.read.parquet(f"{sf}/documents.parquet"), *FILES).collect()}
    measured = fertility.annotate(spark.read.parquet(f"{sf}/documents.parquet"), *FILES).select("doc_id", "__q_base_failed").collect()
    passed = {r.doc_id for r in measured if not r["__q_base_failed"]}
    clean = [d for d, q in label.items() if q == 1 and d in passed]
    salad = [d for d, q in label.items() if q == 0 and d in passed]
    assert all(d in kept for d in clean) and sum(d in kept for d in salad) <= 0.25 * len(salad)


def test_columns_bands_and_empty(spark):
    df = documents(spark, clash=("tokens",))
    left = fertility.keep(df, *FILES)
    assert left.columns == df.columns
    assert fertility.annotate(documents(spark, []), *FILES).count() == 0
    strict = {k: fertility.Band(99.0, 0.0, ((0, 0.0), (1, 0.0))) for k in ("en", "fr", "de")}
    assert all(r.lang not in strict for r in fertility.keep(df, *FILES, bands=strict).collect())


def test_short_texts_are_too_short_for_a_band_by_parameter():
    strict = fertility.Band(99.0, 0.0, ((0, 0.0), (1, 0.0)))
    assert fertility.in_band(strict, 40, 20, 0, 20, 4.0) and not fertility.in_band(strict, 40, 32, 0, 32, 4.0)
    assert not fertility.in_band(strict, 40, 20, 0, 20, 4.0, least_tokens=0)
