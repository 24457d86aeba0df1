import random

import numpy as np

from starloom.llm import lm_mix
from tests.llm.cases import documents


def _flat(found):
    return np.frombuffer(b"".join(found), np.uint8), np.array([len(x) for x in found], np.int64)


def test_unseen_words_stay_unseen_in_a_large_vocabulary(spark):
    """What the last predictor knows has no slots that unseen words could share."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    texts = [" ".join(word() for _ in range(400)) for _ in range(60)]
    rows = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)]).selectExpr("doc_id", "false held_out", "cast(text as binary) raw")
    counted = lm_mix._unit_counts(lm_mix._chunks(rows, rows.schema["doc_id"].dataType)).collect()
    every, which, _ = lm_mix.units([t.encode() for t in texts])
    assert {bytes(r.unit): r.n for r in counted} == dict(zip(every, np.bincount(which).tolist()))

    found, n = [bytes(r.unit) for r in counted], np.array([r.n for r in counted])
    code = lm_mix.Code([1] * 256)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros(0, np.int64)
    known = lm_mix.Known(code, *_flat(found), n, [], none)
    assert len(known.contexts) == len({u[:i] for u in found for i in range(len(u))})
    asked = b"zzzzzzzzzzz "
    codes, bits, words = known.answer(*_flat([asked]))
    first = sum(code.sizes[b] for b in asked[:max(i for i in range(len(asked)) if any(u.startswith(asked[:i]) for u in found)) + 1])
    assert bits.tolist() == [len(codes)] and (codes[first:] == lm_mix.UNSEEN).all() and codes[0] != lm_mix.UNSEEN and words.tolist() == [0]


def test_ranges_of_units_are_bounded_and_cover_all(spark):
    data = [(i, " ".join(f"w{i}x{k}" for k in range(200)), "en", "s", 0) for i in range(20)]
    rows = documents(spark, data).selectExpr("doc_id", "false held_out", "cast(text as binary) raw")
    counted = lm_mix._unit_counts(lm_mix._chunks(rows, rows.schema["doc_id"].dataType)).withColumnRenamed("unit", "raw").cache()
    n = counted.count()
    ends = lm_mix._range_ends(counted, n, 10)
    assert ends == sorted(set(ends)) and 5 <= len(ends) <= 9
    held = np.bincount([sum(e <= bytes(r.raw) for e in ends) for r in counted.collect()])
    assert held.sum() == n and held.max() < n / 3
