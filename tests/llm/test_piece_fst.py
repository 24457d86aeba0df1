import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from starloom.llm import piece_fst
from tests.llm.cases import documents, rows

FILE = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def machine():
    with open(FILE, "rb") as f:
        return piece_fst.Machine(f.read())


def as_ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def texts():
    rng = random.Random(4)
    letters = "aaabbcdeeiimnorsstuu   \n\n\t\r▁.,;'\x00é漢😀ABTheß\x0b\x7f́"
    out = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(6000)]
    out += ["a" * k for k in range(70)] + [" " * k for k in range(70)] + ["▁" * k for k in range(20)] + ["\n" * k for k in range(5)]
    out += [" ".join(rng.choices(["internationalization", "the", "thththere", "aaaa", "hello,world", "Été"], k=300)), "ab" * 3000, "x" * 5000]
    return out


def test_ids_are_the_librarys(machine):
    all_texts = texts()
    found = machine.encode([t.encode() for t in all_texts])
    for t, raw in zip(all_texts, found):
        assert as_ids(raw) == LIBRARY.encode(t), t


def test_decoding_is_the_librarys(machine):
    for t in texts()[:2000]:
        ids = LIBRARY.encode(t)
        assert machine.decode(ids).decode() == LIBRARY.decode(ids) == t.replace("▁", " ")


def message(fields):
    out = b""
    for number, kind, value in fields:
        out += bytes([number << 3 | kind]) if number < 16 else bytes([number << 3 & 127 | kind | 128, number >> 4])
        out += bytes([value]) if kind == 0 else struct.pack("<f", value) if kind == 5 else bytes([len(value)]) + value
    return out


def unigram(pieces):
    own = [message([(1, 2, s.encode()), (2, 5, score), (3, 0, kind)]) for s, score, kind in pieces]
    return message([(1, 2, p) for p in own] + [(2, 2, message([(3, 0, 1)])), (3, 2, message([(3, 0, 1), (4, 0, 0)]))])


def test_unigram_model_takes_the_cheapest_path():
    parts = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("a", -2.0, 1), ("b", -2.5, 1), ("c", -4.0, 1), ("ab", -3.0, 1), ("bc", -2.2, 1), ("▁a", -3.5, 1), ("abc", -9.0, 1)]
    m = piece_fst.Machine(unigram(parts))
    score = {s: sc for s, sc, k in parts if k == 1}

    def best(text):
        paths = {0: (0.0, [])}
        for j in range(1, len(text) + 1):
            ways = [(paths[i][0] + score[text[i:j]], [*paths[i][1], text[i:j]]) for i in range(j) if text[i:j] in score]
            if text[j - 1] not in score:
                ways.append((paths[j - 1][0] - 10 - 9, [*paths[j - 1][1], "<unk>"]))
            paths[j] = max(ways)
        return paths[len(text)]

    rng = random.Random(0)
    for _ in range(300):
        t = "".join(rng.choices("aabbccz ", k=rng.randrange(1, 14)))
        cost, path = best("▁" + t.replace(" ", "▁"))
        got = [m.model.pieces[i][0] for i in as_ids(m.encode([t.encode()])[0])]
        assert sum(score.get(p, -19) for p in got) == pytest.approx(cost)
        assert len(got) == len(path) or "".join(got) == "".join(path)


def test_operator_keeps_columns_and_handles_all_rows(spark):
    df = documents(spark, clash=("n_tokens", "exact"))
    got = piece_fst.decode(piece_fst.encode(df, FILE), FILE)
    assert got.columns == [*df.columns, "ids", "decoded"]
    out = got.collect()
    assert sorted(repr((r.doc_id, r.text)) for r in out) == sorted(repr((r[0], r[1])) for r in rows())
    for r in out:
        assert r.ids == LIBRARY.encode(r.text or "") and r.decoded == (r.text or "").replace("▁", " ")
    assert piece_fst.round_trip(df, FILE).filter("not exact").count() == 0
    assert piece_fst.round_trip(df, FILE).agg(F.sum("n_tokens")).first()[0] == sum(len(r.ids) for r in out)


def test_empty_table(spark):
    assert piece_fst.encode(documents(spark, []), FILE).count() == 0 and piece_fst.round_trip(documents(spark, []), FILE).count() == 0
