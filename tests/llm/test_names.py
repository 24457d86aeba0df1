"""Filters keep a table's own columns, whatever they are called, and a worker holds one operator's state."""

import public_tokenizers
from pyspark.sql import functions as F

from starloom.llm import common, decontam, fertility, simhash, toxicity

PROSE = "The quick brown fox jumps over the lazy dog while seven grey geese walk slowly along the river bank towards the old stone bridge at dusk"


def table(spark):
    rows = [(1, PROSE, "en"), (2, PROSE + " again", "en"), (2, PROSE + " again", "en"), (3, None, None), (4, "word", "en")]
    names = ["__z", "__d", "__t", "z", "d", "t", "c0", "c1", "__q_kept", "__toxic_score", "__sa_hit", "toxic", "w_z"]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])


def check(df, out, ids):
    assert out.columns == df.columns
    whole = sorted(map(tuple, df.collect()), key=str)
    got = sorted(map(tuple, out.collect()), key=str)
    assert all(r in whole for r in got) and [r[0] for r in got] == ids


def test_filters_keep_clashing_columns(spark):
    df = table(spark)
    pieces, ranks = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    check(df, fertility.keep(df, pieces, ranks), [1, 2, 2])
    check(df, simhash.dedup(df, distance=0), [1, 2, 3, 4])
    bench = spark.createDataFrame([("x", PROSE + " again")], "item_id string, text string")
    check(df, decontam.decontaminate(df, bench), [3, 4])
    labels = spark.createDataFrame([(1, 0), (4, 0)], "doc_id long, toxic int")
    scored = toxicity.annotate(df, labels).collect()
    check(df, toxicity.keep(df, labels), sorted(r["doc_id"] for r in scored if r["__toxic_score"] < 0.5))


def test_a_worker_holds_one_state():
    made = []
    make = lambda k: lambda: made.append(k) or [k]
    first = common.held("a", make("a"))
    assert common.held("a", make("a")) is first and made == ["a"]
    assert common.held("b", make("b")) == ["b"] and list(common._HELD) == ["b"]
    assert common.held("a", make("a")) is not first and made == ["a", "b", "a"]


def test_memos_are_bounded_in_bytes(monkeypatch):
    from starloom.llm import tokenids

    spec = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    words = tokenids.WordIds(spec)
    want = [words.text(f"word{i} x{i}".encode()) for i in range(300)]
    monkeypatch.setattr(tokenids, "MEMO_BYTES", 5000)
    small = tokenids.WordIds(spec)
    assert [small.text(f"word{i} x{i}".encode()) for i in range(300)] == want
    assert len(small) < 60
