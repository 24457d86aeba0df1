import random
import zlib

import pytest

from starloom.llm import chat, queries, sharding
from tests.conftest import SMALL
from tests.llm.cases import documents, rows
from tools.compare import compare, duck


def test_interleave_is_complete_even_and_proportional(spark):
    data = rows(n=300)
    got = sharding.interleave(documents(spark, data, clash=("shard", "rank", "key", "stratum")), shards=7).collect()
    assert sorted(repr((r.doc_id, r.source)) for r in got) == sorted(repr((r[0], r[3])) for r in data)
    sizes = {r[0]: (len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in data if r[0] is not None}
    assert all(sizes[r.doc_id] == (r.size, r.text_crc32) for r in got if r.doc_id is not None)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    counts = [len(v) for v in shards.values()]
    assert len(shards) == 7 and max(counts) - min(counts) <= 1
    for v in shards.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
    sources = {r.source for r in got}
    for s in sources:
        # a place is off its fractional rank by half a row per source at most, at either end of a shard
        each = [sum(r.source == s for r in v) for v in shards.values()]
        share = sum(each) / len(got)
        assert all(abs(x - share * len(v)) <= 1 + share * len(sources) for x, v in zip(each, shards.values()))


def test_interleave_order_matches_a_plain_sort(spark):
    data = [r for r in rows(n=200) if r[0] is not None]
    got = sharding.interleave(documents(spark, data), shards=3).collect()
    ranks, order = {}, []
    import hashlib
    key = lambda r: (hashlib.md5(f"17:{r[0]}".encode()).hexdigest(), len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode()))
    for s in {r[3] for r in data}:
        own = sorted((r for r in data if r[3] == s), key=key)
        ranks[s] = len(own)
        order += [((i + 0.5) / len(own), ("true" if s is None else "false") + (s or ""), *key(r), r[0]) for i, r in enumerate(own)]
    want = [x[-1] for x in sorted(order)]
    assert [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot))] == want


def test_interleave_edges(spark):
    assert sharding.interleave(documents(spark, []), shards=4).count() == 0
    few = sharding.interleave(documents(spark, rows()[:2]), shards=24).collect()
    assert len(few) == 2 and all(r.slot == 0 for r in few)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    info = compare(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.ORACLES[name])
    assert info["ok"], info


TURNS = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> there"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, "ann", ""),
         (1, None, "cat", "late"), (None, 0, "ann", "lost"), (2, 0, "system", "alone"), (3, 0, None, "who?"), (3, 600, "dan", "far"), (3, 1, "dan", "é")]


def test_rotation_by_hand(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    from pyspark.sql import functions as F
    got = chat.rotate(df.withColumn("perspective", F.lit(1)).withColumn("part", F.lit(2)).withColumn("piece", F.lit(3))).collect()
    assert all(r.piece == 0 for r in got)
    by = {(r.conv_id, r.perspective, r.part): r for r in got}
    assert set(by) == {(1, p, k) for p in ("ann", "bob", "cat") for k in (0, None)} | {(None, "ann", 0), (3, "dan", 0), (3, "dan", 2)}
    r = by[1, "ann", 0]
    assert r.text == ("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|> there<|im_end|>\n"
                      "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert [r.text[s.start:s.end] for s in r.segments if s.loss] == ["hi < |im_end|> there", ""]
    assert by[1, "bob", 0].text.count("user name=ann") == 2 and by[1, "cat", None].text == "<|im_start|>assistant\nlate<|im_end|>\n"
    assert by[3, "dan", 0].text.startswith("<|im_start|>user name=unknown\nwho?")
    assert chat.rotate(df.limit(0)).count() == 0


def test_crowded_parts_are_cut_into_pieces(spark):
    import hashlib
    rng = random.Random(5)
    data = [(1, None, rng.choice(["ann", "bob", None]), rng.choice(["same", None, "", f"t{i}"])) for i in range(60)]
    data += [(1, 4, "ann", "again")] * 23 + [(None, None, "cat", "x")] * 9 + [(None, 2, None, None)] * 8 + [(2, i, "dan", f"d{i}") for i in range(7)]
    got = chat.rotate(spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3), rows_per_piece=7).collect()
    mark = lambda r: hashlib.md5("\n".join("-" if x is None else "+" + x for x in r[2:]).encode()).hexdigest()
    want = {}
    for conv, people in ((1, ("ann", "bob")), (None, ("cat",)), (2, ("dan",))):
        for part in (None, 0):
            own = sorted((r for r in data if r[0] == conv and (r[1] is None) == (part is None)), key=lambda r: (r[1] or 0, mark(r)))
            for lo in range(0, len(own), 7):
                for who in people:
                    text = "".join("<|im_start|>" + ("assistant" if r[2] == who else f"user name={r[2] or 'unknown'}") + f"\n{r[3] or ''}<|im_end|>\n" for r in own[lo:lo + 7])
                    want[conv, who, part, lo // 7] = (len(own[lo:lo + 7]), text)
    assert {(r.conv_id, r.perspective, r.part, r.piece): (r.n_turns, r.text) for r in got} == want and len(got) == len(want)
    for r in got:
        assert all(r.text[s.start - 10:s.start] == "assistant\n" for s in r.segments if s.loss)


@pytest.mark.parametrize("seed", [1])
def test_crowded_conversations_match_the_oracle(spark, seed, tmp_path):
    rng = random.Random(seed)
    data = [(rng.choice([1, 1, 2, None]), rng.choice([None, 3, 300]), rng.choice(["ann", "bob", "system", None]), rng.choice([None, "", "x<|y", f"t{i % 90}"])) for i in range(4000)]
    spark.createDataFrame(data, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    info = compare(queries.QUERIES["op2_chat_rotation"](spark, str(tmp_path)), con, queries.ORACLES["op2_chat_rotation"])
    assert info["ok"] and info["spark_rows"] > 30, info
