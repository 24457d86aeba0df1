import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm import tokenids
from starloom.session import scratch_path
from tests.llm.cases import documents, rows

FILE = public_tokenizers.path("word_bpe_49k.json")
SIZES = st.sampled_from([0, 1, 2, 3, 7, 8, 12, 15, 16, 20, 31, 59, 60, 61, 63, 64])


@settings(max_examples=150, deadline=None)
@given(st.lists(SIZES.flatmap(lambda b: st.integers(0, (1 << b) - 1)), max_size=400))
def test_pack_round_trip(values):
    words, escapes = tokenids.pack(np.array(values, np.uint64))
    assert tokenids.unpack(words, escapes, len(values)).tolist() == values


def test_runs_and_blocks():
    for values in ([0] * 1000, [1] * 61, [5, 1 << 62, 7, (1 << 64) - 1, (1 << 64) - 1], [], [49407] * 10, list(range(5000))):
        ids = np.array(values, np.uint64)
        names, lengths, back = tokenids.from_block(tokenids.to_block([3, None], [len(ids), 0], ids))
        assert names == [3, None] and lengths.tolist() == [len(ids), 0] and back.tolist() == values
    assert len(tokenids.pack(np.zeros(1200, np.uint64))[0]) == 10


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(SIZES.flatmap(lambda b: st.integers(0, (1 << b) - 1)), st.integers(1, 70)), max_size=20))
def test_each_word_has_the_most_ids_that_fit(runs):
    values, want, escapes, at = [v for v, n in runs for _ in range(n)], [], [], 0
    while at < len(values):
        # the first selector that holds as many ids as it takes, zeros after the last one
        for s in range(1, 16):
            ids, width = values[at:at + int(tokenids.COUNTS[s])], int(tokenids.WIDTHS[s])
            if all(x < 1 << width for x in ids):
                want.append(s << 60 | sum(x << k * width for k, x in enumerate(ids)))
                break
        else:
            escapes.append(len(want))
            ids = values[at:at + 1]
            want += [0, *ids]
        at += len(ids)
    words, places = tokenids.pack(np.array(values, np.uint64))
    assert words.tolist() == want and places.tolist() == escapes


def test_a_corpus_words_are_remembered():
    class Counted(tokenids.WordIds):
        found = 0

        def _ids(self, word):
            self.found += 1
            return super()._ids(word)

    with open(FILE, encoding="utf-8") as f:
        words = Counted(f.read())
    letters = "abcdefghijklmnopqrst"
    texts = [" ".join(f"{a}{b}{c}{d}" for c in letters for d in letters).encode() + b" " + f"{a}{b}.".encode() for a in letters for b in letters]
    texts += [t.replace(b" ", b"x ") for t in texts]
    first = [words.text(t) for t in texts]
    n = words.found
    assert n > 300000 and [words.text(t) for t in texts] == first and words.found == n


def brute(data, end=2):
    tok = Tokenizer.from_file(FILE)
    ids = {i: [*tok.encode(r[1] or "", add_special_tokens=False).ids, end] for i, r in enumerate(data)}
    return ids


def test_files_hold_the_librarys_ids(spark):
    data = [r for r in rows() if r[0] is not None and r[0] != 109]
    data += [(400, "<|endoftext|> <|ENDOFTEXT|> I'M don'T a b c d \x1c x́ e ́ İ ﬁ", "en", "s", 0),
             (401, " ".join(random.Random(2).choices(["Été", "don't", "x" * 300, "12 345", "日本語", "a.b,c", "\U0001f600"], k=30000)), "en", "s", 0)]
    path = scratch_path(spark, "ids_test")
    tokenids.write(documents(spark, data, clash=("ids", "start", "h")), FILE, path, partitions=5)
    want = brute(data)
    got = {r.doc_id: r for r in tokenids.read(spark, path).collect()}
    digest = {r.doc_id: r for r in tokenids.digests(spark, path).collect()}
    at = 0
    assert set(got) == {r[0] for r in data}
    for doc, ids in sorted((r[0], want[i]) for i, r in enumerate(data)):
        assert got[doc].ids == ids and got[doc].start == at
        d = digest[doc]
        assert (d.start, d.n_tokens, d.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_nulls_and_repeated_rows_and_empty(spark):
    got = tokenids.round_trip(documents(spark), FILE).collect()
    assert len(got) == len(rows()) and sorted(r.start for r in got)[0] == 0
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert tokenids.round_trip(documents(spark, []), FILE).count() == 0


def test_a_third_of_the_rows_without_id_are_several_tasks(spark, tmp_path):
    rows = [(None if i % 3 == 0 else i, f"text number {i} of many") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    path = f"{tmp_path}/ids"
    tokenids.write(df, public_tokenizers.path("word_bpe_49k.json"), path, partitions=9)
    parts = spark.read.parquet(path).groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    assert len(parts) == 9 and max(r["n"] for r in parts) < 2.5 * min(r["n"] for r in parts)
    got = tokenids.digests(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got if r["doc_id"] is not None] == sorted(i for i, _ in rows if i is not None)
    assert all(r["doc_id"] is None for r in got[:200]) and len(got) == 600
