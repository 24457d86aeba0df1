from starloom.llm import decontam
from tests.llm.cases import documents
from tests.llm.test_decontam import WORD, case, lower


def longest(text, bench):
    """Words of the longest match, and all its (item, first word)."""
    own = WORD.findall(lower(text))
    best, where = 0, set()
    for item, t in bench:
        words = WORD.findall(lower(t))
        for i in range(len(own)):
            for j in range(len(words)):
                n = 0
                while i + n < len(own) and j + n < len(words) and own[i + n] == words[j + n]:
                    n += 1
                if n > best:
                    best, where = n, set()
                if n and n == best:
                    where.add(("null" if item is None else str(item), i))
    return best, where


def test_longest_match_is_reported_below_a_window_too(spark):
    data, bench = case()
    data = [r for r in data if len(r[1] or "") < 2000 and r[0] is not None and r[0] != 109]
    data.append((400, "qq " + " ".join(bench[4][1].split()[30:42]) + " zz", "en", "s", 0))
    b = spark.createDataFrame(bench, "item_id long, text string")
    for more in ({}, {"block_bytes": 200, "shard_bytes": 500}):
        got = {r.doc_id: r for r in decontam.report(documents(spark, data), b, **more).collect()}
        assert got[400].longest_words == 12 and got[400].longest_at == 1 and not got[400].contaminated
        for doc_id, text, *_ in data:
            n, where = longest(text, bench)
            r = got[doc_id]
            assert r.longest_words == n and ((r.longest_item, r.longest_at) in where if n else r.longest_at is None), doc_id
