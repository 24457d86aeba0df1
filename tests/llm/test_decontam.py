import hashlib
import random
import re

from starloom.llm import decontam
from tests.llm.cases import documents, prose, rows

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(data, bench, window=13):
    out = []
    for doc_id, text, *_ in data:
        words = WORD.findall(lower(text))
        hit, items = set(), set()
        for item, t in bench:
            own = WORD.findall(lower(t))
            n = min(window, len(own))
            for s in range(len(own) - n + 1) if n else ():
                for i in range(len(words) - n + 1):
                    if words[i:i + n] == own[s:s + n]:
                        hit.update(range(i, i + n))
                        items.add("null" if item is None else str(item))
        out.append((doc_id, len(words), len(hit), tuple(sorted(items)), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def case():
    rng = random.Random(11)
    bench = [(i, prose(rng, n, 60)) for i, n in enumerate([40, 13, 12, 5, 90, 30, 20])]
    bench += [(7, None), (8, ""), (9, " .,"), (None, prose(rng, 20, 60)), (2, prose(rng, 15, 60)), (10, bench[0][1]), (0, bench[0][1])]
    data = rows(n=25)
    for k in range(25):
        item = (bench[rng.choice([0, 1, 2, 3, 4, 10])][1] or "").split()
        a = rng.randrange(len(item))
        part = item[a:a + rng.choice([5, 12, 13, 14, 40])]
        data.append((200 + k, " ".join([prose(rng, rng.randrange(40), 60), ", ".join(part).upper(), prose(rng, rng.randrange(200), 60), *part]), "en", "s", 0))
    data.append((300, " ".join([bench[0][1]] * 5), "en", "s", 0))
    return data, bench


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect()), key=repr)


def test_report_matches_brute_force_for_any_blocks_and_shards(spark):
    data, bench = case()
    b = spark.createDataFrame(bench, "item_id long, text string")
    want = brute(data, bench)
    for more in ({}, {"block_bytes": 200, "shard_bytes": 500}, {"block_bytes": 400, "chain": 1}):
        assert found(decontam.report(documents(spark, data, clash=("n_words", "item_id")), b, **more)) == want


def test_longest_match_and_place(spark):
    data, bench = case()
    b = spark.createDataFrame(bench, "item_id long, text string")
    row = {r.doc_id: r for r in decontam.report(documents(spark, data), b).collect()}[300]
    assert row.longest_words == 40 and row.longest_at == 0 and row.longest_item in ("0", "10")


def test_decontaminate_removes_rows_and_keeps_columns(spark):
    data, bench = case()
    df = documents(spark, data, clash=("items",))
    left = decontam.decontaminate(df, spark.createDataFrame(bench, "item_id long, text string"))
    assert left.columns == df.columns
    clean = sorted((repr(r[0]) for r in brute(data, bench) if not r[4]))
    assert sorted(repr(r.doc_id) for r in left.collect()) == clean


def test_empty_tables(spark):
    b = spark.createDataFrame([], "item_id long, text string")
    assert decontam.report(documents(spark, []), b).count() == 0
    r = decontam.report(documents(spark, [(1, "a b c", "en", "s", 1)]), b).collect()[0]
    assert (r.n_words, r.n_hit, r["items"], r.contaminated) == (3, 0, [], False)
    assert hashlib.sha256(b"").hexdigest()
