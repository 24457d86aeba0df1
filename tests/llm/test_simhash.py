import random

import xxhash
from pyspark.sql import functions as F

from starloom.llm import simhash
from starloom.llm.common import store
from starloom.llm.components import components
from tests.llm.cases import documents, rows


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(data, distance=4):
    prints = [brute_print(r[1]) for r in data]
    group = list(range(len(data)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                group[root(i)] = root(j)
    ids = {}
    for i, r in enumerate(data):
        ids.setdefault(root(i), []).append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((r[0], p, least[root(i)]) for i, (r, p) in enumerate(zip(data, prints))), key=repr)


def found(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=repr)


def test_groups_match_brute_force(spark):
    data = rows()
    assert found(simhash.groups(documents(spark, data, clash=("fp", "component_id", "a")))) == brute_groups(data)


def test_pairs_match_brute_force(spark):
    rng = random.Random(3)
    points = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        points.add(x)
        for _ in range(6):
            points.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))))
    points = sorted(points)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    for k in (1, 3, 4, 7):
        got = {(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.close_pairs(spark.createDataFrame(signed, "fp long"), k).collect()}
        want = {frozenset((a, b)) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= k}
        assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_candidates_never_go_through_the_driver(spark):
    """Exploded rows are sized too low, so a join left to Spark's choice sends them all to the driver."""
    points = store(spark.createDataFrame([(1,), (3,), (1 << 40,)], "fp long"), "points")
    for k in (1, 4):
        near = simhash.close_pairs(points, k)
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert [(r.a, r.b) for r in near.filter("a < 9 and b < 9").collect()] == [(1, 3)]


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 70)] + [(200, i) for i in range(201, 260)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    names = list(range(400))
    rng.shuffle(names)
    got = {r.node: r.root for r in components(spark.createDataFrame([(names[a], names[b]) for a, b in links], "a long, b long")).collect()}
    for part in (range(0, 71), range(200, 260), range(300, 309)):
        own = [names[i] for i in part]
        assert {got[x] for x in own} == {min(own)}


def test_dedup_keeps_one_of_each_group_and_all_columns(spark):
    data = rows()
    kept = simhash.dedup(documents(spark, data, clash=("fp", "node"))).collect()
    groups = {r[2] for r in brute_groups(data)}
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars", "fp", "node"]
    assert len(kept) == len(groups) and {r.doc_id for r in kept} == groups


def test_empty_table(spark):
    none = documents(spark, [])
    assert simhash.groups(none).count() == 0 and simhash.dedup(none).count() == 0
    assert simhash.groups(none).select(F.col("component_id")).schema[0].dataType.typeName() == "long"
