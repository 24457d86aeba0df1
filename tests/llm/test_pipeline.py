import base64
import math
import random

import public_tokenizers
import tiktoken

import corpus_pipeline
from starloom.llm import fertility, simhash
from tests.llm.cases import DOCS, documents
from tests.llm.test_decontam import brute as hits
from tests.llm.test_fertility import brute as measures
from tests.llm.test_simhash import brute_groups

WORDS = """the of and to in is was for on as with by at from his her they this have had not are but which one all were when there can more
an if out so said what up its about into than them only some could time these two may then first any my now such like our over man even most
made after also did many off before must through back years where much your way well down should because each just those people how too good
very make world still own see men work long here get both between life being under never day same another know while last might us great old
year come since against go came right used take three small river garden winter letter window kitchen mountain teacher village machine
""".split()


def corpus():
    """Clean, toxic, junk, copied and contaminated texts, their labels and the benchmark."""
    rng = random.Random(21)
    text = lambda n: " ".join(rng.choices(WORDS, k=n))
    bench = [(i, text(24)) for i in range(6)]
    data, toxic, junk, copies, planted = [], set(), set(), set(), set()

    def add(raw, *kinds):
        data.append((len(data), raw, "en", "s", 0))
        for k in kinds:
            k.add(len(data) - 1)

    for i in range(240):
        words = text(rng.choice([40, 70, 120])).split()
        for _ in range(3 + len(words) // 12 if i % 3 == 0 else 0):
            words[rng.randrange(len(words))] = "zwolx" + rng.choice(["", "en", "us", "ya", "iro"])
        add(" ".join(words), *([toxic] if i % 3 == 0 else []))
    for i in range(8):
        add(text(12), junk)
        add(" ".join("".join(rng.choice("#*$%&|<>qzx0") for _ in range(7)) for _ in range(40)), junk)
        add(" ".join([text(9)] * 8), junk)
        add(data[3 * i + 1][1], copies)
        add(data[3 * i + 2][1].upper().capitalize() if i < 4 else data[3 * i + 2][1] + " ", copies)
        add(f"{text(20)} {bench[i % 6][1]} {text(20)}", planted)
    add(None, junk)
    add("", junk)
    return data, [(d, int(d not in junk), int(d in toxic)) for d, *_ in data], bench, toxic, junk, copies, planted


def good(raw):
    n_words, chars, _, _, _, failed, tokens, fallback, entropy = measures(raw)
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())} if not good.known else None
    good.known = good.known or tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    if failed or tokens < 32:
        return not failed
    points, at = fertility.BANDS["en"].least_bits, math.log2(tokens)
    least = points[0][1] if at <= points[0][0] else points[-1][1]
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        if x0 <= at <= x1:
            least = y0 + (y1 - y0) * (at - x0) / (x1 - x0)
    byte_tokens = sum(len(good.known.encode_ordinary(" " + w)) for w in raw.split())
    band = fertility.BANDS["en"]
    return band.piece_low <= chars / tokens <= band.piece_high and chars >= band.byte_low * byte_tokens and fallback <= band.fallback * tokens and entropy >= least


good.known = None


def test_stages_keep_what_brute_force_keeps(spark, tmp_path, monkeypatch):
    data, labels, bench, toxic, junk, copies, planted = corpus()
    for name, rows, shape in (("documents", data, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", bench, "item_id long, text string")):
        spark.createDataFrame(rows, shape).write.parquet(str(tmp_path / f"{name}.parquet"))
    kept, store = [], corpus_pipeline.store

    def stored(df, name):
        out = store(df, name)
        kept.append((name, out.columns, sorted(r.doc_id for r in out.select("doc_id").collect())))
        return out

    monkeypatch.setattr(corpus_pipeline, "store", stored)
    last = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = [r for r in data if good(r[1])]
    want = [("quality_rules", [r[0] for r in left])]
    left = [r for r in left if r[0] not in toxic]
    want.append(("toxicity", [r[0] for r in left]))
    least = {i for i, _, group in brute_groups(left) if i == group}
    left = [r for r in left if r[0] in least]
    want.append(("near_duplicates", [r[0] for r in left]))
    clean = {r[0] for r in hits(left, bench) if not r[-1]}
    left = [r for r in left if r[0] in clean]
    want.append(("decontamination", [r[0] for r in left]))

    assert [name for name, _, _ in kept] == ["pipeline_" + name for name, _ in want]
    assert all(columns == DOCS.fieldNames() for _, columns, _ in kept)
    for (_, _, got), (name, ids) in zip(kept, want):
        assert got == ids, name
    assert sorted(r.doc_id for r in last) == [r[0] for r in left]
    # each stage has had something to do, and nothing else has gone
    ids = [set(x) for _, x in want]
    assert set(range(len(data))) - ids[0] == junk and ids[0] - ids[1] == toxic and ids[1] - ids[2] == copies and ids[2] - ids[3] == planted


def test_near_duplicates_send_no_candidates_to_the_driver(spark, monkeypatch):
    plans, pairs = [], simhash.close_pairs

    def watched(*args):
        out = pairs(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(simhash, "close_pairs", watched)
    kept = corpus_pipeline.near_duplicates(spark, documents(spark), "").count()
    assert kept == simhash.groups(documents(spark)).select("component_id").distinct().count()
    assert plans and not [p for p in plans if "Broadcast" in p]
