"""The registered queries of this subpackage: one thin query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import chat, decontam, fertility, lm_mix, piece_fst, pivot_index, ptolemy, sharding, simhash, spelling, tokenids, toxicity, warc
from starloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- 1 SentencePiece

@query
def op1_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by shortest paths, and whether they decode to the text."""
    return piece_fst.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


# --- 2 chat formatting

@query
def op2_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from every participant's side, with the loss spans as ``start-end`` text."""
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    loss = F.filter("segments", lambda s: s["loss"])
    return out.select(
        "conv_id", "perspective", "part", "piece", "n_turns", "text",
        F.array_join(F.transform(loss, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("loss_spans"),
        F.aggregate(loss, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("loss_chars"))


ORACLES["op2_chat_rotation"] = """
WITH marked AS (
  SELECT conv_id, turn, role, text, coalesce(text, '') AS body0, CAST(floor(turn / 256.0) AS BIGINT) AS part,
         md5(coalesce('+' || role, '-') || chr(10) || coalesce('+' || text, '-')) AS mark
  FROM conversations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, part
           ORDER BY turn, mark, role IS NULL, coalesce(role, ''), text IS NULL, coalesce(text, '')) AS rn
  FROM marked),
rows AS (SELECT *, (rn - 1) // 256 AS piece FROM ranked),
who AS (SELECT DISTINCT conv_id, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
shown AS (
  SELECT r.conv_id, w.perspective, r.part, r.piece, r.rn, r.role = w.perspective AS loss,
         CASE WHEN r.role = 'system' THEN '<|im_start|>system' || chr(10)
              WHEN r.role = w.perspective THEN '<|im_start|>assistant' || chr(10)
              ELSE '<|im_start|>user name=' || replace(coalesce(r.role, 'unknown'), '<|', '< |') || chr(10) END AS head,
         replace(r.body0, '<|', '< |') AS body
  FROM rows r JOIN who w ON r.conv_id IS NOT DISTINCT FROM w.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 11) OVER (
           PARTITION BY conv_id, perspective, part, piece ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM shown)
SELECT conv_id, perspective, part, piece, count(*) AS n_turns,
       string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY rn) AS text,
       coalesce(string_agg(CASE WHEN loss THEN CAST(CAST(pos + length(head) AS BIGINT) AS VARCHAR) || '-' ||
                CAST(CAST(pos + length(head) + length(body) AS BIGINT) AS VARCHAR) END, ',' ORDER BY rn), '') AS loss_spans,
       CAST(coalesce(sum(CASE WHEN loss THEN length(body) END), 0) AS BIGINT) AS loss_chars
FROM placed GROUP BY conv_id, perspective, part, piece
"""


# --- 4 sharding

@query
def op4_proportional_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal row counts (law ``rows``)."""
    out = sharding.interleave(table(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# --- 3 near duplicates

@query
def op3_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 4-word shingles, links at 4 bits or fewer."""
    out = simhash.groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- 5 quality rules

@query
def op5_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of all documents and the fertility bands' verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = fertility.annotate(docs, public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", *[F.col(f"__q_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "tokens", "fallback", "byte_tokens", "entropy")])


# --- 6 decontamination

@query
def op6_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verbatim benchmark windows of 13 words in every document."""
    out = decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
                      "longest_words", "longest_item", "longest_at")


# --- 7 WARC

@query
def op7_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for every page, written and read back."""
    out = warc.round_trip(table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_TWENTY = ", ".join(f"('0x' || substr(sha1(html), {k + 1}, 5))::BIGINT" for k in range(0, 40, 5))
_CHARS = " || ".join(f"substr('{warc.BASE32}', CAST((d[{k + 1}] >> {s}) & 31 AS BIGINT) + 1, 1)" for k in range(8) for s in (15, 10, 5, 0))

ORACLES["op7_warc_boundary_chain"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, [{_TWENTY}] AS d, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, {_CHARS} AS payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM g
"""


# --- 8 toxicity

@query
def op8_gru_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.annotate(docs, table(spark, sf_dir, "labels"), score="score")
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


# --- 9 language-model scores

@query
def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under counts of those that aren't held out."""
    return lm_mix.score(table(spark, sf_dir, "documents"))


# --- 10 token ids

@query
def op10_simple8b_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written in Simple-8b blocks and read back."""
    return tokenids.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


# --- 11 embedding near-duplicates

@query
def op11_pivot_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at a cosine of 0.9 or more, and what they reach."""
    return pivot_index.near_groups(table(spark, sf_dir, "embeddings"), pivot_index.Settings(cosine=0.9))


_SOUND = "len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES["op11_pivot_permutation"] = f"""
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN {_SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS v
  FROM embeddings),
links AS (SELECT a.r AS a, b.r AS b FROM e a JOIN e b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(e.vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, least.component_id, coalesce(e.vec_id = least.component_id, false) AS kept
FROM e JOIN least USING (r) LEFT JOIN n USING (r)
"""


# --- 12 spelling variants

@query
def op12_fm_index_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent words one edit away that they are variants of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


# --- 13 centroid clustering

@query
def op13_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in 16 clusters after three rounds, in exact integers."""
    out = ptolemy.report(table(spark, sf_dir, "embeddings"), ptolemy.Settings(clusters=16, rounds=3, seed=1))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def _round(k: int) -> str:
    """Assignment to the centroids ``c{k}`` and, from it, the centroids ``c{k + 1}``."""
    return f"""
d{k} AS (SELECT p.r, c.cluster, sum((p.v - c.v) * (p.v - c.v)) AS distance FROM parts p JOIN c{k} c USING (i) GROUP BY p.r, c.cluster),
a{k} AS (SELECT r, min(distance) AS distance, arg_min(cluster, (distance, cluster)) AS cluster FROM d{k} GROUP BY r),
m{k} AS (SELECT a.cluster, p.i, sum(p.v) AS s, count(*) AS n FROM a{k} a JOIN parts p USING (r) GROUP BY a.cluster, p.i),
c{k + 1} AS (SELECT c.cluster, c.i, CASE WHEN m.n IS NULL THEN c.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
             FROM c{k} c LEFT JOIN m{k} m USING (cluster, i))"""


ORACLES["op13_ptolemaic_clusters"] = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND {_SOUND}),
parts AS (SELECT r, i, CAST(floor(64 * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS v FROM e, (SELECT unnest(range(1, 65)) AS i)),
first AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM e QUALIFY cluster < 16),
c0 AS (SELECT first.cluster, parts.i, parts.v FROM first JOIN parts USING (r)),{",".join(_round(k) for k in range(4))},
digest AS (SELECT cluster, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT e.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, digest.centroid_sha256
FROM a3 a JOIN e USING (r) JOIN digest USING (cluster)
"""
