"""Join operators and value resolution on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import lower_trim, normalize_text, row_hash
from starloom.operators import dedup
from starloom.operators.dims import dim_date, year_keys
from starloom.operators.joins import (lateral_top1, nullsafe_join, period_start_join, seed_broadcast)
from starloom.operators.lookups import Resolution, assert_unique, build_map, resolve, seed_frame
from starloom.operators.quality import hierarchy_orphans
from starloom.plans.basic import PRIORITY_SEED
from starloom.plans.registry import register, sql_normalize
from starloom.plans.scalar import NOISY_SEGMENT, sql_canonical
from starloom.sources.tables import read_table


def _values(rows, cols, alias="v"):
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS {alias}({', '.join(cols)})"


# Inner star join fact -> dims, aggregated by the outermost dimension.
@register("star_join", oracle="""
SELECT r.r_name, COUNT(*) AS order_count, SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total_price
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def star_join(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_totalprice")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, F.col("n_regionkey") == r["r_regionkey"])
    j = o.join(cn.select("c_custkey", "r_name"), o["o_custkey"] == cn["c_custkey"])
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("order_count"),
                                   F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_price"))


EVENT_LABELS = [("click", "Click"), ("view", "View"), ("purchase", "Purchase"),
                ("signup", "Sign-up"), ("", "Unclassified")]


# Null-safe equality (NULL = NULL = '').
@register("nullsafe_join", oracle=f"""
SELECT e.event_id, v.event_label
FROM events e JOIN {_values(EVENT_LABELS, ['event_key', 'event_label'])}
  ON COALESCE(NULLIF(e.event_type, 'error'), '') = COALESCE(v.event_key, '')
""")
def nullsafe_join_q(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type") \
        .select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_key"))
    labels = seed_broadcast(seed_frame(spark, EVENT_LABELS, "label_key string, event_label string"))
    return nullsafe_join(ev, labels, [("event_key", "label_key")]).select("event_id", "event_label")


# OUTER APPLY TOP(1) ... ORDER BY -- best customer per nation.
@register("lateral_top1", oracle="""
WITH ranked AS (
  SELECT c_nationkey, c_custkey, c_acctbal,
         ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn
  FROM customer)
SELECT n.n_nationkey, n.n_name, r.c_custkey, r.c_acctbal
FROM nation n LEFT JOIN ranked r ON r.c_nationkey = n.n_nationkey AND r.rn = 1
""")
def lateral_top1_q(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    return lateral_top1(n, c, "n_nationkey", "c_nationkey",
                        order=[F.col("c_acctbal"), -F.col("c_custkey")],
                        payload=["c_custkey", "c_acctbal"], largest=True)


# Period-start self join of the date dimension (strict: day 1 must be present).
@register("period_start_join", oracle="""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fd FROM orders)
SELECT o.o_orderkey, CAST(strftime(d.fd, '%Y%m%d') AS INTEGER) AS month_key
FROM orders o JOIN d ON year(d.fd) = year(o.o_orderdate) AND month(d.fd) = month(o.o_orderdate) AND day(d.fd) = 1
""")
def period_start_join_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate") \
        .withColumn("order_date", F.col("o_orderdate").cast("date"))
    dd = dim_date(o, "order_date")
    return period_start_join(o, dd, "order_date", "month", "month_key").select("o_orderkey", "month_key")


# Join to an aggregated subquery (year -> first date key seen).
@register("join_agg_subquery", oracle="""
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fd FROM orders),
y AS (SELECT year(fd) AS y, MIN(CAST(strftime(fd, '%Y%m%d') AS INTEGER)) AS year_key FROM d GROUP BY 1)
SELECT o.o_orderkey, y.year_key FROM orders o JOIN y ON y.y = year(o.o_orderdate)
""")
def join_agg_subquery(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate") \
        .withColumn("order_date", F.col("o_orderdate").cast("date"))
    yk = year_keys(dim_date(o, "order_date"))
    return o.join(yk, F.year("order_date") == yk["year"]).select("o_orderkey", "year_key")


_ORDER_HASH = ["o_orderkey", "o_custkey", "o_orderstatus", "CAST(o_totalprice AS DECIMAL(18,2))",
               "CAST(CAST(o_orderdate AS DATE) AS STRING)", "o_orderpriority"]


def _order_hash_sql():
    return "sha256(" + " || '|' || ".join(
        f"COALESCE(CAST({c.replace('STRING', 'VARCHAR')} AS VARCHAR), '')" for c in _ORDER_HASH) + ")"


# Hash-based delta -- rows of the new batch not in the stored table.
@register("delta_anti_join", oracle=f"""
WITH stored AS (SELECT {_order_hash_sql()} AS row_hash FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
batch AS (SELECT o_orderkey, {_order_hash_sql()} AS row_hash FROM orders)
SELECT b.o_orderkey, b.row_hash FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.row_hash = b.row_hash)
""")
def delta_anti_join(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    h = row_hash([F.expr(x) for x in _ORDER_HASH]).alias("row_hash")
    stored = o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select(h)
    batch = o.select("o_orderkey", h)
    return dedup.new_rows(batch, stored, "row_hash")


# Semi join (EXISTS).
@register("semi_join_exists", oracle="""
SELECT c_custkey, c_name FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')
""")
def semi_join_exists(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    f = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderstatus").filter(F.col("o_orderstatus") == "F")
    return c.join(f, c["c_custkey"] == f["o_custkey"], "left_semi")


# Hierarchy validation -- customer locations whose nation or
# region does not resolve (left join + OR of null tests); expect none.
@register("hierarchy_validate", oracle="""
SELECT c.c_custkey, c.c_nationkey, n.n_name, r.r_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE n.n_nationkey IS NULL OR r.r_regionkey IS NULL
""")
def hierarchy_validate(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").join(r, F.col("n_regionkey") == r["r_regionkey"], "left")
    return j.filter(F.col("n_nationkey").isNull() | F.col("r_regionkey").isNull()) \
            .select("c_custkey", "c_nationkey", "n_name", "r_name")


# Rows whose nation and region names do not stand together in the master hierarchy.
@register("hierarchy_names", oracle="""
WITH noisy AS (
  SELECT s.s_suppkey, '  ' || lower(n.n_name) AS nation_text, r.r_name || ' ' AS region_text
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON s.s_suppkey % 5 = r.r_regionkey)
SELECT s_suppkey, nation_text, region_text FROM noisy x
WHERE NOT EXISTS (SELECT 1 FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
                  WHERE lower(trim(n.n_name)) = lower(trim(x.nation_text)) AND lower(trim(r.r_name)) = lower(trim(x.region_text)))
""")
def hierarchy_names(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    # stand-in: names as typed, the region taken from the row's number
    noisy = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, s["s_suppkey"] % 5 == r["r_regionkey"]).select(
        "s_suppkey", F.concat(F.lit("  "), F.lower("n_name")).alias("nation_text"), F.concat("r_name", F.lit(" ")).alias("region_text"))
    masters = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return hierarchy_orphans(noisy, "nation_text", "region_text", masters, "n_name", "r_name", lower_trim)


RETURNFLAG_LABELS = [("A", "Accepted"), ("R", "Returned")]
LINESTATUS_LABELS = [("F", "Filled"), ("O", "Open")]
ORDERSTATUS_LABELS = [("F", "Fulfilled"), ("O", "Open"), ("P", "Partial")]


# Code -> label denormalisation by several left joins.
@register("denormalize_codes", oracle=f"""
SELECT l.l_orderkey, l.l_linenumber, rf.label AS returnflag_label, ls.label AS linestatus_label,
       os.label AS orderstatus_label, pr.label AS priority_label
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT * FROM {_values(RETURNFLAG_LABELS, ['code', 'label'])}) rf ON rf.code = l.l_returnflag
LEFT JOIN (SELECT * FROM {_values(LINESTATUS_LABELS, ['code', 'label'])}) ls ON ls.code = l.l_linestatus
LEFT JOIN (SELECT * FROM {_values(ORDERSTATUS_LABELS, ['code', 'label'])}) os ON os.code = o.o_orderstatus
LEFT JOIN (SELECT * FROM {_values(PRIORITY_SEED, ['code', 'label'])}) pr ON pr.code = o.o_orderpriority
""")
def denormalize_codes(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    for col, seed, out in [("l_returnflag", RETURNFLAG_LABELS, "returnflag_label"),
                           ("l_linestatus", LINESTATUS_LABELS, "linestatus_label"),
                           ("o_orderstatus", ORDERSTATUS_LABELS, "orderstatus_label"),
                           ("o_orderpriority", PRIORITY_SEED, "priority_label")]:
        labels = seed_broadcast(seed_frame(spark, seed, f"{out}_code string, {out} string"))
        j = j.join(labels, j[col] == labels[f"{out}_code"], "left").drop(f"{out}_code")
    return j.select("l_orderkey", "l_linenumber", "returnflag_label", "linestatus_label",
                    "orderstatus_label", "priority_label")


# ---------------------------------------------------------------------------
# General-health master (code -> label) of the survey source.
# ---------------------------------------------------------------------------
HEALTH_CODES = [
    ("1", "Excellent"),
    ("2", "Very good"),
    ("3", "Good"),
    ("4", "Fair"),
    ("5", "Poor"),
    ("7", "Dont know/Not sure"),
    ("9", "Refused"),
]
# Raw text variants of the same labels (map seed; normalised before use).
HEALTH_TEXT = [(label, label) for _, label in HEALTH_CODES] + [
    ("very good.", "Very good"), ("Don't know", "Dont know/Not sure"), ("not sure", "Dont know/Not sure")]

RAW_HEALTH = """CASE p_partkey % 4
  WHEN 0 THEN CAST(p_size % 10 AS STRING) || '.0'
  WHEN 1 THEN element_at(array('excellent', 'Very Good.', '  good', 'FAIR', 'poor!', 'not sure'), CAST(p_size % 6 + 1 AS INT))
  WHEN 2 THEN ' ' || CAST(p_size % 10 AS STRING) || ' '
  ELSE p_type END"""
RAW_HEALTH_SQL = RAW_HEALTH.replace("STRING", "VARCHAR").replace(
    "element_at(array('excellent', 'Very Good.', '  good', 'FAIR', 'poor!', 'not sure'), CAST(p_size % 6 + 1 AS INT))",
    "['excellent', 'Very Good.', '  good', 'FAIR', 'poor!', 'not sure'][p_size % 6 + 1]")


# Code label -> map label -> raw text -> 'Not Found'.
@register("resolve_codes", oracle=f"""
WITH t AS (SELECT p_partkey, {RAW_HEALTH_SQL} AS raw_health FROM part),
k AS (SELECT p_partkey, raw_health, {sql_canonical('raw_health')} AS code, {sql_normalize('raw_health')} AS norm FROM t),
m AS (SELECT DISTINCT {sql_normalize('raw')} AS norm_key, label FROM {_values(HEALTH_TEXT, ['raw', 'label'])})
SELECT k.p_partkey, k.raw_health,
       COALESCE(c.label, m.label, NULLIF(trim(k.raw_health), ''), 'Not Found') AS health_status
FROM k LEFT JOIN {_values(HEALTH_CODES, ['code', 'label'], 'c')} ON c.code = k.code
LEFT JOIN m ON m.norm_key = k.norm
""")
def resolve_codes(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size", "p_type")
    t = p.select("p_partkey", F.expr(RAW_HEALTH).alias("raw_health"))
    codes = seed_frame(spark, HEALTH_CODES, "code string, label string")
    master = codes.select(F.col("label").alias("value"))
    text_map = assert_unique(build_map(seed_frame(spark, HEALTH_TEXT, "raw string, final string"),
                                       "raw", "final", master, "value"), ["raw_key"])
    out = resolve(t, [Resolution("raw_health", "health_status", code_labels=codes, text_map=text_map,
                                 fallback_raw=True)])
    return out.select("p_partkey", "raw_health", "health_status")


# Fixed seeds of the segment lookup: master (id, value) and raw variants.
SEGMENT_MASTER = [(0, "Not Found"), (1, "AUTOMOBILE"), (2, "BUILDING"), (3, "FURNITURE"),
                  (4, "HOUSEHOLD"), (5, "MACHINERY")]
SEGMENT_VARIANTS = [("Automobile", "AUTOMOBILE"), ("auto", "AUTOMOBILE"), ("Building", "BUILDING"),
                    ("Furniture", "FURNITURE"), ("household", "HOUSEHOLD"), ("Machinery", "MACHINERY"),
                    ("", "Not Found"), ("Not Found", "Not Found")]


# Lookup map built from normalised seeds; noisy text resolved through it.
@register("normalized_lookup", oracle=f"""
WITH m AS (
  SELECT DISTINCT {sql_normalize('s.raw')} AS raw_key, mm.segment_id, mm.segment
  FROM {_values(SEGMENT_VARIANTS, ['raw', 'final'], 's')}
  JOIN {_values(SEGMENT_MASTER, ['segment_id', 'segment'], 'mm')}
    ON mm.segment = s.final),
t AS (SELECT c_custkey, {NOISY_SEGMENT} AS noisy_text FROM customer)
SELECT t.c_custkey, t.noisy_text, m.segment_id, COALESCE(m.segment, 'Not Found') AS segment
FROM t LEFT JOIN m ON m.raw_key = {sql_normalize('t.noisy_text')}
""")
def normalized_lookup(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_name")
    t = c.select("c_custkey", F.expr(NOISY_SEGMENT).alias("noisy_text"))
    master = seed_frame(spark, SEGMENT_MASTER, "segment_id int, segment string")
    seg_map = assert_unique(build_map(seed_frame(spark, SEGMENT_VARIANTS, "raw string, final string"),
                                      "raw", "final", master, "segment", "segment_id"), ["raw_key"])
    m = seed_broadcast(seg_map.withColumnRenamed("label", "segment"))
    j = t.withColumn("raw_key", normalize_text("noisy_text")).join(m, "raw_key", "left")
    return j.select("c_custkey", "noisy_text", "segment_id",
                    F.coalesce(F.col("segment"), F.lit("Not Found")).alias("segment"))

