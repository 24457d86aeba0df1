"""Incremental loads: a stored first part of the data, then a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starloom.functions import row_hash
from starloom.functions.dates import to_nullable_date
from starloom.operators import quality
from starloom.operators.dims import dim_date
from starloom.operators.joins import nullsafe_join, period_start_join, validity_join
from starloom.operators.keys import dense_ids
from starloom.operators.scd import first_seen_combinations, lag_within_key, last_state_per_day, scd2_merge, scd2_versions
from starloom.operators.stores import HashIndex, Scd2Store
from starloom.operators.upsert import combo_upsert
from starloom.plans.dimensional import DATE_ATTRS_SQL, SCD2_SQL
from starloom.plans.registry import register
from starloom.session import scratch_path
from starloom.sources.files import BUCKET_ROWS, append_table, bucket_count, overwrite_table, write_bucketed
from starloom.sources.tables import read_table


def _stored(df, name):
    """Write a dimension and read it back, as a load finds it."""
    path = scratch_path(df.sparkSession, name)
    overwrite_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _day(column, day):
    return F.col(column).cast("date") < F.lit(day).cast("date")


# Dense ids over rows that carry further columns.
@register("surrogate_key_payload", oracle="""
SELECT ROW_NUMBER() OVER (ORDER BY o_orderpriority, o_orderkey) AS order_id, o_orderpriority, o_orderkey, o_custkey, o_orderstatus
FROM orders
""")
def surrogate_key_payload(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return dense_ids(o, ["o_orderpriority", "o_orderkey"], "order_id").select("order_id", "o_orderpriority", "o_orderkey", "o_custkey", "o_orderstatus")


# Type-2 upsert of the second half of the events into the stored first half.
@register("scd2_upsert", oracle=SCD2_SQL + "SELECT * FROM versions")
def scd2_upsert(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    daily = last_state_per_day(ev, "user_id", "ts", "event_id", ["event_type"])
    known = daily.filter(F.col("user_id").isNotNull())
    half = F.lit("2024-01-16").cast("date")
    dim = _stored(scd2_versions(known.filter(F.col("state_date") < half), "user_id", "state_date", ["event_type"]), "person_dim")
    return scd2_merge(dim, daily.filter(F.col("state_date") >= half), "user_id", "state_date", ["event_type"])


# Combinations of a batch that the stored dimension lacks.
@register("combo_dim_upsert", oracle="""
WITH a AS (SELECT p_brand, p_size, 0 AS batch FROM part WHERE p_partkey % 2 = 0
           UNION ALL SELECT p_brand, p_size, 1 FROM part),
f AS (SELECT p_brand, p_size, min(batch) AS batch FROM a GROUP BY 1, 2)
SELECT ROW_NUMBER() OVER (ORDER BY batch, p_brand, p_size) AS combo_id, p_brand, p_size FROM f
""")
def combo_dim_upsert(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    first = dense_ids(p.filter("p_partkey % 2 = 0").select("p_brand", "p_size").distinct(), ["p_brand", "p_size"], "combo_id")
    stored = _stored(first.select("combo_id", "p_brand", "p_size"), "combo_dim")
    return combo_upsert(stored, p.select("p_brand", "p_size").distinct(), ["p_brand", "p_size"], "combo_id")


# Type 3, distinct current and past pairs, with ids that go on.
@register("scd3_dim_upsert", oracle="""
WITH l AS (SELECT event_type AS current_type, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS past_type,
                  CAST(CAST(ts AS DATE) >= DATE '2024-01-03' AS INTEGER) AS batch
           FROM events WHERE user_id IS NOT NULL),
f AS (SELECT current_type, past_type, min(batch) AS batch FROM l GROUP BY 1, 2)
SELECT ROW_NUMBER() OVER (ORDER BY batch, current_type, past_type NULLS FIRST) AS change_id, current_type, past_type FROM f
""")
def scd3_dim_upsert(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type").filter("user_id is not null")
    lagged = lag_within_key(ev, "user_id", ["ts", "event_id"], ["event_type"], bucket=F.to_date("ts"))
    pairs = lagged.select("ts", F.col("event_type").alias("current_type"), F.col("event_type_past").alias("past_type"))
    names = ["current_type", "past_type"]
    first = dense_ids(pairs.filter(_day("ts", "2024-01-03")).select(*names).distinct(), names, "change_id")
    stored = _stored(first.select("change_id", *names), "change_dim")
    return combo_upsert(stored, pairs.select(*names).distinct(), names, "change_id")


# Dates of a batch that the stored date dimension lacks.
@register("dim_date_incremental", oracle=f"""
SELECT {DATE_ATTRS_SQL.format(d='d')}
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderdate IS NOT NULL AND o_orderstatus = 'F')
""")
def dim_date_incremental(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderdate", "o_orderstatus")
    stored = _stored(dim_date(o.filter(F.col("o_orderstatus") == "F"), "o_orderdate"), "date_dim")
    return dim_date(o, "o_orderdate", existing=stored)


# Period starts of a full calendar; no row is dropped.
@register("period_start_join_full", oracle="""
SELECT o_orderkey, CAST(strftime(date_trunc('quarter', o_orderdate), '%Y%m%d') AS INTEGER) AS quarter_key
FROM orders WHERE o_orderdate IS NOT NULL
""")
def period_start_join_full(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").withColumn("order_date", F.col("o_orderdate").cast("date"))
    return period_start_join(o, dim_date(o, "order_date"), "order_date", "quarter", "quarter_key", calendar="full").select("o_orderkey", "quarter_key")


# A transaction fact with surrogate keys, from the version valid at the date and a null-safe two-column match.
@register("star_fact_keys", oracle=SCD2_SQL + """,
person AS (SELECT ROW_NUMBER() OVER (ORDER BY user_id, start_date) AS person_id, * FROM versions),
e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d, event_type, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS kind FROM events),
combo AS (SELECT ROW_NUMBER() OVER (ORDER BY first_seen, event_type, k) AS combo_id, event_type, k
          FROM (SELECT event_type, COALESCE(kind, '') AS k, MIN(d) AS first_seen FROM e GROUP BY 1, 2))
SELECT e.event_id, p.person_id, c.combo_id, CAST(strftime(e.d, '%Y%m%d') AS INTEGER) AS date_key
FROM e JOIN person p ON p.user_id = e.user_id AND e.d BETWEEN p.start_date AND COALESCE(p.end_date, DATE '9999-12-31')
JOIN combo c ON c.event_type = e.event_type AND c.k = COALESCE(e.kind, '')
""")
def star_fact_keys(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type").withColumn("event_date", F.col("ts").cast("date"))
    ev = ev.withColumn("kind", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    daily = last_state_per_day(ev.filter(F.col("user_id").isNotNull()), "user_id", "ts", "event_id", ["event_type"])
    person = dense_ids(scd2_versions(daily, "user_id", "state_date", ["event_type"]), ["user_id", "start_date"], "person_id")
    person = person.select("person_id", "user_id", "start_date", "end_date")
    combos = first_seen_combinations(ev, ["event_type", "kind"], "event_date")
    combos = dense_ids(combos, ["first_seen", "event_type", "kind"], "combo_id").select("combo_id", F.col("event_type").alias("c_type"), F.col("kind").alias("c_kind"))
    dated = validity_join(ev, person, "user_id", "event_date")
    keyed = nullsafe_join(dated, combos, [("event_type", "c_type"), ("kind", "c_kind")])
    return keyed.select("event_id", "person_id", "combo_id", (F.year("event_date") * 10000 + F.month("event_date") * 100 + F.dayofmonth("event_date")).cast("int").alias("date_key"))


# A foreign key with orphans in it (every seventh key is shifted past the parents).
@register("dq_foreign_key_orphans", oracle="""
SELECT o_orderkey, k AS o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 100000000 ELSE o_custkey END AS k FROM orders)
WHERE k IS NOT NULL AND k NOT IN (SELECT c_custkey FROM customer)
""")
def dq_foreign_key_orphans(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    dirty = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_custkey") + 100000000).otherwise(F.col("o_custkey")))
    return quality.orphans(dirty, read_table(spark, sf_dir, "customer", "c_custkey"), ["o_custkey"], ["c_custkey"])


# Combinations whose attributes are NULL in some rows and empty in others, and a fact with one row for each event.
@register("combo_null_empty", oracle="""
WITH e AS (SELECT event_id, event_type, CAST(ts AS DATE) AS d, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE event_type END AS kind,
                  CASE event_id % 6 WHEN 0 THEN '' WHEN 3 THEN NULL ELSE 'u' || CAST(user_id % 3 AS VARCHAR) END AS band FROM events),
g AS (SELECT event_type, COALESCE(kind, '') AS k, COALESCE(band, '') AS b, MIN(d) AS first_seen FROM e GROUP BY 1, 2, 3),
combo AS (SELECT ROW_NUMBER() OVER (ORDER BY event_type, k, b) AS combo_id, * FROM g)
SELECT e.event_id, c.combo_id, c.first_seen FROM e JOIN combo c ON c.event_type = e.event_type AND c.k = COALESCE(e.kind, '') AND c.b = COALESCE(e.band, '')
""")
def combo_null_empty(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "event_type", "ts", "user_id")
    kind = F.when(F.col("event_id") % 4 == 1, "").when(F.col("event_id") % 4 > 1, F.col("event_type"))
    band = F.when(F.col("event_id") % 6 == 0, "").when(F.col("event_id") % 6 != 3, F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")))
    ev = ev.select("event_id", "event_type", "ts", kind.alias("kind"), band.alias("band"))
    attrs = ["event_type", "kind", "band"]
    combos = dense_ids(first_seen_combinations(ev, attrs, "ts"), attrs, "combo_id").select("combo_id", "first_seen", *[F.col(a).alias(f"c_{a}") for a in attrs])
    return nullsafe_join(ev, combos, [(a, f"c_{a}") for a in attrs]).select("event_id", "combo_id", "first_seen")


# dates as files spell them, and text that is none.
RAW_DATE = """CASE o_orderkey % 12
  WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'yyyy-M-d HH:mm:ss') WHEN 2 THEN date_format(o_orderdate, 'MM/dd/yyyy')
  WHEN 3 THEN date_format(o_orderdate, 'yyyyMMdd') WHEN 4 THEN date_format(o_orderdate, ' d-MMM-yyyy ') WHEN 5 THEN date_format(o_orderdate, 'MMM d, yyyy')
  WHEN 6 THEN date_format(o_orderdate, 'yyyy/MM/dd') WHEN 7 THEN date_format(o_orderdate, 'MMMM d, yyyy') WHEN 8 THEN date_format(o_orderdate, 'd MMMM yyyy')
  WHEN 9 THEN '2001-02-30' WHEN 10 THEN 'n/a' END"""


@register("date_lenient", oracle="""
SELECT o_orderkey, CASE WHEN o_orderkey % 12 < 9 THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders
""")
def date_lenient(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", F.expr(RAW_DATE).alias("raw")).select("o_orderkey", to_nullable_date("raw").alias("order_date"))


# A table's profile gathered by the tasks that write it.
@register("observed_profile", oracle="""
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT 'o_orderkey' AS column_name, count(*) AS row_count, count(*) - count(o_orderkey) AS null_count, CAST(min(o_orderkey) AS VARCHAR) AS min_value, CAST(max(o_orderkey) AS VARCHAR) AS max_value FROM t
UNION ALL SELECT 'o_custkey', count(*), count(*) - count(o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR) FROM t
UNION ALL SELECT 'o_orderstatus', count(*), count(*) - count(o_orderstatus), min(o_orderstatus), max(o_orderstatus) FROM t
UNION ALL SELECT 'order_date', count(*), count(*) - count(order_date), CAST(min(order_date) AS VARCHAR), CAST(max(order_date) AS VARCHAR) FROM t
""")
def observed_profile(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    t = o.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("o_custkey"),
                 F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), F.col("o_orderdate").cast("date").alias("order_date"))
    return quality.observed_profile(t, scratch_path(spark, "observed"))


# Two facts in buckets of one key, joined and summed where they lie.
@register("bucketed_star_join", oracle="""
SELECT o.o_orderkey, o.o_orderpriority, count(*) AS n_lines, CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
""")
def bucketed_star_join(spark, sf_dir, buckets=8, bucket_rows=BUCKET_ROWS):
    """``buckets`` is the least number; larger tables get more, so that a task's memory does not grow with them."""
    tag = uuid.uuid4().hex[:12]
    li, o = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity"), read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    buckets = bucket_count(li, o, rows=bucket_rows, least=buckets)
    li = write_bucketed(li, f"lineitem_{tag}", scratch_path(spark, "lineitem"), "l_orderkey", buckets)
    o = write_bucketed(o, f"orders_{tag}", scratch_path(spark, "orders"), "o_orderkey", buckets)
    return (li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"]).groupBy("o_orderkey", "o_orderpriority")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("quantity")))


# A type-2 dimension of which a batch rewrites only the buckets of its keys.
@register("scd2_bucket_update", oracle=SCD2_SQL.replace("FROM events WHERE", "FROM events WHERE (CAST(ts AS DATE) < DATE '2024-01-16' OR user_id % 20 = 3) AND") + "SELECT * FROM versions")
def scd2_bucket_update(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    daily = last_state_per_day(ev, "user_id", "ts", "event_id", ["event_type"])
    half = F.lit("2024-01-16").cast("date")
    store = Scd2Store(spark, scratch_path(spark, "person_buckets"), "user_id", "state_date", ["event_type"], buckets=16)
    store.build(daily.filter(F.col("state_date") < half))
    batch = daily.filter((F.col("state_date") >= half) & (F.col("user_id") % 20 == 3))
    store.apply(batch)
    store.apply(batch)  # changes nothing
    return store.read()


# Hash deltas against an index of which a batch reads its own prefixes.
@register("delta_indexed", oracle="""
WITH h AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, sha256(COALESCE(CAST(user_id AS VARCHAR), '') || '|' || event_type || '|' || strftime(ts, '%Y-%m-%d')) AS row_hash,
                  CASE WHEN event_id % 10 < 7 THEN 1 WHEN event_id % 10 < 9 THEN 2 ELSE 3 END AS load_no FROM events)
SELECT user_id, event_type, d AS event_day, row_hash, CAST(min(load_no) AS INTEGER) AS load_no FROM h GROUP BY 1, 2, 3, 4
""")
def delta_indexed(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts").withColumn("event_day", F.col("ts").cast("date"))
    hashed = ev.select("event_id", "user_id", "event_type", "event_day", row_hash(["user_id", "event_type", F.col("event_day").cast("string")]).alias("row_hash"))
    target, index = scratch_path(spark, "indexed_target"), HashIndex(spark, scratch_path(spark, "hash_index"))
    for no, some in enumerate(["event_id % 10 < 7", "event_id % 10 between 7 and 8", "true", "true"], start=1):
        batch = hashed.filter(some).drop("event_id").dropDuplicates(["row_hash"])
        new = _stored(index.new_rows(batch).withColumn("load_no", F.lit(no)), "delta_new")
        append_table(new, target)
        index.add(new)
    return spark.read.schema(new.schema).parquet(target)
