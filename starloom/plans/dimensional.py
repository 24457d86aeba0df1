"""Integration, deduplication, dimensions (SCD 0/2/3, keys), facts, data
quality, materialised aggregates and sinks on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import flag, not_found_default, row_hash
from starloom.operators import dedup, quality
from starloom.operators.conform import SourceSpec, add_column_if_absent, conform_columns, integrate
from starloom.operators.dims import dim_date, hierarchy_dim
from starloom.operators.joins import validity_join
from starloom.operators.keys import dense_ids
from starloom.operators.matview import MaterializedAggregate
from starloom.operators.scd import (first_seen_combinations, lag_within_key, last_state_per_day,
                                    latest_per_key, scd2_versions)
from starloom.plans import warehouse
from starloom.plans.registry import register, sql_avg_dec
from starloom.plans.warehouse import Warehouse
from starloom.session import scratch_path
from starloom.sources.files import append_table, read_csv_text, write_csv
from starloom.sources.tables import read_table

DATE_ATTRS_SQL = """CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d} AS full_date, day({d}) AS day,
       dayname({d}) AS day_name, month({d}) AS month, monthname({d}) AS month_name, quarter({d}) AS quarter,
       'Q' || CAST(quarter({d}) AS VARCHAR) AS quarter_name, year({d}) AS year"""

# ---------------------------------------------------------------------------
# Conform and integrate sources.
# ---------------------------------------------------------------------------
INTEGRATED = [("source_system", "string"), ("entity_key", "bigint"), ("entity_name", "string"),
              ("nation_key", "int"), ("balance", "decimal(18,2)"), ("category", "string")]


def _integrated(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    s = read_table(spark, sf_dir, "supplier")
    p = read_table(spark, sf_dir, "part")
    return integrate([
        (c, SourceSpec("customer", {"entity_key": F.col("c_custkey"), "entity_name": F.col("c_name"),
                                    "nation_key": F.col("c_nationkey"), "balance": F.col("c_acctbal"),
                                    "category": not_found_default("c_mktsegment")})),
        (s, SourceSpec("supplier", {"entity_key": F.col("s_suppkey"), "entity_name": F.col("s_name"),
                                    "nation_key": F.col("s_nationkey"), "balance": F.col("s_acctbal")},
                       defaults={"category": "Not Found"})),
        (p, SourceSpec("part", {"entity_key": F.col("p_partkey"), "entity_name": F.col("p_name"),
                                "balance": F.col("p_retailprice"), "category": not_found_default("p_type")})),
    ], INTEGRATED)


@register("integrate_sources", oracle="""
WITH u AS (
  SELECT 'customer' AS source_system, c_custkey AS entity_key, c_name AS entity_name, c_nationkey AS nation_key,
         CAST(c_acctbal AS DECIMAL(18,2)) AS balance, COALESCE(NULLIF(trim(c_mktsegment), ''), 'Not Found') AS category
  FROM customer
  UNION ALL
  SELECT 'supplier', s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), 'Not Found' FROM supplier
  UNION ALL
  SELECT 'part', p_partkey, p_name, NULL, CAST(p_retailprice AS DECIMAL(18,2)),
         COALESCE(NULLIF(trim(p_type), ''), 'Not Found') FROM part)
SELECT *, sha256(COALESCE(source_system, '') || '|' || COALESCE(CAST(entity_key AS VARCHAR), '') || '|' ||
                 COALESCE(entity_name, '') || '|' || COALESCE(CAST(nation_key AS VARCHAR), '') || '|' ||
                 COALESCE(CAST(balance AS VARCHAR), '') || '|' || COALESCE(category, '')) AS row_hash
FROM u
""")
def integrate_sources(spark, sf_dir):
    u = _integrated(spark, sf_dir)
    return u.withColumn("row_hash", row_hash([c for c, _ in INTEGRATED]))


@register("conform_columns", oracle="""
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_id,
       CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS DECIMAL(18,2)) AS account_balance, 'initial' AS load_tag
FROM supplier
""")
def conform_columns_q(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    rename = {"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_nationkey": "nation_id", "s_phone": "phone"}
    target = [("supplier_id", "bigint"), ("supplier_name", "string"), ("nation_id", "int"),
              ("phone", "string"), ("account_balance", "decimal(18,2)")]
    out = conform_columns(s, rename, target)
    return add_column_if_absent(out, "load_tag", "string", "initial")


# ---------------------------------------------------------------------------
# In-batch duplicate removal (keep first by a total order).
# ---------------------------------------------------------------------------
@register("dedup_row_number", oracle="""
WITH r AS (SELECT user_id, CAST(ts AS DATE) AS event_day, event_type, event_id, value,
                  ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY event_id) AS rn
           FROM events)
SELECT user_id, event_day, event_type, event_id, value FROM r WHERE rn = 1
""")
def dedup_row_number(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "event_type", "event_id", "value")
    p = ev.select("user_id", F.col("ts").cast("date").alias("event_day"), "event_type", "event_id", "value")
    return dedup.keep_first(p, ["user_id", "event_day", "event_type"], [F.col("event_id")])


# ---------------------------------------------------------------------------
# Previous value per key (type-3 current/past), hot keys bucketed by day.
# ---------------------------------------------------------------------------
@register("scd3_lag_past", oracle="""
SELECT event_id, user_id, event_type,
       LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS event_type_past
FROM events WHERE user_id IS NOT NULL
UNION ALL
SELECT event_id, user_id, event_type, NULL FROM events WHERE user_id IS NULL
""")
def scd3_lag_past(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    out = lag_within_key(ev, "user_id", ["ts", "event_id"], ["event_type"], bucket=F.to_date("ts"))
    return out.select("event_id", "user_id", "event_type", "event_type_past")


# ---------------------------------------------------------------------------
# Type-2 history from the daily state of each user.
# ---------------------------------------------------------------------------
def _user_versions(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "ts", "event_id", "event_type")
    daily = last_state_per_day(ev.filter(F.col("user_id").isNotNull()), "user_id", "ts", "event_id", ["event_type"])
    return scd2_versions(daily, "user_id", "state_date", ["event_type"])


SCD2_SQL = """
WITH r AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type,
                  ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
           FROM events WHERE user_id IS NOT NULL),
daily AS (SELECT user_id, d, event_type FROM r WHERE rn = 1),
ch AS (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY d, event_type) AS prev FROM daily),
v AS (SELECT user_id, event_type, d FROM ch WHERE prev IS NULL OR prev <> event_type),
versions AS (
  SELECT user_id, event_type, d AS start_date,
         CAST(LEAD(d) OVER w - INTERVAL 1 DAY AS DATE) AS end_date,
         LEAD(d) OVER w IS NULL AS is_current,
         CAST(ROW_NUMBER() OVER w AS INTEGER) AS version_no
  FROM v WINDOW w AS (PARTITION BY user_id ORDER BY d, event_type))
"""


@register("scd2_person", oracle=SCD2_SQL + "SELECT * FROM versions")
def scd2_person(spark, sf_dir):
    return _user_versions(spark, sf_dir)


# Fact joined to the version valid at its date.
@register("scd2_asof_join", oracle=SCD2_SQL + """
SELECT e.event_id, e.user_id, v.version_no, v.event_type AS state
FROM events e JOIN versions v ON v.user_id = e.user_id
 AND CAST(e.ts AS DATE) BETWEEN v.start_date AND COALESCE(v.end_date, DATE '9999-12-31')
""")
def scd2_asof_join(spark, sf_dir):
    versions = _user_versions(spark, sf_dir).select("user_id", "start_date", "end_date", "version_no",
                                                    F.col("event_type").alias("state"))
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts") \
        .withColumn("event_date", F.col("ts").cast("date"))
    return validity_join(ev, versions, "user_id", "event_date").select("event_id", "user_id", "version_no", "state")


# Latest row per key.
@register("latest_per_key", oracle="""
WITH r AS (SELECT user_id, event_id, event_type, ts,
                  ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, event_id, event_type, ts FROM r WHERE rn = 1
""")
def latest_per_key_q(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "event_id", "event_type", "ts")
    return latest_per_key(ev, "user_id", ["ts", "event_id"], ["event_id", "event_type", "ts"])


# Dense deterministic surrogate keys.
@register("surrogate_key", oracle="""
SELECT ROW_NUMBER() OVER (ORDER BY event_type, user_id) AS type_user_id, event_type, user_id
FROM (SELECT DISTINCT event_type, user_id FROM events)
""")
def surrogate_key(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_type", "user_id").distinct()
    return dense_ids(ev, ["event_type", "user_id"], "type_user_id").select("type_user_id", "event_type", "user_id")


# Date dimension of the dates seen.
@register("dim_date", oracle=f"""
SELECT {DATE_ATTRS_SQL.format(d='d')}
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)
""")
def dim_date_q(spark, sf_dir):
    return dim_date(read_table(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate")


# Hierarchy dimension reload with dense ids.
@register("dim_location_reload", oracle="""
SELECT ROW_NUMBER() OVER (ORDER BY r_name, n_name) AS location_id, r_name AS region_name, n_name AS nation_name
FROM (SELECT DISTINCT r.r_name, n.n_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
""")
def dim_location_reload(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return hierarchy_dim(n, r, "n_regionkey", "r_regionkey",
                         {"region_name": "r_name", "nation_name": "n_name"}, "location_id")


# Insert-if-new combinations with the date first seen.
@register("combo_dim_first_seen", oracle="""
WITH f AS (SELECT l_returnflag, l_linestatus,
                  MIN(COALESCE(CAST(l_shipdate AS DATE), DATE '1900-01-01')) AS first_seen
           FROM lineitem GROUP BY 1, 2)
SELECT ROW_NUMBER() OVER (ORDER BY first_seen, l_returnflag, l_linestatus) AS combo_id, * FROM f
""")
def combo_dim_first_seen(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus", "l_shipdate")
    combos = first_seen_combinations(li, ["l_returnflag", "l_linestatus"], "l_shipdate")
    return dense_ids(combos, ["first_seen", "l_returnflag", "l_linestatus"], "combo_id") \
        .select("combo_id", "l_returnflag", "l_linestatus", "first_seen")


# ---------------------------------------------------------------------------
# Facts (D14-D17).
# ---------------------------------------------------------------------------
@register("observation_fact", oracle="""
SELECT l.l_orderkey, l.l_linenumber, CAST(strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
       s.s_nationkey, p.p_brand, 1 AS observation_count, l.l_returnflag
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_shipdate IS NOT NULL
""")
def observation_fact(spark, sf_dir):
    return warehouse.observation_fact(Warehouse(spark, sf_dir))


MONTHLY_SQL = f"""
WITH on_ AS (SELECT o.*, CAST(o.o_orderdate AS DATE) AS order_date, c.c_nationkey
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dd AS (SELECT DISTINCT order_date AS fd FROM on_ WHERE order_date IS NOT NULL),
base AS (SELECT on_.*, CAST(strftime(dd.fd, '%Y%m%d') AS INTEGER) AS month_key,
                CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS hv
         FROM on_ JOIN dd ON year(dd.fd) = year(on_.order_date) AND month(dd.fd) = month(on_.order_date)
          AND day(dd.fd) = 1),
monthly AS (
SELECT c_nationkey, o_orderstatus, month_key, COUNT(DISTINCT o_custkey) AS total_customers,
       {sql_avg_dec('o_totalprice')} AS avg_price,
       {sql_avg_dec('hv')} AS high_value_rate,
       CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS urgent_count
FROM base GROUP BY 1, 2, 3)
"""


# Monthly summary fact.
@register("monthly_fact", oracle=MONTHLY_SQL + "SELECT * FROM monthly")
def monthly_fact(spark, sf_dir):
    return warehouse.monthly_fact(Warehouse(spark, sf_dir))


QUARTER_SQL = """
WITH l AS (SELECT l.*, CAST(l.l_shipdate AS DATE) AS ship_date, s.s_nationkey
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
dd AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS fd FROM lineitem WHERE l_shipdate IS NOT NULL),
base AS (SELECT l.*, CAST(strftime(dd.fd, '%Y%m%d') AS INTEGER) AS quarter_key
         FROM l JOIN dd ON year(dd.fd) = year(l.ship_date) AND quarter(dd.fd) = quarter(l.ship_date)
          AND month(dd.fd) IN (1, 4, 7, 10) AND day(dd.fd) = 1),
quarterly AS (
SELECT quarter_key, s_nationkey, l_returnflag, COUNT(DISTINCT l_suppkey) AS total_suppliers, COUNT(*) AS total_lines,
       CAST(SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines,
       CAST(SUM(CASE WHEN l_tax >= 0.04 THEN 1 ELSE 0 END) AS BIGINT) AS taxed_lines
FROM base GROUP BY 1, 2, 3)
"""


# Quarterly summary fact (quarter start must be a date seen).
@register("quarter_fact", oracle=QUARTER_SQL + "SELECT * FROM quarterly")
def quarter_fact(spark, sf_dir):
    return warehouse.quarter_fact(Warehouse(spark, sf_dir))


YEARLY_SQL = """
WITH on_ AS (SELECT o.*, CAST(o.o_orderdate AS DATE) AS order_date, c.c_nationkey
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
yk AS (SELECT year(d) AS y, MIN(CAST(strftime(d, '%Y%m%d') AS INTEGER)) AS year_key
       FROM (SELECT DISTINCT order_date AS d FROM on_ WHERE order_date IS NOT NULL) GROUP BY 1),
yearly AS (
SELECT c_nationkey, year_key,
       CAST(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS count_urgent,
       CAST(SUM(CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END) AS BIGINT) AS count_high_value
FROM on_ JOIN yk ON yk.y = year(on_.order_date) GROUP BY 1, 2)
"""


# Yearly fact keyed by the first date seen in the year.
@register("yearly_fact", oracle=YEARLY_SQL + "SELECT * FROM yearly")
def yearly_fact(spark, sf_dir):
    return warehouse.yearly_fact(Warehouse(spark, sf_dir))


# ---------------------------------------------------------------------------
# Data quality.
# ---------------------------------------------------------------------------
@register("dq_unique", oracle="""
SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_date, COUNT(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def dq_unique(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_custkey", "o_orderdate") \
        .select("o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return quality.duplicate_keys(o, ["o_custkey", "order_date"])


@register("dq_foreign_key", oracle="""
SELECT 'lineitem.l_partkey' AS fk_name, l_orderkey AS row_key FROM lineitem l
WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'lineitem.l_suppkey', l_orderkey FROM lineitem l
WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)
UNION ALL
SELECT 'orders.o_custkey', o_orderkey FROM orders o
WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
""")
def dq_foreign_key(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey")
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    checks = [
        ("lineitem.l_partkey", quality.orphans(li, read_table(spark, sf_dir, "part", "p_partkey"),
                                               ["l_partkey"], ["p_partkey"]), "l_orderkey"),
        ("lineitem.l_suppkey", quality.orphans(li, read_table(spark, sf_dir, "supplier", "s_suppkey"),
                                               ["l_suppkey"], ["s_suppkey"]), "l_orderkey"),
        ("orders.o_custkey", quality.orphans(o, read_table(spark, sf_dir, "customer", "c_custkey"),
                                             ["o_custkey"], ["c_custkey"]), "o_orderkey"),
    ]
    frames = [df.select(F.lit(name).alias("fk_name"), F.col(k).alias("row_key")) for name, df, k in checks]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("dq_not_null", oracle="\nUNION ALL\n".join(
    f"SELECT 'customer' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM customer"
    for c in CUSTOMER_COLS))
def dq_not_null(spark, sf_dir):
    return quality.null_counts(read_table(spark, sf_dir, "customer"), CUSTOMER_COLS, "customer")


# ---------------------------------------------------------------------------
# Materialised aggregate built on one half and refreshed with the other.
# ---------------------------------------------------------------------------
def line_matview() -> MaterializedAggregate:
    return MaterializedAggregate(
        keys=["l_returnflag", "l_linestatus"],
        sums={"total_qty": F.col("l_quantity").cast("decimal(18,2)"),
              "total_price": F.col("l_extendedprice").cast("decimal(18,2)"),
              "discounted_lines": flag(F.col("l_discount") >= 0.05)})


@register("mv_incremental", oracle="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS record_count,
       SUM(CAST(l_quantity AS DECIMAL(18,2))) AS total_qty, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_price,
       CAST(SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines
FROM lineitem GROUP BY 1, 2
""")
def mv_incremental(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    cut = F.lit("1997-01-01").cast("timestamp_ntz")
    first = li.filter(F.col("l_shipdate") < cut)
    rest = li.filter((F.col("l_shipdate") >= cut) | F.col("l_shipdate").isNull())
    mv = line_matview()
    path = mv.build(spark, first, "mv_lineitem")
    path = mv.refresh(spark, path, rest, "mv_lineitem")
    out = spark.read.parquet(path)
    return out.withColumn("discounted_lines", F.col("discounted_lines").cast("bigint"))


# ---------------------------------------------------------------------------
# CSV round trip and append sink (written below the shared root).
# ---------------------------------------------------------------------------
@register("csv_roundtrip", oracle="""
SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)) AS s_acctbal FROM supplier
""")
def csv_roundtrip(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal") \
        .withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(18,2)"))
    path = scratch_path(spark, "csv_supplier")
    write_csv(s, path)
    back = read_csv_text(spark, path, ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    return back.select(F.col("s_suppkey").try_cast("bigint").alias("s_suppkey"), "s_name",
                       F.col("s_nationkey").try_cast("int").alias("s_nationkey"),
                       F.col("s_acctbal").try_cast("decimal(18,2)").alias("s_acctbal"))


@register("append_sink", oracle="SELECT * FROM customer")
def append_sink(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "append_customer")
    low = F.col("c_custkey") % 2 == 0
    append_table(c.filter(low), path)
    append_table(c.filter(~low | F.col("c_custkey").isNull()), path)
    return spark.read.parquet(path)
