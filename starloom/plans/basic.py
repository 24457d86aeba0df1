"""Scans, filters, conditionals, aggregates, sorts, set operations and
other single-table operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.functions import band, percent_text, range_guard
from starloom.operators import quality, reports
from starloom.operators.dims import calendar
from starloom.operators.lookups import seed_frame
from starloom.operators.joins import seed_broadcast
from starloom.plans.registry import register, sql_pct
from starloom.sources.tables import TABLES, read_table


def _ts(text: str):
    """Literal of the scan column's own type, so the predicate is pushed to Parquet."""
    return F.lit(text).cast("timestamp_ntz")


# Projection with literal, year filter, not-null filters.
@register("scan_filter_project", oracle="""
SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
       CAST(l_shipdate AS DATE) AS ship_date, 'lineitem' AS source_table
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'
  AND l_returnflag IS NOT NULL AND l_orderkey IS NOT NULL
""")
def scan_filter_project(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return (li.filter((F.col("l_shipdate") >= _ts("1997-01-01")) & (F.col("l_shipdate") < _ts("1998-01-01"))
                      & F.col("l_returnflag").isNotNull() & F.col("l_orderkey").isNotNull())
              .select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity",
                      F.col("l_shipdate").cast("date").alias("ship_date"),
                      F.lit("lineitem").alias("source_table")))


# BETWEEN guard, else NULL.
@register("range_guard", oracle="""
SELECT p_partkey, p_size, CASE WHEN p_size BETWEEN 0 AND 30 THEN p_size END AS guarded_size
FROM part
""")
def range_guard_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    return p.select("p_partkey", "p_size", range_guard("p_size", 0, 30).alias("guarded_size"))


# Banding over TRY_CONVERT(INT, text); '32.0'-style text -> Not Found.
def _age_text():
    return F.when(F.col("p_partkey") % 5 == 0, F.concat((F.col("p_size") + 20).cast("string"), F.lit(".0"))) \
            .otherwise((F.col("p_size") + 20).cast("string"))


@register("band_case", oracle="""
WITH t AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 5 = 0 THEN CAST(p_size + 20 AS VARCHAR) || '.0'
              ELSE CAST(p_size + 20 AS VARCHAR) END AS age_text
  FROM part),
n AS (SELECT p_partkey, age_text,
             CASE WHEN regexp_full_match(trim(age_text), '[+-]?[0-9]+') THEN TRY_CAST(trim(age_text) AS INTEGER) END AS age
      FROM t)
SELECT p_partkey, age_text,
       CASE WHEN age BETWEEN 18 AND 24 THEN '18-24'
            WHEN age BETWEEN 25 AND 34 THEN '25-34'
            WHEN age BETWEEN 35 AND 44 THEN '35-44'
            WHEN age BETWEEN 45 AND 54 THEN '45-54'
            WHEN age BETWEEN 55 AND 64 THEN '55-64'
            WHEN age >= 65 THEN '65+'
            ELSE 'Not Found' END AS age_band
FROM n
""")
def band_case(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    t = p.select("p_partkey", _age_text().alias("age_text"))
    return t.select("p_partkey", "age_text", band("age_text").alias("age_band"))


# IN list.
@register("in_list", oracle="""
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def in_list(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


# Indicator and conditional sums.
@register("conditional_sum", oracle="""
SELECT l_linestatus, COUNT(*) AS total_lines,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
       CAST(SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines
FROM lineitem GROUP BY l_linestatus
""")
def conditional_sum(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_linestatus", "l_returnflag", "l_discount")
    return reports.conditional_counts(li, ["l_linestatus"], {
        "returned_lines": F.col("l_returnflag") == "R",
        "discounted_lines": F.col("l_discount") >= 0.05,
    }, total="total_lines")


# NULLIF / COALESCE / ISNULL defaults.
@register("null_functions", oracle="""
SELECT COALESCE(NULLIF(event_type, 'error'), 'Not Found') AS event_class,
       COUNT(*) AS total_events,
       COUNT(NULLIF(event_type, 'error')) AS typed_events,
       SUM(CAST(COALESCE(value, 0) AS DECIMAL(18,2))) AS total_value
FROM events GROUP BY 1
""")
def null_functions(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_type", "value")
    typed = F.nullif(F.col("event_type"), F.lit("error"))
    return ev.groupBy(F.coalesce(typed, F.lit("Not Found")).alias("event_class")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count(typed).alias("typed_events"),
        F.sum(F.ifnull(F.col("value"), F.lit(0.0)).cast("decimal(18,2)")).alias("total_value"))


# Grouped COUNT(*).
@register("group_count", oracle="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS total_lines FROM lineitem GROUP BY 1, 2
""")
def group_count(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("total_lines"))


# SELECT DISTINCT.
@register("distinct_rows", oracle="SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, sf_dir):
    return read_table(spark, sf_dir, "orders", "o_orderstatus", "o_orderpriority").distinct()


# Multi-key ORDER BY (range-partitioned global sort).
@register("sort_multi_key", oracle="""
SELECT c_custkey, c_nationkey, c_acctbal FROM customer
ORDER BY c_nationkey, c_acctbal DESC, c_custkey
""")
def sort_multi_key(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    return c.orderBy(F.col("c_nationkey"), F.col("c_acctbal").desc(), F.col("c_custkey"))


# T4/T5: TOP n with a total order (top-k per task, then merge).
@register("top_n", oracle="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def top_n(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(10)


# S3, A1: row and column count of a table.
@register("table_profile", oracle="""
SELECT 'lineitem' AS table_name, COUNT(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem
""")
def table_profile(spark, sf_dir):
    return quality.profile(read_table(spark, sf_dir, "lineitem"), "lineitem")


# UNION ALL of row-count audits over every table.
@register("count_audit", oracle="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in TABLES))
def count_audit(spark, sf_dir):
    return quality.row_counts({t: read_table(spark, sf_dir, t) for t in TABLES})


# Ordered string aggregation per group.
@register("string_agg", oracle="""
SELECT r.r_name, string_agg(n.n_name, ',' ORDER BY n.n_name) AS nation_names, COUNT(*) AS nation_count
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def string_agg(spark, sf_dir):
    n = read_table(spark, sf_dir, "nation", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.groupBy("r_name").agg(
        F.expr("listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name)").alias("nation_names"),
        F.count(F.lit(1)).alias("nation_count"))


# Named intermediates daily -> monthly -> share of month.
@register("cte_chain", oracle=f"""
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS order_date, o_orderstatus, COUNT(*) AS n_orders
  FROM orders GROUP BY 1, 2),
monthly AS (
  SELECT date_trunc('month', order_date) AS order_month, o_orderstatus, SUM(n_orders) AS month_orders
  FROM daily GROUP BY 1, 2)
SELECT CAST(order_month AS DATE) AS order_month, o_orderstatus, CAST(month_orders AS BIGINT) AS month_orders,
       {sql_pct('month_orders', 'SUM(month_orders) OVER (PARTITION BY order_month)')} AS status_share
FROM monthly
""")
def cte_chain(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderdate", "o_orderstatus")
    daily = o.groupBy(F.col("o_orderdate").cast("date").alias("order_date"), "o_orderstatus") \
             .agg(F.count(F.lit(1)).alias("n_orders"))
    monthly = daily.groupBy(F.trunc("order_date", "month").alias("order_month"), "o_orderstatus") \
                   .agg(F.sum("n_orders").alias("month_orders"))
    total = F.sum("month_orders").over(Window.partitionBy("order_month"))
    return monthly.withColumn("status_share", percent_text(F.col("month_orders"), total))


# Inline seed relation joined to data.
PRIORITY_SEED = [
    ("1-URGENT", "Urgent"),
    ("2-HIGH", "High"),
    ("3-MEDIUM", "Medium"),
    ("4-NOT SPECIFIED", "Not specified"),
    ("5-LOW", "Low"),
]


@register("seed_values", oracle="""
WITH seed(priority_code, priority_label) AS (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in PRIORITY_SEED) + """)
SELECT s.priority_code, s.priority_label, COUNT(o.o_orderkey) AS order_count
FROM seed s LEFT JOIN orders o ON o.o_orderpriority = s.priority_code
GROUP BY 1, 2
""")
def seed_values(spark, sf_dir):
    seed = seed_broadcast(seed_frame(spark, PRIORITY_SEED, "priority_code string, priority_label string"))
    counts = read_table(spark, sf_dir, "orders", "o_orderpriority", "o_orderkey") \
        .groupBy("o_orderpriority").agg(F.count("o_orderkey").alias("order_count"))
    j = seed.join(counts, seed["priority_code"] == counts["o_orderpriority"], "left")
    return j.select("priority_code", "priority_label",
                    F.coalesce(F.col("order_count"), F.lit(0)).alias("order_count"))


# U4: number series (recursive counter) -> day spine of every month seen.
@register("number_series", oracle="""
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders),
d AS (SELECT CAST(unnest(generate_series(m, CAST(last_day(m) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d FROM m)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, day(d) AS day,
       dayname(d) AS day_name, month(d) AS month, monthname(d) AS month_name,
       quarter(d) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name, year(d) AS year
FROM d
""")
def number_series(spark, sf_dir):
    return calendar(read_table(spark, sf_dir, "orders", "o_orderdate"), "o_orderdate")


# Single-row relation (scalar subquery, evaluated once, no cross join).
@register("cross_single_row", oracle="""
SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE),
                             (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders)) AS days_before_last
FROM orders
""")
def cross_single_row(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    last = o.select(F.max("o_orderdate").cast("date").alias("m")).scalar()
    return o.select("o_orderkey", F.datediff(last, F.col("o_orderdate").cast("date")).alias("days_before_last"))

