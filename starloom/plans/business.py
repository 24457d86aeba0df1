"""Report queries Q1-Q7 on the star-schema tables.

Each mirrors one business query of the source warehouse (same operator
mix and output shape) over the driver's tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import flag, month_number, safe_ratio, weighted_avg
from starloom.operators import reports
from starloom.operators.matview import ManifestView, MaterializedAggregate
from starloom.plans.dimensional import MONTHLY_SQL, QUARTER_SQL, YEARLY_SQL
from starloom.plans.registry import register, sql_div_round, sql_pct
from starloom.plans.warehouse import Warehouse, in_year
from starloom.sources.tables import read_table, table_path


# ---------------------------------------------------------------------------
# Q6: ratio to report -- share of each event type within a user bucket.
# ---------------------------------------------------------------------------
@register("q6_ratio_to_report", oracle=f"""
SELECT user_id % 4 AS user_bucket, event_type, COUNT(*) AS total_events,
       {sql_pct('COUNT(*)', 'SUM(COUNT(*)) OVER (PARTITION BY user_id % 4)')} AS event_share
FROM events
GROUP BY user_id % 4, event_type
""")
def q6_ratio_to_report(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "user_id", "event_type")
    ev = ev.withColumn("user_bucket", F.col("user_id") % 4)
    return reports.share_within(ev, ["user_bucket", "event_type"], ["user_bucket"],
                                count_name="total_events", share_name="event_share")


# ---------------------------------------------------------------------------
# Q1: materialised aggregate (kept, and refreshed from new files only) + share texts.
# ---------------------------------------------------------------------------
def q1_matview() -> MaterializedAggregate:
    return MaterializedAggregate(
        keys=["c_mktsegment", "o_orderpriority", "l_returnflag"],
        sums={"total_observations": F.lit(1),
              "total_returned": flag(F.upper(F.trim(F.coalesce(F.col("l_returnflag"), F.lit("")))) == "R"),
              "total_closed": flag(F.upper(F.trim(F.coalesce(F.col("l_linestatus"), F.lit("")))) == "F")},
        count_col="record_count")


def _year_range(col: str, year: int):
    lo = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    return (F.col(col) >= lo) & (F.col(col) < hi)


@register("q1_mv_shares", oracle=f"""
WITH mv AS (
  SELECT c.c_mktsegment, o.o_orderpriority, l.l_returnflag, COUNT(*) AS record_count,
         SUM(1) AS total_observations,
         SUM(CASE WHEN upper(trim(COALESCE(l.l_returnflag, ''))) = 'R' THEN 1 ELSE 0 END) AS total_returned,
         SUM(CASE WHEN upper(trim(COALESCE(l.l_linestatus, ''))) = 'F' THEN 1 ELSE 0 END) AS total_closed
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_shipdate >= TIMESTAMP '1997-01-01' AND l.l_shipdate < TIMESTAMP '1998-01-01'
  GROUP BY 1, 2, 3)
SELECT c_mktsegment, o_orderpriority, l_returnflag,
       CAST(total_observations AS BIGINT) AS total_observations, CAST(total_returned AS BIGINT) AS total_returned,
       CAST(total_closed AS BIGINT) AS total_closed,
       {sql_pct('total_returned', 'total_observations')} AS returned_share,
       {sql_pct('total_closed', 'total_observations')} AS closed_share
FROM mv
""")
def q1_mv_shares(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    o = w.scan("orders", "o_orderkey", "o_custkey", "o_orderpriority")
    c = w.scan("customer", "c_custkey", "c_mktsegment")

    def year_1997(lines):
        return (lines.select("l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate").filter(_year_range("l_shipdate", 1997))
                .join(o, F.col("l_orderkey") == o["o_orderkey"]).join(c, F.col("o_custkey") == c["c_custkey"]))

    q1_mv = q1_matview()
    view = ManifestView(spark, w.folder("q1_view", "orders", "customer"), q1_mv, table_path(sf_dir, "lineitem"), year_1997)
    view.refresh()
    out = view.read().select(*q1_mv.keys, *[F.col(n).cast("bigint").alias(n) for n in q1_mv.sums])
    return reports.with_percent_texts(out, {"returned_share": ("total_returned", "total_observations"),
                                            "closed_share": ("total_closed", "total_observations")}) \
        .orderBy(*q1_mv.keys)


# ---------------------------------------------------------------------------
# Q2: person-weighted monthly mean by month x status (hidden sort column).
# ---------------------------------------------------------------------------
def _months_of(spark, sf_dir, year):
    """The monthly fact of one year with its months, from that year's partition."""
    w = Warehouse(spark, sf_dir)
    dates = w.dates("orders", "o_orderdate").select("date_key", "year", "month", "month_name")
    return in_year(w.fact("monthly"), dates, "month_key", year)


@register("q2_weighted_monthly_avg", oracle=MONTHLY_SQL + f""",
m AS (SELECT monthly.*, year(d.fd) AS year, month(d.fd) AS month, monthname(d.fd) AS month_name
      FROM monthly JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fd FROM orders) d
        ON CAST(strftime(d.fd, '%Y%m%d') AS INTEGER) = monthly.month_key)
SELECT year, month_name, o_orderstatus, SUM(total_customers) AS total_customers,
       {sql_div_round('SUM(CAST(avg_price * 100 AS HUGEINT) * total_customers)', 'SUM(total_customers)', 2,
                      'DECIMAL(10,2)')} AS avg_price
FROM m WHERE year = 1997
GROUP BY year, month, month_name, o_orderstatus
""")
def q2_weighted_monthly_avg(spark, sf_dir):
    j = _months_of(spark, sf_dir, 1997)
    g = j.groupBy("year", "month", "month_name", "o_orderstatus").agg(
        F.sum("total_customers").alias("total_customers"),
        weighted_avg("avg_price", "total_customers").alias("avg_price"))
    return g.orderBy("year", "month", "o_orderstatus").select(
        "year", "month_name", "o_orderstatus", "total_customers", "avg_price")


# ---------------------------------------------------------------------------
# Q3: sum of rates / sum of customers by month, pivoted on status F and O
# (P is dropped, its month row stays), calendar month order.
# ---------------------------------------------------------------------------
@register("q3_pivot", oracle=MONTHLY_SQL + f""",
m AS (SELECT monthly.*, year(d.fd) AS year, month(d.fd) AS month, monthname(d.fd) AS month_name
      FROM monthly JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fd FROM orders) d
        ON CAST(strftime(d.fd, '%Y%m%d') AS INTEGER) = monthly.month_key),
r AS (SELECT year, month_name, o_orderstatus,
             {sql_div_round('CAST(SUM(high_value_rate) * 100 AS HUGEINT)', 'SUM(total_customers)', 2,
                            'DECIMAL(10,2)')} AS ratio
      FROM m WHERE year = 1997 GROUP BY year, month_name, o_orderstatus)
SELECT year, month_name, MAX(CASE WHEN o_orderstatus = 'F' THEN ratio END) AS status_f,
       MAX(CASE WHEN o_orderstatus = 'O' THEN ratio END) AS status_o
FROM r GROUP BY year, month_name
""")
def q3_pivot(spark, sf_dir):
    j = _months_of(spark, sf_dir, 1997)
    ratio = safe_ratio(F.sum(F.col("high_value_rate").cast("decimal(18,2)")), F.sum("total_customers"))
    per = j.groupBy("year", "month_name", "o_orderstatus").agg(ratio.alias("ratio"))
    piv = reports.pivot_max(per, ["year", "month_name"], "o_orderstatus", ["F", "O"], "ratio")
    return piv.select("year", "month_name", F.col("F").alias("status_f"), F.col("O").alias("status_o")) \
              .orderBy(month_number("month_name"))


# ---------------------------------------------------------------------------
# Q4: conditional shares by brand x line status.
# ---------------------------------------------------------------------------
@register("q4_conditional_shares", oracle=f"""
WITH g AS (
  SELECT year(l.l_shipdate) AS year, p.p_brand, l.l_linestatus, COUNT(*) AS total_lines,
         SUM(CASE WHEN upper(trim(COALESCE(l.l_returnflag, ''))) = 'R' THEN 1 ELSE 0 END) AS total_returned,
         SUM(CASE WHEN l.l_discount >= 0.05 THEN 1 ELSE 0 END) AS total_discounted
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_shipdate >= TIMESTAMP '1997-01-01' AND l.l_shipdate < TIMESTAMP '1998-01-01'
  GROUP BY 1, 2, 3)
SELECT year, p_brand, l_linestatus, total_lines, CAST(total_returned AS BIGINT) AS total_returned,
       CAST(total_discounted AS BIGINT) AS total_discounted,
       {sql_pct('total_returned', 'total_lines')} AS returned_share,
       {sql_pct('total_discounted', 'total_lines')} AS discounted_share
FROM g
""")
def q4_conditional_shares(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_partkey", "l_linestatus", "l_returnflag", "l_discount", "l_shipdate")
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_brand")
    f = li.filter(_year_range("l_shipdate", 1997)).join(p, li["l_partkey"] == p["p_partkey"]) \
          .withColumn("year", F.year("l_shipdate"))
    g = reports.conditional_counts(f, ["year", "p_brand", "l_linestatus"], {
        "total_returned": F.upper(F.trim(F.coalesce(F.col("l_returnflag"), F.lit("")))) == "R",
        "total_discounted": F.col("l_discount") >= 0.05}, total="total_lines")
    return reports.with_percent_texts(g, {"returned_share": ("total_returned", "total_lines"),
                                          "discounted_share": ("total_discounted", "total_lines")}) \
        .orderBy("p_brand", "l_linestatus")


# ---------------------------------------------------------------------------
# Q5: quarter fact re-summed, partition totals and ranks within quarter.
# ---------------------------------------------------------------------------
@register("q5_rank_window", oracle=QUARTER_SQL + f""",
q AS (SELECT quarterly.*, year(d.fd) AS year, quarter(d.fd) AS quarter, 'Q' || CAST(quarter(d.fd) AS VARCHAR) AS quarter_name
      FROM quarterly JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS fd FROM lineitem) d
        ON CAST(strftime(d.fd, '%Y%m%d') AS INTEGER) = quarterly.quarter_key),
g AS (SELECT year, quarter, quarter_name, s_nationkey, l_returnflag, SUM(total_lines) AS total_lines,
             SUM(discounted_lines) AS total_discounted, SUM(taxed_lines) AS total_taxed
      FROM q WHERE year = 1997 GROUP BY 1, 2, 3, 4, 5)
SELECT year, quarter, quarter_name, s_nationkey, l_returnflag, CAST(total_lines AS BIGINT) AS total_lines,
       CAST(total_discounted AS BIGINT) AS total_discounted, CAST(total_taxed AS BIGINT) AS total_taxed,
       {sql_pct('total_discounted', 'total_lines')} AS discounted_share,
       {sql_pct('total_taxed', 'total_lines')} AS taxed_share,
       CAST(SUM(total_discounted) OVER (PARTITION BY year, quarter, l_returnflag) AS BIGINT) AS flag_discounted_total,
       CAST(SUM(total_taxed) OVER (PARTITION BY year, quarter, l_returnflag) AS BIGINT) AS flag_taxed_total,
       RANK() OVER (PARTITION BY year, quarter ORDER BY total_discounted DESC) AS discounted_rank,
       RANK() OVER (PARTITION BY year, quarter ORDER BY total_taxed DESC) AS taxed_rank
FROM g
""")
def q5_rank_window(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    dates = w.dates("lineitem", "l_shipdate").select("date_key", "year", "quarter", "quarter_name")
    j = in_year(w.fact("quarterly"), dates, "quarter_key", 1997)
    g = j.groupBy("year", "quarter", "quarter_name", "s_nationkey", "l_returnflag").agg(
        F.sum("total_lines").alias("total_lines"),
        F.sum("discounted_lines").alias("total_discounted"),
        F.sum("taxed_lines").alias("total_taxed"))
    g = reports.with_percent_texts(g, {"discounted_share": ("total_discounted", "total_lines"),
                                       "taxed_share": ("total_taxed", "total_lines")})
    part = ["year", "quarter", "l_returnflag"]
    g = g.withColumns({
        "flag_discounted_total": reports.partition_total("total_discounted", part),
        "flag_taxed_total": reports.partition_total("total_taxed", part),
        "discounted_rank": reports.rank_within(["year", "quarter"], [F.col("total_discounted").desc()]),
        "taxed_rank": reports.rank_within(["year", "quarter"], [F.col("total_taxed").desc()]),
    })
    return g.orderBy("year", "quarter", "s_nationkey", "l_returnflag")


# ---------------------------------------------------------------------------
# Q7: region -> nation drill-down with GROUPING SETS and a level label.
# ---------------------------------------------------------------------------
@register("q7_grouping_sets", oracle=YEARLY_SQL + """,
f AS (SELECT y.*, r.r_name AS region_name, n.n_name AS nation_name, CAST(y.year_key / 10000 AS INTEGER) AS year
      FROM yearly y JOIN nation n ON y.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT year, region_name, CASE WHEN GROUPING(nation_name) = 1 THEN NULL ELSE nation_name END AS nation_name,
       CASE WHEN GROUPING(nation_name) = 1 THEN 'Region Level' ELSE 'Nation Level' END AS geography_level,
       CAST(SUM(count_urgent) AS BIGINT) AS total_urgent, CAST(SUM(count_high_value) AS BIGINT) AS total_high_value
FROM f WHERE year = 1997
GROUP BY GROUPING SETS ((year, region_name), (year, region_name, nation_name))
""")
def q7_grouping_sets(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    yf = in_year(w.fact("yearly"), w.dates("orders", "o_orderdate").select("date_key", "year"), "year_key", 1997)
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    loc = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select(
        "n_nationkey", F.col("r_name").alias("region_name"), F.col("n_name").alias("nation_name"))
    f = yf.join(loc, yf["c_nationkey"] == loc["n_nationkey"])
    out = reports.drilldown(f, ["year", "region_name"], "nation_name",
                            {"total_urgent": F.sum("count_urgent").cast("bigint"),
                             "total_high_value": F.sum("count_high_value").cast("bigint")},
                            parent_label="Region Level", child_label="Nation Level")
    return out.orderBy("region_name", F.col("nation_name").isNotNull(), "nation_name")
