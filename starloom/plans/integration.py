"""Loads of several sources by row hash, and tables replaced by a swap."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.codes import band, flag
from starloom.functions.dates import date_from_digits, iso_date_text
from starloom.functions.text import not_found_default
from starloom.operators.dims import hierarchy_dim
from starloom.operators.integration import Layout, integrate_load
from starloom.operators.matview import ManifestView, MaterializedAggregate
from starloom.plans.registry import register
from starloom.session import scratch_path
from starloom.sources.files import append_table
from starloom.sources.tables import read_table
from starloom.sources.versions import VersionedTable

TARGET = [("source_system", "string"), ("person_id", "bigint"), ("full_date", "date"), ("kind", "string"), ("band", "string"), ("amount", "int")]
ATTRIBUTES = ["kind", "band", "amount"]
BALANCES = [("low", 0, 2499), ("middle", 2500, 7499), ("high", 7500, None)]

def source_layouts() -> dict[str, Layout]:
    """Persons and dates; dates as digits and no persons; neither."""
    return {
        "events": Layout("events", {"person_id": F.col("user_id"), "full_date": F.col("ts"), "kind": not_found_default("event_type"), "amount": F.floor("value")},
                         ["person_id", iso_date_text("full_date"), *ATTRIBUTES], "Not Found"),
        "orders": Layout("orders", {"full_date": date_from_digits("digits"), "kind": not_found_default("o_orderstatus"), "band": not_found_default("o_orderpriority"),
                                    "amount": F.floor(F.col("o_totalprice") / 100000)}, [iso_date_text("full_date"), *ATTRIBUTES], "Not Found"),
        "customer": Layout("customer", {"kind": not_found_default("c_mktsegment"), "band": band("balance", BALANCES)}, [F.lit(""), *ATTRIBUTES], "Not Found"),
    }


# Three sources of different layouts, loaded in full, by delta, and by delta once more.
@register("integrate_delta", oracle="""
WITH e AS (SELECT 'events' AS source_system, user_id AS person_id, CAST(ts AS DATE) AS full_date, COALESCE(NULLIF(trim(event_type), ''), 'Not Found') AS kind,
                  'Not Found' AS band, CAST(floor(value) AS INTEGER) AS amount, CASE WHEN event_id % 3 <> 0 THEN 1 ELSE 2 END AS load_no FROM events),
o AS (SELECT 'orders' AS source_system, CAST(NULL AS BIGINT) AS person_id, CAST(o_orderdate AS DATE) AS full_date, COALESCE(NULLIF(trim(o_orderstatus), ''), 'Not Found') AS kind,
             COALESCE(NULLIF(trim(o_orderpriority), ''), 'Not Found') AS band, CAST(floor(o_totalprice / 100000) AS INTEGER) AS amount, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS load_no FROM orders),
c AS (SELECT 'customer' AS source_system, CAST(NULL AS BIGINT) AS person_id, CAST(NULL AS DATE) AS full_date, COALESCE(NULLIF(trim(c_mktsegment), ''), 'Not Found') AS kind,
             CASE WHEN floor(c_acctbal) BETWEEN 0 AND 2499 THEN 'low' WHEN floor(c_acctbal) BETWEEN 2500 AND 7499 THEN 'middle' WHEN floor(c_acctbal) >= 7500 THEN 'high' ELSE 'Not Found' END AS band,
             CAST(NULL AS INTEGER) AS amount, CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 2 END AS load_no FROM customer),
h AS (
  SELECT *, sha256(source_system || '|' || COALESCE(CAST(person_id AS VARCHAR), '') || '|' || COALESCE(strftime(full_date, '%Y-%m-%d'), '') || '|' || kind || '|' || band || '|' || COALESCE(CAST(amount AS VARCHAR), '')) AS row_hash FROM e
  UNION ALL SELECT *, sha256(source_system || '|' || COALESCE(strftime(full_date, '%Y-%m-%d'), '') || '|' || kind || '|' || band || '|' || COALESCE(CAST(amount AS VARCHAR), '')) FROM o
  UNION ALL SELECT *, sha256(source_system || '|' || '' || '|' || kind || '|' || band || '|' || COALESCE(CAST(amount AS VARCHAR), '')) FROM c)
SELECT source_system, person_id, full_date, kind, band, amount, row_hash, CAST(min(load_no) AS INTEGER) AS load_no, true AS stamped
FROM h GROUP BY ALL
""".replace("GROUP BY ALL", "GROUP BY source_system, person_id, full_date, kind, band, amount, row_hash"))
def integrate_delta(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "value")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    orders = orders.withColumn("digits", F.date_format("o_orderdate", "Mddyyyy"))  # the leading zero is lost, as in the files
    customers = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_acctbal").withColumn("balance", F.floor("c_acctbal").cast("string"))
    table = VersionedTable(spark, scratch_path(spark, "integrated"))
    by = source_layouts()
    first = [(events.filter("event_id % 3 <> 0"), by["events"]), (orders.filter("o_orderkey % 2 = 0"), by["orders"]), (customers.filter("c_custkey % 5 = 0"), by["customer"])]
    whole = [(events, by["events"]), (orders, by["orders"]), (customers, by["customer"])]
    for no, (mode, sources) in enumerate([("full", first), ("delta", whole), ("delta", whole)], start=1):
        integrate_load(table, sources, TARGET, mode, stamps={"load_no": F.lit(no)})
    return table.read().withColumn("stamped", F.col("load_timestamp") <= F.current_timestamp()).drop("load_timestamp")


# A location dimension reloaded by a swap; a reader opened before it sees the old rows to the end.
@register("dim_location_swap", oracle="""
WITH h AS (SELECT DISTINCT r.r_name AS region_name, n.n_name AS nation_name, n.n_nationkey FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT 'before' AS seen, ROW_NUMBER() OVER (ORDER BY region_name, nation_name) AS location_id, region_name, nation_name FROM h WHERE n_nationkey % 2 = 0
UNION ALL
SELECT 'after', ROW_NUMBER() OVER (ORDER BY region_name, nation_name), region_name, nation_name FROM h
""")
def dim_location_swap(spark, sf_dir):
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    names = {"region_name": "r_name", "nation_name": "n_name"}
    table = VersionedTable(spark, scratch_path(spark, "dim_location"))
    table.swap(hierarchy_dim(n.filter("n_nationkey % 2 = 0"), r, "n_regionkey", "r_regionkey", names))
    before = table.read()
    table.swap(hierarchy_dim(n, r, "n_regionkey", "r_regionkey", names))
    return before.select(F.lit("before").alias("seen"), "*").unionByName(table.read().select(F.lit("after").alias("seen"), "*"))


# A stored aggregate refreshed from the files that are new; the last refresh finds none.
@register("mv_manifest_refresh", oracle="""
SELECT event_type, COUNT(*) AS n_events, COUNT(user_id) AS n_known, CAST(SUM(CASE WHEN value >= 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_large, 'new,new,none' AS refreshes
FROM events GROUP BY event_type
""")
def mv_manifest_refresh(spark, sf_dir):
    events = read_table(spark, sf_dir, "events", "event_id", "event_type", "user_id", "value")
    source = scratch_path(spark, "mv_source")
    aggregate = MaterializedAggregate(["event_type"], {"n_known": flag(F.col("user_id").isNotNull()), "n_large": flag(F.col("value") >= 20)}, "n_events")
    view = ManifestView(spark, scratch_path(spark, "mv_manifest"), aggregate, source)
    append_table(events.filter("event_id % 4 <> 3"), source)
    refreshes = [view.refresh()]
    append_table(events.filter("event_id % 4 = 3"), source)
    refreshes += [view.refresh(), view.refresh()]
    said = ",".join("new" if n else "none" for n in refreshes)
    return view.read().select("event_type", "n_events", F.col("n_known").cast("long").alias("n_known"), F.col("n_large").cast("long").alias("n_large"), F.lit(said).alias("refreshes"))
