"""Stored date dimensions and facts that reports read.

The facts of one set of input files are built once and kept below the shared
folder, partitioned by year; a report reads them through a filter on the
date dimension, and a join on the year as well as the key lets Spark read
the years that it needs and no others.  The folder's name is drawn from the
input files' names, lengths and times of change, so changed inputs build
new facts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import decimal_avg, flag
from starloom.functions.dates import date_key
from starloom.operators.dims import dim_date, year_keys
from starloom.operators.joins import period_start_join
from starloom.session import checkpoint_root
from starloom.sources.files import data_files
from starloom.sources.tables import read_table, table_path
from starloom.sources.versions import VersionedTable

Builder = Callable[["Warehouse"], DataFrame]


class Warehouse:
    """Stored tables derived from the inputs in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def scan(self, name: str, *columns: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, *columns)

    def folder(self, name: str, *inputs: str) -> str:
        """Where the table ``name`` of the present input files is stored."""
        files = [f for t in inputs for f in data_files(self.spark, table_path(self.sf_dir, t))]
        return f"{checkpoint_root(self.spark)}/warehouse/{name}-{hashlib.sha256(repr(files).encode()).hexdigest()[:16]}"

    def stored(self, name: str, inputs: tuple[str, ...], build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
        """The table ``name``, built if it isn't there."""
        table = VersionedTable(self.spark, self.folder(name, *inputs))
        if not table.exists():
            table.swap(build(), partition_by)
        return table.read()

    def dates(self, table: str, column: str) -> DataFrame:
        """The date dimension of the dates seen in ``table``."""
        return self.stored(f"dates_{table}", (table,), lambda: dim_date(self.scan(table, column), column))

    def fact(self, name: str) -> DataFrame:
        """A fact, partitioned by ``year``."""
        build, key, inputs = FACTS[name]
        by_year = lambda: build(self).withColumn("year", F.floor(F.col(key) / 10000).cast("int")).repartition("year")
        return self.stored(name, inputs, by_year, ("year",))


def _orders_with_nation(w: Warehouse) -> DataFrame:
    o = w.scan("orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority").withColumn("order_date", F.col("o_orderdate").cast("date"))
    c = w.scan("customer", "c_custkey", "c_nationkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"])


def monthly_fact(w: Warehouse) -> DataFrame:
    """Customers, mean price, share of high prices and urgent orders by nation, status and month."""
    base = period_start_join(_orders_with_nation(w), w.dates("orders", "o_orderdate"), "order_date", "month", "month_key")
    return base.groupBy("c_nationkey", "o_orderstatus", "month_key").agg(
        F.countDistinct("o_custkey").alias("total_customers"),
        decimal_avg("o_totalprice").alias("avg_price"),
        decimal_avg(flag(F.col("o_totalprice") >= 250000)).alias("high_value_rate"),
        F.sum(flag(F.col("o_orderpriority") == "1-URGENT")).cast("bigint").alias("urgent_count"))


def quarter_fact(w: Warehouse) -> DataFrame:
    """Suppliers and lines by quarter, nation and return flag."""
    li = w.scan("lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_discount", "l_tax").withColumn("ship_date", F.col("l_shipdate").cast("date"))
    s = w.scan("supplier", "s_suppkey", "s_nationkey")
    base = period_start_join(li.join(s, li["l_suppkey"] == s["s_suppkey"]), w.dates("lineitem", "l_shipdate"), "ship_date", "quarter", "quarter_key")
    return base.groupBy("quarter_key", "s_nationkey", "l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("total_suppliers"),
        F.count(F.lit(1)).alias("total_lines"),
        F.sum(flag(F.col("l_discount") >= 0.05)).cast("bigint").alias("discounted_lines"),
        F.sum(flag(F.col("l_tax") >= 0.04)).cast("bigint").alias("taxed_lines"))


def yearly_fact(w: Warehouse) -> DataFrame:
    """Urgent and high-priced orders by nation and year (keyed by the first date seen)."""
    on = _orders_with_nation(w)
    yk = year_keys(w.dates("orders", "o_orderdate"))
    return on.join(yk, F.year("order_date") == yk["year"]).groupBy("c_nationkey", "year_key").agg(
        F.sum(flag(F.col("o_orderpriority") == "1-URGENT")).cast("bigint").alias("count_urgent"),
        F.sum(flag(F.col("o_totalprice") >= 250000)).cast("bigint").alias("count_high_value"))


def observation_fact(w: Warehouse) -> DataFrame:
    """One row for each line with a date: its key needs no look-up."""
    li = w.scan("lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_returnflag").filter("l_shipdate is not null")
    s, p = w.scan("supplier", "s_suppkey", "s_nationkey"), w.scan("part", "p_partkey", "p_brand")
    f = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    return f.select("l_orderkey", "l_linenumber", date_key("l_shipdate").alias("date_key"), "s_nationkey", "p_brand",
                    F.lit(1).alias("observation_count"), "l_returnflag")


#: Builder, key whose first four digits are the year, and input tables of each stored fact.
FACTS: dict[str, tuple[Builder, str, tuple[str, ...]]] = {
    "monthly": (monthly_fact, "month_key", ("orders", "customer")),
    "quarterly": (quarter_fact, "quarter_key", ("lineitem", "supplier")),
    "yearly": (yearly_fact, "year_key", ("orders", "customer")),
}


def in_year(fact: DataFrame, dates: DataFrame, key: str, year: int) -> DataFrame:
    """The fact's rows of one year with their date attributes, read from that year's partition alone."""
    d = dates.filter(F.col("year") == year).withColumnRenamed("year", "d_year")
    return fact.join(d, (fact[key] == d["date_key"]) & (fact["year"] == d["d_year"])).drop("d_year")
