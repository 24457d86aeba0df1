"""Scans of the star-schema input tables (Parquet).

Column pruning and filter pushdown are left to Catalyst: callers select the
columns they need and filter on raw columns so ``PushedFilters`` reaches the
Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table; fails early (at plan time) when the path is missing."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """A scan in at least as many partitions as the session's shuffles.

    A small file is one task's work however much is done for each of its
    rows; work that is heavy for its bytes is dealt out before it starts.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)


class Tables:
    """Attribute access to the tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
