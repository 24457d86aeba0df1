"""Data-quality checks: the table constraints of the source warehouse
re-aimed as queries that return the offending rows (or counts).

Every check is a distributed aggregate or anti join; nothing is collected
to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "n_rows") -> DataFrame:
    """UNIQUE / PRIMARY KEY: key values that occur more than once."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def orphans(child: DataFrame, parent: DataFrame, child_keys: Sequence[str],
            parent_keys: Sequence[str]) -> DataFrame:
    """FOREIGN KEY: child rows whose non-NULL key has no parent row."""
    cond = [child[c] == parent[p] for c, p in zip(child_keys, parent_keys)]
    present = child
    for c in child_keys:
        present = present.filter(F.col(c).isNotNull())
    return present.join(parent.select(*parent_keys), cond, "left_anti")


def null_counts(df: DataFrame, columns: Sequence[str], table: str | None = None) -> DataFrame:
    """NOT NULL: one row per column with its NULL count (one pass)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    out = agg.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row-count audit: ``(table_name, row_count)`` per table, as one
    distributed union of global aggregates."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def profile(df: DataFrame, name: str) -> DataFrame:
    """Row and column count of one table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"), "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def hierarchy_orphans(rows: DataFrame, child_col: str, parent_col: str,
                      masters: DataFrame, master_child: str, master_parent: str,
                      normalize: Callable[[Column], Column]) -> DataFrame:
    """Rows whose (child, parent) names do not match the master hierarchy
    after normalisation (expect none)."""
    keyed = rows.select("*", normalize(F.col(child_col)).alias("__c"),
                        normalize(F.col(parent_col)).alias("__p"))
    m = masters.select(normalize(F.col(master_child)).alias("__c"),
                       normalize(F.col(master_parent)).alias("__p")).distinct()
    return keyed.join(m, ["__c", "__p"], "left_anti").drop("__c", "__p")


def write_observed(df: DataFrame, path: str, mode: str = "errorifexists") -> dict[str, tuple[int, int, str | None, str | None]]:
    """Write a table and profile it in the same pass: rows, NULLs, least and greatest value (as text) of each column.

    The figures are gathered by the tasks that write, so the table is read
    once however many columns are profiled.  Columns that can't be ordered
    (maps) have no least and greatest value.
    """
    seen = Observation("profile")
    ordered = [f.name for f in df.schema if not f.dataType.typeName() == "map"]
    figures = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        figures.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"null{i}"))
        if c in ordered:
            figures += [F.min(F.col(f"`{c}`")).cast("string").alias(f"min{i}"), F.max(F.col(f"`{c}`")).cast("string").alias(f"max{i}")]
    df.observe(seen, *figures).write.mode(mode).parquet(path)
    got = seen.get
    return {c: (got["n"], got[f"null{i}"], got.get(f"min{i}"), got.get(f"max{i}")) for i, c in enumerate(df.columns)}


def observed_profile(df: DataFrame, path: str) -> DataFrame:
    """``write_observed`` as a relation: ``column_name, row_count, null_count, min_value, max_value``, a row for each column."""
    rows = [(c, *figures) for c, figures in write_observed(df, path).items()]
    return df.sparkSession.createDataFrame(rows, "column_name string, row_count long, null_count long, min_value string, max_value string")
