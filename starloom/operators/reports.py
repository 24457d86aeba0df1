"""Report operators: shares, conditional counts, weighted averages, pivots,
ranks, ratio-to-report and hierarchical grouping sets.

Report inputs are facts that are already aggregated to a modest number of
groups, so windows here run over grouped rows (bounded by the number of
groups), never over raw detail rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.codes import flag
from starloom.functions.fmt import percent_text


def conditional_counts(df: DataFrame, group_cols: Sequence[str | Column],
                       conditions: Mapping[str, Column], total: str = "total") -> DataFrame:
    """``COUNT(*)`` plus ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` per group."""
    aggs = [F.count(F.lit(1)).alias(total)]
    aggs += [F.sum(flag(c)).cast("bigint").alias(name) for name, c in conditions.items()]
    return df.groupBy(*group_cols).agg(*aggs)


def with_percent_texts(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add ``name = percent_text(num, den)`` columns."""
    return df.withColumns({name: percent_text(num, den) for name, (num, den) in pairs.items()})


def share_within(df: DataFrame, group_cols: Sequence[str], partition_cols: Sequence[str],
                 count_name: str = "total", share_name: str = "share") -> DataFrame:
    """Group count and its share of the partition total
    (``COUNT(*) * 100 / SUM(COUNT(*)) OVER (PARTITION BY ...)``) as text."""
    counts = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(count_name))
    w = Window.partitionBy(*partition_cols)
    part_total = F.sum(count_name).over(w)
    return counts.withColumn(share_name, percent_text(F.col(count_name), part_total))


def partition_total(col: str, partition_cols: Sequence[str]) -> Column:
    """Whole-partition total ``SUM(col) OVER (PARTITION BY ...)``."""
    return F.sum(col).over(Window.partitionBy(*partition_cols))


def rank_within(partition_cols: Sequence[str], order: Sequence[Column]) -> Column:
    """``RANK() OVER (PARTITION BY ... ORDER BY ...)`` as bigint."""
    return F.rank().over(Window.partitionBy(*partition_cols).orderBy(*order)).cast("bigint")


def pivot_max(df: DataFrame, group_cols: Sequence[str], pivot_col: str,
              values: Sequence[str], value_col: str) -> DataFrame:
    """``PIVOT (MAX(value) FOR pivot IN (values))``: other pivot values are
    dropped, but their group rows stay (with NULLs)."""
    return df.groupBy(*group_cols).pivot(pivot_col, list(values)).agg(F.max(value_col))


def drilldown(df: DataFrame, parent_cols: Sequence[str], child_col: str,
              measures: Mapping[str, Column], level_name: str = "geography_level",
              parent_label: str = "Country Level", child_label: str = "State Level") -> DataFrame:
    """``GROUP BY GROUPING SETS ((parents), (parents, child))`` with a level
    label from ``GROUPING(child)``; the child is NULL on parent rows."""
    cols = [*parent_cols, child_col]
    aggs = [m.alias(n) for n, m in measures.items()]
    aggs.append(F.grouping(child_col).alias("__g"))
    out = df.groupingSets([list(parent_cols), cols], *cols).agg(*aggs)
    level = F.when(F.col("__g") == 1, F.lit(parent_label)).otherwise(F.lit(child_label))
    child = F.when(F.col("__g") == 1, F.lit(None)).otherwise(F.col(child_col))
    return out.select(*parent_cols, child.alias(child_col), level.alias(level_name),
                      *measures.keys())
