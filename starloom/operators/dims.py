"""Date and hierarchy dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_attributes
from starloom.operators.keys import dense_ids


def dim_date(source: DataFrame, date_col: str, existing: DataFrame | None = None) -> DataFrame:
    """Date dimension rows for the distinct non-null dates of ``source``
    (only dates seen, SCD-0); with ``existing`` only the new dates."""
    dates = (source.select(F.col(date_col).cast("date").alias("__d"))
             .filter(F.col("__d").isNotNull()).distinct())
    if existing is not None:
        dates = dates.join(existing.select(F.col("full_date").alias("__d")), "__d", "left_anti")
    return dates.select(*date_attributes("__d"))


def calendar(source: DataFrame, date_col: str) -> DataFrame:
    """Full calendar (every day) of the months in which ``date_col`` occurs:
    the ``calendar='full'`` alternative to a dates-seen dimension.  The
    distinct months are few, so the day series per month is tiny."""
    months = source.select(F.trunc(F.col(date_col).cast("date"), "month").alias("__m")).distinct()
    days = months.select(F.explode(F.sequence(F.col("__m"), F.last_day(F.col("__m")))).alias("__d"))
    return days.select(*date_attributes("__d"))


def year_keys(dim: DataFrame) -> DataFrame:
    """``year -> MIN(date_key)``: the year key is the first date *seen*.
    One row per calendar year, so it is broadcast to the fact side."""
    return F.broadcast(dim.groupBy("year").agg(F.min("date_key").alias("year_key")))


def hierarchy_dim(child: DataFrame, parent: DataFrame, child_fk: str, parent_pk: str,
                  columns: dict[str, str], id_col: str = "location_id") -> DataFrame:
    """Flatten a child -> parent hierarchy into one dimension with dense ids
    in (parent name, child name) order (reload semantics, SCD-0)."""
    joined = child.join(parent, child[child_fk] == parent[parent_pk], "inner")
    flat = joined.select(*[F.col(src).alias(dst) for dst, src in columns.items()]).distinct()
    return dense_ids(flat, list(columns.keys()), id_col).select(id_col, *columns.keys())
