"""Join helpers: seed broadcast, null-safe keys, validity (as-of
interval) joins, period-start joins and top-1-per-key lateral lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import date_key


def seed_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a seed relation built from fixed literal rows (constant size)."""
    return F.broadcast(df)


def nullsafe_key(col: str | Column, default: str = "") -> Column:
    """Key where NULL equals NULL and equals ``default`` (``ISNULL(x,'')``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(default))


def nullsafe_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]],
                  how: str = "inner") -> DataFrame:
    """Equi join on several columns with ``ISNULL(a,'') = ISNULL(b,'')`` semantics.

    The coalesced keys are plain equi keys, so the planner can still choose a
    hash or broadcast join (unlike an OR-of-null-tests predicate).
    """
    names = [f"__nk{i}" for i in range(len(pairs))]
    lk = left.select("*", *[nullsafe_key(a).alias(n) for (a, _), n in zip(pairs, names)])
    rk = right.select("*", *[nullsafe_key(b).alias(n + "_r") for (_, b), n in zip(pairs, names)])
    cond = [lk[n] == rk[n + "_r"] for n in names]
    out = lk.join(rk, cond, how)
    return out.drop(*names, *[n + "_r" for n in names])


def distinct_combinations(df: DataFrame, attrs: Sequence[str], aggregates: Sequence[Column] = ()) -> DataFrame:
    """One row for each combination of ``attrs`` under ``nullsafe_join``'s equality, with ``aggregates``.

    Of a NULL and an empty text in one place the row holds the empty text.
    """
    keys = [nullsafe_key(a).alias(f"__k{i}") for i, a in enumerate(attrs)]
    grouped = df.groupBy(*keys).agg(*[F.min(F.col(a)).alias(a) for a in attrs], *aggregates)
    return grouped.drop(*[f"__k{i}" for i in range(len(attrs))])


def validity_join(facts: DataFrame, versions: DataFrame, key: str, at: str,
                  start: str = "start_date", end: str = "end_date",
                  how: str = "inner") -> DataFrame:
    """Join each fact to the version of its key valid at ``at``.

    Equi join on the business key plus a range residual; an open end
    (NULL) means "still valid".  Both sides are split by month as well, so a
    hot key is one task's work for a month, not for all its history.  A
    version stands only in months in which its key has a fact: the facts'
    distinct (key, month) pairs, reduced before their shuffle, ask for them.
    """
    month = F.trunc(F.col(at).cast("date"), "month")
    asked = facts.select(F.col(key).alias("__akey"), month.alias("__vmonth")).filter("__akey IS NOT NULL AND __vmonth IS NOT NULL").distinct()
    v = versions.withColumnRenamed(key, "__vkey")
    covers = (F.col("__vmonth") >= F.trunc(v[start].cast("date"), "month")) & (v[end].isNull() | (F.col("__vmonth") <= v[end].cast("date")))
    v = v.join(asked, (v["__vkey"] == asked["__akey"]) & covers).drop("__akey")
    f = facts.withColumn("__fmonth", month)
    cond = [
        f[key] == v["__vkey"],
        f["__fmonth"] == v["__vmonth"],
        f[at] >= v[start],
        f[at] <= F.coalesce(v[end], F.lit("9999-12-31").cast("date")),
    ]
    return f.join(v, cond, how).drop("__vkey", "__vmonth", "__fmonth")


def top1_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                 payload: Sequence[str], largest: bool = False) -> DataFrame:
    """Best row per key: smallest (or ``largest``) value of the tuple ``order``.

    ``TOP(1) ... ORDER BY`` per key, expressed as ``min_by`` over a struct so
    the work is a partial (map-side) aggregation: a key holding a third of
    all rows is reduced locally before the shuffle instead of being sorted in
    one task.
    """
    ordering = F.struct(*order)
    pick = F.max_by if largest else F.min_by
    best = pick(F.struct(*[F.col(c) for c in payload]), ordering).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in payload])


def lateral_top1(outer: DataFrame, inner: DataFrame, outer_key: str, inner_key: str,
                 order: Sequence[Column], payload: Sequence[str], largest: bool = False) -> DataFrame:
    """``OUTER APPLY (SELECT TOP 1 ... ORDER BY ...)``: left semantics, one row per outer row."""
    best = top1_per_key(inner, [inner_key], order, payload, largest)
    return outer.join(best, outer[outer_key] == best[inner_key], "left").drop(best[inner_key])


def period_start_join(df: DataFrame, dim_date: DataFrame, date_col: str, grain: str = "month",
                      key_name: str = "period_key", calendar: str = "strict") -> DataFrame:
    """Attach the key of the first day of the period *as present in* ``dim_date``.

    ``calendar="strict"`` is what the source warehouse does: a row whose
    month (quarter) has no day-1 date in the date dimension is dropped (inner
    join).  ``calendar="full"`` takes every first day as present and keeps
    all rows with a date; ``dim_date`` isn't read then.  The
    period starts hold at most one row per month of the calendar span, a
    bound independent of the data volume, so they are broadcast.
    """
    d = F.col(date_col)
    if grain not in ("month", "quarter") or calendar not in ("strict", "full"):
        raise ValueError(f"unknown grain {grain!r} or calendar {calendar!r}")
    if calendar == "full":
        return df.filter(d.isNotNull()).withColumn(key_name, date_key(F.trunc(d, grain)))
    if grain == "month":
        starts = dim_date.filter(F.col("day") == 1).select(
            F.col("year").alias("__y"), F.col("month").alias("__p"), F.col("date_key").alias(key_name))
        probe = df.withColumn("__y", F.year(d)).withColumn("__p", F.month(d))
    else:
        starts = dim_date.filter((F.col("day") == 1) & F.col("month").isin(1, 4, 7, 10)).select(
            F.col("year").alias("__y"), F.col("quarter").alias("__p"), F.col("date_key").alias(key_name))
        probe = df.withColumn("__y", F.year(d)).withColumn("__p", F.quarter(d))
    return probe.join(F.broadcast(starts), ["__y", "__p"], "inner").drop("__y", "__p")
