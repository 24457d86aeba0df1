"""Slowly changing dimensions (types 2 and 3), first-seen combination
dimensions and latest-row-per-key lookups, all set-based.

Windows are only ever evaluated per business key, and only after the input
has been reduced to distinct states per key and day (a partial
aggregation), so a key holding a third of all raw rows contributes at most
one row per day and distinct state to the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.joins import distinct_combinations, nullsafe_key, top1_per_key


def last_state_per_day(df: DataFrame, key: str, ts: str, tiebreak: str,
                       state_cols: Sequence[str], day_col: str = "state_date") -> DataFrame:
    """State of each key at the end of each day: the attributes of its last
    row that day (by ``ts``, then ``tiebreak``).  Partial aggregation."""
    last = F.max_by(F.struct(*[F.col(c) for c in state_cols]), F.struct(F.col(ts), F.col(tiebreak)))
    return (df.groupBy(key, F.to_date(F.col(ts)).alias(day_col)).agg(last.alias("__s"))
              .select(key, day_col, *[F.col(f"__s.{c}").alias(c) for c in state_cols]))


def scd2_versions(states: DataFrame, key: str, date_col: str, attrs: Sequence[str],
                  start: str = "start_date", end: str = "end_date", current: str = "is_current",
                  version: str = "version_no") -> DataFrame:
    """Type-2 history from dated states (gaps and islands).

    A new version starts whenever the attribute tuple differs from the
    previous state of the key; it ends the day before the next version
    starts; the last version is open (NULL end) and current.  Same-day rows
    are ordered by the attributes, so the result is deterministic.  NULL and
    the empty text count as the same attribute value.
    """
    s = states.select(key, date_col, *attrs).distinct()
    w = Window.partitionBy(key).orderBy(F.col(date_col), *[F.col(a) for a in attrs])
    tup = F.struct(*[F.coalesce(F.col(a).cast("string"), F.lit("")).alias(a) for a in attrs])
    marked = s.withColumn("__prev", F.lag(tup).over(w))
    changes = marked.filter(F.col("__prev").isNull() | ~F.col("__prev").eqNullSafe(tup)).drop("__prev")
    wv = Window.partitionBy(key).orderBy(F.col(date_col), *[F.col(a) for a in attrs])
    nxt = F.lead(F.col(date_col)).over(wv)
    return changes.select(
        key, *attrs,
        F.col(date_col).cast("date").alias(start),
        F.date_sub(nxt.cast("date"), 1).alias(end),
        nxt.isNull().alias(current),
        F.row_number().over(wv).cast("int").alias(version),
    )


def scd2_merge(dim: DataFrame, batch_states: DataFrame, key: str, date_col: str,
               attrs: Sequence[str], start: str = "start_date", end: str = "end_date",
               current: str = "is_current", version: str = "version_no") -> DataFrame:
    """Apply a batch of dated states to an existing type-2 dimension.

    New keys get their versions; for known keys, states not newer than the
    current version's start are ignored (re-running a batch is a no-op;
    ``late_states`` gives those that the history doesn't hold),
    changed states close the current version (end = new start - 1) and open
    new ones; unchanged states add nothing; states without a key are left
    out.  Returns the full new dimension
    (write it to a new path, never over the one being read).
    """
    cur = dim.filter(F.col(current)).select(key, F.col(start).alias("__cur_start"))
    fresh = (batch_states.filter(F.col(key).isNotNull()).join(cur, key, "left")
             .filter(F.col("__cur_start").isNull() | (F.col(date_col) > F.col("__cur_start")))
             .select(key, date_col, *attrs))
    touched = fresh.select(key).distinct()
    # history of untouched keys is carried over as is
    keep = dim.join(touched, key, "left_anti")
    # closed history of touched keys is unchanged; their current row is replayed
    closed = dim.join(touched, key, "left_semi").filter(~F.col(current))
    replay = (dim.join(touched, key, "left_semi").filter(F.col(current))
              .select(key, F.col(start).alias(date_col), *attrs))
    rebuilt = scd2_versions(replay.unionByName(fresh), key, date_col, attrs, start, end, current, version)
    offset = closed.groupBy(key).agg(F.count(F.lit(1)).alias("__nclosed"))
    rebuilt = (rebuilt.join(offset, key, "left")
               .withColumn(version, (F.col(version) + F.coalesce(F.col("__nclosed"), F.lit(0))).cast("int"))
               .drop("__nclosed"))
    return keep.unionByName(closed).unionByName(rebuilt.select(*dim.columns))


def late_states(dim: DataFrame, batch_states: DataFrame, key: str, date_col: str, attrs: Sequence[str],
                start: str = "start_date", end: str = "end_date", current: str = "is_current") -> DataFrame:
    """The states that ``scd2_merge`` passes over and that the stored history contradicts.

    A state that isn't newer than its key's current version and whose
    attributes differ from those of the version valid on its day, or that
    lies before the first version.  A batch that was applied before gives
    none.  NULL and the empty text are one value.
    """
    cur = dim.filter(F.col(current)).select(F.col(key).alias("__ckey"), F.col(start).alias("__cur_start"))
    old = (batch_states.join(cur, (F.col(key) == F.col("__ckey")) & (F.col(date_col).cast("date") <= F.col("__cur_start")))
           .select(key, date_col, *attrs).distinct())
    held = dim.select(F.col(key).alias("__vkey"), F.col(start).alias("__from"), F.col(end).alias("__to"),
                      *[nullsafe_key(a).alias(f"__v{i}") for i, a in enumerate(attrs)])
    agrees = ((F.col(key) == F.col("__vkey")) & (F.col(date_col).cast("date") >= F.col("__from"))
              & (F.col("__to").isNull() | (F.col(date_col).cast("date") <= F.col("__to"))))
    for i, a in enumerate(attrs):
        agrees = agrees & (nullsafe_key(a) == F.col(f"__v{i}"))
    return old.join(held, agrees, "left_anti")


def lag_within_key(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                   suffix: str = "_past", bucket: Column | None = None,
                   anonymous: object = None) -> DataFrame:
    """Previous value of ``cols`` per ``key`` in ``order`` (``LAG`` x n).

    Rows with a NULL key carry no history: their past values are the
    literal ``anonymous`` (they never form one giant window partition).

    With ``bucket`` (e.g. the month of the order column) the window runs
    per (key, bucket), so a hot key is spread over many tasks; the first row
    of each bucket takes the last row of the key's previous non-empty
    bucket, found from a one-row-per-bucket summary.
    """
    known = df.filter(F.col(key).isNotNull())
    anon = df.filter(F.col(key).isNull()).select(
        "*", *[F.lit(anonymous).cast(known.schema[c].dataType).alias(c + suffix) for c in cols])
    ordering = [F.col(o) for o in order]
    vals = F.struct(*[F.col(c) for c in cols])
    if bucket is None:
        w = Window.partitionBy(key).orderBy(*ordering)
        prev = F.lag(vals).over(w)
        out = known.select("*", *[prev[c].alias(c + suffix) for c in cols])
        return out.unionByName(anon)
    b = known.withColumn("__b", bucket)
    w = Window.partitionBy(key, "__b").orderBy(*ordering)
    inner = b.withColumn("__prev", F.lag(vals).over(w)).withColumn("__first", F.row_number().over(w) == 1)
    # last row of every (key, bucket): partial aggregation, one row per bucket
    last = b.groupBy(key, "__b").agg(F.max_by(vals, F.struct(*ordering)).alias("__last"))
    wb = Window.partitionBy(key).orderBy("__b")
    carry = last.select(key, "__b", F.lag("__last").over(wb).alias("__carry"))
    joined = inner.join(carry, [key, "__b"], "left")
    prev = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
    out = joined.select(*known.columns, *[prev[c].alias(c + suffix) for c in cols])
    return out.unionByName(anon)


def first_seen_combinations(df: DataFrame, attrs: Sequence[str], date_col: str,
                            first: str = "first_seen", null_date: str = "1900-01-01") -> DataFrame:
    """Distinct attribute combinations with the date each was first seen
    (a missing date counts as ``null_date``).  Partial aggregation.

    NULL and the empty text are one value, as ``nullsafe_join`` has it, so a
    fact finds one row for its combination; the row holds the empty text if
    it occurs, else NULL."""
    d = F.coalesce(F.col(date_col).cast("date"), F.lit(null_date).cast("date"))
    return distinct_combinations(df, attrs, [F.min(d).alias(first)])


def latest_per_key(df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order`` (``TOP 1 ... ORDER BY order DESC``),
    as a partial aggregation (``max_by``)."""
    return top1_per_key(df, [key], [F.col(o) for o in order], payload, largest=True)
