"""Duplicate removal and hash-based delta loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (``ROW_NUMBER() = 1``).

    Written as ``min_by`` over a struct of the remaining columns so Spark runs
    a partial aggregation before the shuffle: a key holding a third of all
    rows is reduced map-side to one candidate per task, instead of being
    sorted in a single task as a window would.  ``order`` must be total
    (end it with a unique column) for a deterministic survivor.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    best = F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(*order)).alias("__keep")
    return (df.groupBy(*keys).agg(best)
              .select(*keys, *[F.col(f"__keep.{c}").alias(c) for c in rest])
              .select(*df.columns))


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one arbitrary row per key (when any survivor will do)."""
    return df.dropDuplicates(list(keys))


def new_rows(batch: DataFrame, stored: DataFrame, key: str = "row_hash") -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not yet in ``stored`` (``NOT EXISTS``).

    Only the key column of the stored side takes part in the anti join, so
    the shuffle carries 64-character hashes, not whole history rows.
    """
    return batch.join(stored.select(key), on=key, how="left_anti")
