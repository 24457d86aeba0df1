"""Lookup masters, raw->standard maps and value resolution.

Maps are built from seed relations (fixed literal rows, so their size is a
constant of the program) by normalising the raw side, removing duplicates
and attaching the master's id.  Resolution is a chain of broadcast left
joins: canonical numeric code -> label, then normalised text -> label,
then a fallback (raw text or ``'Not Found'``).  Each raw column is
normalised once per side; map and master are collapsed into one relation
before joining, halving the join count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.codes import canonical_code
from starloom.functions.text import NOT_FOUND, normalize_text


class DuplicateMapKey(ValueError):
    pass


def seed_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Relation of fixed literal rows (``VALUES (...) v(a, b)``)."""
    return spark.createDataFrame(list(rows), schema)


def build_map(seed: DataFrame, raw_col: str, final_col: str, master: DataFrame,
              master_value: str, master_id: str | None = None,
              normalizer: Callable[[Column], Column] = normalize_text,
              key_name: str = "raw_key") -> DataFrame:
    """Normalise the raw seed values, drop duplicates and attach the
    master row (inner join on the standard value, as the source does)."""
    norm = seed.select(normalizer(F.col(raw_col)).alias(key_name), F.col(final_col).alias("__final")).distinct()
    cols = [F.col(key_name), F.col(master_value).alias("label")]
    if master_id:
        cols.insert(1, F.col(master_id))
    return norm.join(master, norm["__final"] == master[master_value], "inner").select(*cols)


def assert_unique(map_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail when a normalised key maps to more than one row (fan-out guard).
    Runs on the map only (seed-sized), before it is joined to data."""
    dup = map_df.groupBy(*keys).count().filter(F.col("count") > 1).limit(5).collect()
    if dup:
        raise DuplicateMapKey(f"duplicate map keys {[tuple(r)[:-1] for r in dup]}")
    return map_df


@dataclass
class Resolution:
    """How one attribute is resolved.

    ``code_labels``: (code, label) seed matched on the canonical numeric code
    of the raw value.  ``text_map``: (raw_key, label) matched on the
    normalised raw text.  ``fallback_raw``: keep the trimmed raw text when
    neither matches (else ``'Not Found'``).
    """

    column: str
    out: str
    code_labels: DataFrame | None = None
    text_map: DataFrame | None = None
    fallback_raw: bool = False
    normalizer: Callable[[Column], Column] = normalize_text


def resolve(df: DataFrame, specs: Sequence[Resolution]) -> DataFrame:
    """Resolve every attribute: code label, else map label, else fallback.

    No side is hinted: literal seeds have exact statistics, so the planner
    broadcasts them below its byte threshold, and larger maps are shuffled.
    """
    out = df
    for i, sp in enumerate(specs):
        raw = F.col(sp.column)
        parts, tmp = [], []
        if sp.code_labels is not None:
            ck, cl = f"__code{i}", f"__clabel{i}"
            labels = sp.code_labels.select(F.col("code").alias(ck), F.col("label").alias(cl))
            out = out.withColumn(ck, canonical_code(raw)).join(labels, ck, "left")
            parts.append(F.col(cl))
            tmp += [ck, cl]
        if sp.text_map is not None:
            nk, ml = f"__norm{i}", f"__mlabel{i}"
            labels = sp.text_map.select(F.col("raw_key").alias(nk), F.col("label").alias(ml))
            out = out.withColumn(nk, sp.normalizer(raw)).join(labels, nk, "left")
            parts.append(F.col(ml))
            tmp += [nk, ml]
        if sp.fallback_raw:
            parts.append(F.nullif(F.trim(raw.cast("string")), F.lit("")))
        parts.append(F.lit(NOT_FOUND))
        out = out.withColumn(sp.out, F.coalesce(*parts))
        out = out.drop(*tmp)
    return out
