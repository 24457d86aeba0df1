"""Several sources of different layouts, loaded into one table by row hash.

A source's layout says how its columns become the integrated ones, where
its date comes from and which values, in which order, make up its row hash:
sources differ in that (a file without persons hashes none).  A load unites
the sources, keeps one row for each hash, leaves out hashes that the table
already has, stamps what is new and appends it, or in full mode replaces the
table.  Loading the same rows again adds none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from starloom.functions.hashing import row_hash
from starloom.operators import dedup
from starloom.sources.versions import VersionedTable

ROW_HASH = "row_hash"
LOADED_AT = "load_timestamp"


@dataclass(frozen=True)
class Layout:
    """How one source becomes integrated rows.

    ``columns``: expressions over the source by target column; others get
    ``default`` if they are text, else NULL.  ``hash_slots``: target columns
    or expressions over them, in the order in which they are hashed after
    the system's name.  A NULL slot counts as empty text.
    """

    system: str
    columns: Mapping[str, Column] = field(default_factory=dict)
    hash_slots: Sequence[str | Column] = ()
    default: str | None = None


@dataclass(frozen=True)
class Loaded:
    """What a load did: integrated rows, distinct ones among them, and those that were new."""

    candidates: int
    distinct: int
    inserted: int


Target = Sequence[tuple[str, DataType | str]]


def _type(t: DataType | str) -> str:
    return t.simpleString() if isinstance(t, DataType) else t


def conform_layout(df: DataFrame, layout: Layout, target: Target) -> DataFrame:
    """One source's integrated rows with their ``row_hash``, from a projection of its own; the first target column is the system's name."""
    columns = []
    for i, (name, t) in enumerate(target):
        value = F.lit(layout.system) if i == 0 else layout.columns.get(name, F.lit(layout.default if _type(t) == "string" else None))
        columns.append(value.cast(_type(t)).alias(name))
    return df.select(*columns).withColumn(ROW_HASH, row_hash([F.lit(layout.system), *layout.hash_slots]))


def candidates(sources: Sequence[tuple[DataFrame, Layout]], target: Target) -> DataFrame:
    """All sources' integrated rows, repeats included (a map-only union)."""
    out, *more = [conform_layout(df, layout, target) for df, layout in sources]
    for df in more:
        out = out.unionByName(df)
    return out


def integrate_load(table: VersionedTable, sources: Sequence[tuple[DataFrame, Layout]], target: Target, mode: str = "delta",
                   order: Sequence[str] = (), stamps: Mapping[str, Column] | None = None) -> Loaded:
    """Load the sources into ``table``.

    ``delta`` adds the hashes that the table lacks; ``full`` replaces it.
    Of rows with one hash the first by ``order``, then by all columns, stays.
    New rows get ``load_timestamp`` (the time of the load) and ``stamps``.
    Counts are observed while the rows are written, without further scans.

    The delta is an anti join on hashes alone; a load copies no row of the
    stored history.
    """
    if mode not in ("delta", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    seen, first, new = Observation("candidates"), Observation("distinct"), Observation("inserted")
    rows = candidates(sources, target).observe(seen, F.count(F.lit(1)).alias("n"))
    names = [name for name, _ in target]
    unique = dedup.keep_first(rows, [ROW_HASH], [F.col(c) for c in dict.fromkeys([*order, *names])]).observe(first, F.count(F.lit(1)).alias("n"))
    stored = table.read() if mode == "delta" and table.exists() else None
    fresh = unique if stored is None else dedup.new_rows(unique, stored, ROW_HASH)
    stamped = fresh.select(*names, ROW_HASH, F.current_timestamp().alias(LOADED_AT), *[c.alias(k) for k, c in (stamps or {}).items()])
    stamped = stamped.observe(new, F.count(F.lit(1)).alias("n"))
    if stored is None:
        table.swap(stamped)
    else:
        table.append(stamped)
    return Loaded(seen.get["n"], first.get["n"], new.get["n"])
