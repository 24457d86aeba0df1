"""Conform sources to one schema and integrate them.

A source is described declaratively (rename map, derived columns, typed
defaults); conforming is a pure projection, so integrating N sources is a
map-only ``unionByName`` with no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _type(t: DataType | str) -> str:
    return t.simpleString() if isinstance(t, DataType) else t


def conform_columns(df: DataFrame, rename: Mapping[str, str],
                    target: StructType | Sequence[tuple[str, DataType | str]]) -> DataFrame:
    """Keep known source columns under their target names, add absent target
    columns as typed NULLs and fix the column order.

    Source columns not in ``rename`` are dropped; ``rename`` entries whose
    source column is absent become NULL (a file missing a column).
    """
    fields = [(f.name, f.dataType) for f in target] if isinstance(target, StructType) else list(target)
    present = {tgt: src for src, tgt in rename.items() if src in df.columns}
    cols = []
    for name, t in fields:
        src = present.get(name)
        expr = F.col(src) if src is not None else F.lit(None)
        cols.append(expr.cast(_type(t)).alias(name))
    return df.select(*cols)


def add_column_if_absent(df: DataFrame, name: str, t: DataType | str,
                         default: object = None) -> DataFrame:
    """Schema evolution: add ``name`` (typed, default value) when missing."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(_type(t)))


@dataclass
class SourceSpec:
    """How one source maps onto the integrated schema.

    ``columns`` maps target column -> expression over the source; targets
    not listed get ``defaults[target]`` (a literal) or NULL.
    """

    system: str
    columns: Mapping[str, Column] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    system_column: str = "source_system"


def conform_source(df: DataFrame, spec: SourceSpec,
                   target: Sequence[tuple[str, DataType | str]]) -> DataFrame:
    cols = []
    for name, t in target:
        if name == spec.system_column:
            expr = F.lit(spec.system)
        elif name in spec.columns:
            expr = spec.columns[name]
        else:
            expr = F.lit(spec.defaults.get(name))
        cols.append(expr.cast(_type(t)).alias(name))
    return df.select(*cols)


def integrate(sources: Sequence[tuple[DataFrame, SourceSpec]],
              target: Sequence[tuple[str, DataType | str]]) -> DataFrame:
    """Conform every source and append them into one relation (map-only)."""
    frames = [conform_source(df, spec, target) for df, spec in sources]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
