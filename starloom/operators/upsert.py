"""Insert-if-new loads of combination dimensions (types 0 and 3).

The stored dimension keeps its rows and ids; combinations that it lacks get
the next ids.  NULL and the empty text are the same value in a combination.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import distinct_combinations, nullsafe_key
from starloom.operators.keys import dense_ids, next_start


def combo_upsert(stored: DataFrame, batch: DataFrame, attrs: Sequence[str], id_col: str,
                 order: Sequence[str] | None = None) -> DataFrame:
    """``stored`` and, numbered on from its largest id, the rows of ``batch`` whose combination of
    ``attrs`` it lacks.  A combination that ``batch`` holds several times, NULL and the empty text
    being equal, is added once, with the smallest value of its other columns; new ids follow ``order``
    (default: the attributes).  A batch that is loaded twice adds nothing."""
    names = [f"__k{i}" for i in range(len(attrs))]
    batch = distinct_combinations(batch, attrs, [F.min(c).alias(c) for c in batch.columns if c not in attrs])
    known = stored.select(*[nullsafe_key(a).alias(n) for a, n in zip(attrs, names)])
    new = batch.select("*", *[nullsafe_key(a).alias(n) for a, n in zip(attrs, names)]).join(known, names, "left_anti").drop(*names)
    numbered = dense_ids(new, list(order or attrs), id_col, start=next_start(stored, id_col))
    return stored.unionByName(numbered.select(*stored.columns))
