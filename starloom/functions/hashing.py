"""Row fingerprints for duplicate removal and delta loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def row_hash(parts: Sequence[str | Column], sep: str = "|") -> Column:
    """SHA-256 (hex) of the parts joined by ``sep``; a NULL part counts as ''.

    Every slot is kept (``concat_ws`` would skip NULL slots and let two
    different rows collide), matching ``HASHBYTES('SHA2_256', CONCAT(...))``.
    """
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(F.coalesce(_c(p).cast("string"), F.lit("")))
    return F.sha2(F.concat(*pieces), 256)
