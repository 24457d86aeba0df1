"""Report formatting: exact decimal percentages, rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def percent(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """``CAST(num * 100.0 / NULLIF(den, 0) AS DECIMAL(10, scale))`` in exact
    decimal arithmetic (half-up), NULL when ``den`` is 0."""
    n = _c(num).cast("decimal(18,0)") * F.lit(100)
    d = F.nullif(_c(den).cast("decimal(18,0)"), F.lit(0))
    return (n / d).cast(f"decimal(10,{scale})")


def percent_text(num: str | Column, den: str | Column) -> Column:
    """Percentage as text with a trailing ``' %'``; NULL when ``den`` is 0."""
    return F.concat(percent(num, den).cast("string"), F.lit(" %"))


def safe_ratio(num: str | Column, den: str | Column, out: str = "decimal(10,2)") -> Column:
    """``CAST(num / NULLIF(den, 0) AS out)`` in decimal arithmetic."""
    return (_c(num) / F.nullif(_c(den), F.lit(0))).cast(out)


def decimal_avg(x: str | Column, work: str = "decimal(18,4)", out: str = "decimal(18,2)") -> Column:
    """``CAST(AVG(CAST(x AS work)) AS out)``; NULLs skipped, all-NULL -> NULL."""
    return F.avg(_c(x).cast(work)).cast(out)


def weighted_avg(value: str | Column, weight: str | Column, digits: int = 2) -> Column:
    """``ROUND(SUM(value * weight) / NULLIF(SUM(weight), 0), digits)`` as a decimal aggregate."""
    num = F.sum(_c(value).cast("decimal(18,4)") * _c(weight).cast("decimal(18,4)"))
    den = F.nullif(F.sum(_c(weight)).cast("decimal(18,0)"), F.lit(0))
    return F.round(num / den, digits).cast(f"decimal(10,{digits})")
