"""Numeric codes, guards and bands as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Age bands of the workplace source (inclusive bounds).
# ---------------------------------------------------------------------------
AGE_BANDS = [
    ("18-24", 18, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
    ("65+", 65, None),
]
# ---------------------------------------------------------------------------

# Text the host dialect accepts as a float: optional sign, digits with an
# optional fraction (or a bare fraction), optional exponent, blanks around.
# Spark's own cast also takes 'NaN', 'Infinity' and suffixes such as '1d',
# which the host rejects, so the text is checked first.
_FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_int(x: str | Column) -> Column:
    """``TRY_CONVERT(INT, text)``: integer text only ('32.0' -> NULL)."""
    return F.trim(_c(x).cast("string")).try_cast("int")


def to_nullable_number(x: str | Column) -> Column:
    """Loader-style numeric coercion: bad text -> NULL, '25.0' -> 25.0."""
    s = _c(x).cast("string")
    return F.when(s.rlike(_FLOAT_TEXT), s.try_cast("double"))


def canonical_code(x: str | Column) -> Column:
    """Canonical numeric code text: ``'25.0' -> '25'``, ``' 6 ' -> '6'``,
    non-numeric -> NULL (``TRY_CAST(TRY_CAST(x AS FLOAT) AS INT)``)."""
    return to_nullable_number(x).try_cast("int").cast("string")


def range_guard(x: str | Column, lo: int, hi: int) -> Column:
    """Keep ``x`` when ``lo <= x <= hi``, else NULL."""
    c = _c(x)
    return F.when(c.between(lo, hi), c)


def band(x: str | Column, bands=AGE_BANDS, default: str = "Not Found") -> Column:
    """Searched CASE over inclusive integer ranges; open upper bound = None."""
    n = try_int(x)
    expr = None
    for label, lo, hi in bands:
        cond = (n >= lo) if hi is None else n.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def flag(cond: Column) -> Column:
    """Indicator ``CASE WHEN cond THEN 1 ELSE 0 END`` (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
