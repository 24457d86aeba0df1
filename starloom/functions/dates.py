"""Date parsing, keys and calendar attributes as native Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.codes import to_nullable_number


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_from_digits(x: str | Column) -> Column:
    """``MMDDYYYY`` digits (leading zero possibly lost) -> DATE, NULL if invalid.

    Left-pads by keeping the *right* eight characters of ``'00000000' || x``
    (``lpad`` would keep the left ones), then parses month/day/year.
    """
    padded = F.right(F.concat(F.lit("00000000"), _c(x).cast("string")), F.lit(8))
    return F.try_to_date(padded, "MMddyyyy")


# ---------------------------------------------------------------------------
# Spellings of dates, tried in this order after ISO text.
# ---------------------------------------------------------------------------
DATE_SPELLINGS = ["yyyyMMdd", "yyyy/M/d", "M/d/yyyy", "M-d-yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "d MMMM yyyy"]
# ---------------------------------------------------------------------------


def to_nullable_date(x: str | Column, spellings: Sequence[str] = DATE_SPELLINGS) -> Column:
    """Lenient parse of date text: ISO (a time behind it is cut off), then each spelling in order, else NULL.

    Blanks around the text don't count; digits separated by slashes or
    dashes begin with the month; a date that doesn't exist (February 30th)
    is NULL.  Only ``x`` of the text type is parsed; dates and timestamps
    are cast.
    """
    text = F.trim(_c(x).cast("string"))
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"), F.substring_index(F.substring_index(text, " ", 1), "T", 1).try_cast("date"))
    return F.coalesce(iso, *[F.try_to_date(text, s) for s in spellings])


def date_from_parts(year: str | Column, month: str | Column,
                    existing: str | Column | None = None) -> Column:
    """First day of ``year``/``month``; an existing date wins.

    Year and month are coerced from text (``'2024.0'`` is 2024); month 13 or
    fractional parts give NULL instead of failing.
    """
    y = to_nullable_number(year)
    m = to_nullable_number(month)
    ok = (y == F.floor(y)) & (m == F.floor(m))
    built = F.when(ok, F.try_to_date(
        F.concat_ws("-", y.cast("long").cast("string"), m.cast("long").cast("string"), F.lit("1")),
        "y-M-d"))
    return built if existing is None else F.coalesce(_c(existing).cast("date"), built)


def date_key(d: str | Column) -> Column:
    """Integer ``yyyymmdd`` key."""
    c = _c(d).cast("date")
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def iso_date_text(d: str | Column) -> Column:
    return F.date_format(_c(d).cast("date"), "yyyy-MM-dd")


def date_attributes(d: str | Column) -> list[Column]:
    """Calendar attributes of a date-dimension row."""
    c = _c(d).cast("date")
    return [
        date_key(c).alias("date_key"),
        c.alias("full_date"),
        F.dayofmonth(c).alias("day"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(c).cast("string")).alias("quarter_name"),
        F.year(c).alias("year"),
    ]


def month_number(name: str | Column) -> Column:
    """Calendar position of an English month name (for ORDER BY)."""
    return F.month(F.try_to_date(F.concat(_c(name), F.lit(" 1 2000")), "MMMM d yyyy"))
