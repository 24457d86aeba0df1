"""Column -> Column building blocks (all native Spark expressions)."""

from starloom.functions.codes import band, canonical_code, flag, range_guard, to_nullable_number, try_int
from starloom.functions.dates import (date_attributes, date_from_digits, date_from_parts, date_key,
                                      iso_date_text, month_number, to_nullable_date)
from starloom.functions.fmt import decimal_avg, percent, percent_text, safe_ratio, weighted_avg
from starloom.functions.hashing import row_hash
from starloom.functions.text import (clean_special_text, clean_text, lower_trim, normalize_country,
                                     normalize_days, normalize_text, not_found_default, strip_all, yes_no)

__all__ = [
    "band", "canonical_code", "flag", "range_guard", "to_nullable_number", "try_int",
    "date_attributes", "date_from_digits", "date_from_parts", "date_key", "iso_date_text",
    "month_number", "to_nullable_date",
    "decimal_avg", "percent", "percent_text", "safe_ratio", "weighted_avg",
    "row_hash",
    "clean_special_text", "clean_text", "lower_trim", "normalize_country", "normalize_days",
    "normalize_text", "not_found_default", "strip_all", "yes_no",
]
