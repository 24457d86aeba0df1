"""Text cleaning and normalisation as native Column expressions.

All functions map ``Column -> Column`` and stay inside whole-stage codegen
(no Python UDF).  They reproduce the value semantics of the source
warehouse's normalisers and loader helpers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source warehouse's lists for equal results)
# ---------------------------------------------------------------------------
# Loader sentinels that become NULL after stripping (case-sensitive).
NULL_SENTINELS = ["", "nan", "NaN", "None", "NULL", "null", "N/A", "n/a"]
# Yes/No normaliser: lower-cased, stripped input -> standard value.
YES_NO_MAP = {
    "yes": "Yes",
    "y": "Yes",
    "true": "Yes",
    "1": "Yes",
    "no": "No",
    "n": "No",
    "false": "No",
    "0": "No",
    "don't know": "Don't know",
    "dont know": "Don't know",
    "maybe": "Maybe",
}
# Country synonym folding applied after normalise_text.
COUNTRY_US_SYNONYMS = ["US", "USA", "U S A", "UNITED STATES OF AMERICA", "U S", "AMERICA"]
COUNTRY_UK_SYNONYMS = ["UK", "U K", "BRITAIN", "GREAT BRITAIN", "ENGLAND"]
# Mental-health-days normaliser.
DAYS_ZERO_WORDS = ["NONE", "NO DAYS"]
DAYS_KEPT_CODES = ["77", "88", "99", "BLANK", "NOT FOUND"]
# normalise_text: TAB, LF, CR and NBSP become a blank; right single quote
# and back-tick become an apostrophe; these characters are deleted.
_SPACE_CHARS = "\t\n\r\u00a0"
_QUOTE_CHARS = "\u2019`"
_DROP_CHARS = "\".,;:()[]"
NOT_FOUND = "Not Found"
BLANK = "BLANK"
# ---------------------------------------------------------------------------

_TRANSLATE_FROM = _SPACE_CHARS + _QUOTE_CHARS + _DROP_CHARS
_TRANSLATE_TO = " " * len(_SPACE_CHARS) + "'" * len(_QUOTE_CHARS)

# Python's str.strip() whitespace: Unicode White_Space plus the ASCII
# information separators.
_WS = r"[\s\x1c-\x1f]"
_STRIP_RE = rf"(?U)^{_WS}+|{_WS}+$"


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lower_trim(x: str | Column) -> Column:
    """First-generation lookup normaliser: ``lower(trim(x))`` (blanks only)."""
    return F.lower(F.trim(_c(x)))


def normalize_text(x: str | Column) -> Column:
    """Upper-case, unify hidden characters and quotes, drop punctuation,
    collapse runs of blanks, trim, and map an empty result to ``'BLANK'``.

    Blank collapsing is four passes of ``'  ' -> ' '`` (runs of up to 16
    blanks become one), exactly as the source normaliser does it.
    """
    s = folded_text(x)
    return F.when(s == "", F.lit(BLANK)).otherwise(s)


def folded_text(x: str | Column) -> Column:
    """``normalize_text`` with an empty result left empty."""
    s = F.upper(F.coalesce(_c(x).cast("string"), F.lit("")))
    s = F.translate(s, _TRANSLATE_FROM, _TRANSLATE_TO)
    for _ in range(4):
        s = F.replace(s, F.lit("  "), F.lit(" "))
    return F.trim(s)


def normalized(text: str | None) -> str:
    """``normalize_text`` of a constant, for seeds that become part of a plan."""
    s = (text or "").upper().translate(str.maketrans(_TRANSLATE_FROM[:len(_TRANSLATE_TO)], _TRANSLATE_TO, _DROP_CHARS))
    for _ in range(4):
        s = s.replace("  ", " ")
    return s.strip(" ") or BLANK


def normalized_country(text: str | None) -> str:
    """``normalize_country`` of a constant."""
    s = normalized(text)
    return "UNITED STATES" if s in COUNTRY_US_SYNONYMS else "UNITED KINGDOM" if s in COUNTRY_UK_SYNONYMS else s


def normalize_country(x: str | Column) -> Column:
    """normalize_text plus folding of US / UK synonyms."""
    s = normalize_text(x)
    return (F.when(s.isin(COUNTRY_US_SYNONYMS), F.lit("UNITED STATES"))
            .when(s.isin(COUNTRY_UK_SYNONYMS), F.lit("UNITED KINGDOM"))
            .otherwise(s))


def normalize_days(x: str | Column) -> Column:
    """Day-count text: NONE/NO DAYS -> '0'; integers 0..30 kept (canonical
    text); 77/88/99/BLANK/NOT FOUND kept; anything else 'NOT FOUND'."""
    s = normalize_text(x)
    n = s.try_cast("int")
    return (F.when(s.isin(DAYS_ZERO_WORDS), F.lit("0"))
            .when(n.between(0, 30), n.cast("string"))
            .when(s.isin(DAYS_KEPT_CODES), s)
            .otherwise(F.lit("NOT FOUND")))


def strip_all(x: str | Column) -> Column:
    """Python-style ``strip()``: removes all leading/trailing white space."""
    return F.regexp_replace(_c(x).cast("string"), _STRIP_RE, "")


def null_sentinels(x: Column) -> Column:
    return F.when(x.isin(NULL_SENTINELS), F.lit(None).cast("string")).otherwise(x)


def clean_text(x: str | Column) -> Column:
    """Strip white space, then turn blank and NaN-like sentinels into NULL."""
    return null_sentinels(strip_all(x))


def clean_special_text(x: str | Column) -> Column:
    """Remove a ``b'...'`` bytes-literal wrapper (every ``b'`` and every
    apostrophe), strip, then null the sentinels."""
    s = F.replace(F.replace(_c(x).cast("string"), F.lit("b'"), F.lit("")), F.lit("'"), F.lit(""))
    return null_sentinels(strip_all(s))


def yes_no(x: str | Column) -> Column:
    """Yes/No normaliser; unmatched values pass through (already cleaned)."""
    cleaned = clean_text(x)
    mapping = F.create_map(*[F.lit(v) for kv in YES_NO_MAP.items() for v in kv])
    return F.coalesce(F.try_element_at(mapping, F.lower(strip_all(cleaned))), cleaned)


def not_found_default(x: str | Column) -> Column:
    """Integrated-layer default: ``COALESCE(NULLIF(TRIM(x), ''), 'Not Found')``."""
    t = F.trim(_c(x).cast("string"))
    return F.coalesce(F.nullif(t, F.lit("")), F.lit(NOT_FOUND))
