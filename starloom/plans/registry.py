"""Catalogue of named queries and their independent SQL oracles.

Each plan is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators.  The oracle, when given, is ANSI SQL over the same
Parquet tables that an independent engine can run to check the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Plan], Plan]:
    def deco(fn: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- SQL helpers for oracles: exact half-up rounding in integer arithmetic.
# The oracle engine divides decimals in floating point, so shares and
# averages are computed on integers and rounded half-up explicitly.

def sql_pct(num: str, den: str) -> str:
    """Percent text ``'12.50 %'`` of non-negative integers, NULL when den = 0."""
    cents = f"((({num}) * 20000 + ({den})) // (2 * ({den})))"
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE "
            f"CAST(CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS VARCHAR) || ' %' END")


def sql_pct_dec(num: str, den: str) -> str:
    """Percent as DECIMAL(10,2) of non-negative integers, NULL when den = 0."""
    cents = f"((({num}) * 20000 + ({den})) // (2 * ({den})))"
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) END"


def sql_div_round(num_units: str, den: str, scale_out: int, type_out: str) -> str:
    """``num_units / den`` rounded half-up to ``scale_out`` decimals, where
    ``num_units`` is an integer already expressed in units of 10**-scale_out."""
    q = (f"(SIGN({num_units}) * ((2 * ABS({num_units}) + ({den})) // (2 * ({den}))))")
    unit = "0." + "0" * (scale_out - 1) + "1" if scale_out > 0 else "1"
    return f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST(CAST({q} AS DECIMAL(38,0)) * {unit} AS {type_out}) END"


def sql_avg_dec(x: str, in_scale: int = 4, out_scale: int = 2, type_out: str = "DECIMAL(18,2)") -> str:
    """``CAST(AVG(CAST(x AS DECIMAL(18,in_scale))) AS type_out)`` computed exactly."""
    units = f"CAST(SUM(CAST({x} AS DECIMAL(18,{in_scale}))) * {10 ** in_scale} AS HUGEINT)"
    return sql_div_round(units, f"(COUNT({x}) * {10 ** (in_scale - out_scale)})", out_scale, type_out)


def sql_normalize(x: str) -> str:
    """Oracle form of ``normalize_text``."""
    s = f"upper(coalesce(CAST({x} AS VARCHAR), ''))"
    s = (f"translate({s}, chr(9) || chr(10) || chr(13) || chr(160) || chr(8217) || '`' || '\".,;:()[]', "
         f"'    ' || '''' || '''')")
    for _ in range(4):
        s = f"replace({s}, '  ', ' ')"
    s = f"trim({s}, ' ')"
    return f"(CASE WHEN {s} = '' THEN 'BLANK' ELSE {s} END)"


def sql_strip(x: str) -> str:
    """Oracle form of ``strip_all`` for ASCII white space and NBSP."""
    return f"regexp_replace(CAST({x} AS VARCHAR), '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"


def sql_clean(x: str) -> str:
    s = sql_strip(x)
    return f"(CASE WHEN {s} IN ('', 'nan', 'NaN', 'None', 'NULL', 'null', 'N/A', 'n/a') THEN NULL ELSE {s} END)"
