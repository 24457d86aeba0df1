"""Scalar functions (cleaning, normalising, codes, dates, percent text,
row hash) applied to text derived from the driver tables.

The noisy input column of each query is a stand-in for raw file values: it
is written once as SQL text that both Spark and the oracle engine accept,
and only feeds the function under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import (canonical_code, clean_special_text, clean_text, date_from_digits,
                                date_from_parts, normalize_country, normalize_days, normalize_text,
                                percent_text, row_hash, yes_no)
from starloom.plans.registry import register, sql_clean, sql_normalize, sql_pct, sql_strip
from starloom.sources.tables import read_table

NBSP = "\u00a0"
RSQUO = "\u2019"

NOISY_SEGMENT = f"""CASE c_custkey % 8
  WHEN 0 THEN lower(c_mktsegment)
  WHEN 1 THEN '  ' || c_mktsegment || '.'
  WHEN 2 THEN c_mktsegment || chr(9) || 'x'
  WHEN 3 THEN '"' || c_mktsegment || '"' || '{NBSP}'
  WHEN 4 THEN c_mktsegment || '                  ,  (' || c_name || ')'
  WHEN 5 THEN ''
  WHEN 6 THEN NULL
  ELSE 'O{RSQUO}Brien`s [' || c_mktsegment || ']; co:' END"""


# General lookup normaliser.
@register("normalize_text", oracle=f"""
SELECT c_custkey, noisy_text, {sql_normalize('noisy_text')} AS norm_text
FROM (SELECT c_custkey, {NOISY_SEGMENT} AS noisy_text FROM customer)
""")
def normalize_text_q(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment", "c_name")
    t = c.select("c_custkey", F.expr(NOISY_SEGMENT).alias("noisy_text"))
    return t.select("c_custkey", "noisy_text", normalize_text("noisy_text").alias("norm_text"))


COUNTRY_SPELLINGS = ["US", "u.s.a.", "U S", "United States of America", "America", "England",
                     " great britain ", "UK", "Canada", "Germany", "", None]
_SPELL_SQL = "[" + ", ".join("NULL" if s is None else f"'{s}'" for s in COUNTRY_SPELLINGS) + "]"
_SPELL_SPARK = "array(" + ", ".join("CAST(NULL AS STRING)" if s is None else f"'{s}'"
                                    for s in COUNTRY_SPELLINGS) + ")"


# Country synonym folding.
@register("country_fold", oracle=f"""
WITH t AS (SELECT c_custkey, {_SPELL_SQL}[c_custkey % {len(COUNTRY_SPELLINGS)} + 1] AS raw_country FROM customer),
n AS (SELECT c_custkey, raw_country, {sql_normalize('raw_country')} AS s FROM t)
SELECT c_custkey, raw_country,
       CASE WHEN s IN ('US', 'USA', 'U S A', 'UNITED STATES OF AMERICA', 'U S', 'AMERICA') THEN 'UNITED STATES'
            WHEN s IN ('UK', 'U K', 'BRITAIN', 'GREAT BRITAIN', 'ENGLAND') THEN 'UNITED KINGDOM'
            ELSE s END AS country_key
FROM n
""")
def country_fold(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey")
    t = c.select("c_custkey", F.expr(f"element_at({_SPELL_SPARK}, "
                                     f"CAST(c_custkey % {len(COUNTRY_SPELLINGS)} + 1 AS INT))").alias("raw_country"))
    return t.select("c_custkey", "raw_country", normalize_country("raw_country").alias("country_key"))


DAYS_TEXT = """CASE p_partkey % 7
  WHEN 0 THEN 'none'
  WHEN 1 THEN ' No Days '
  WHEN 2 THEN CAST(p_size AS STRING)
  WHEN 3 THEN CAST(p_size + 50 AS STRING)
  WHEN 4 THEN CAST(p_size AS STRING) || '.0'
  WHEN 5 THEN ''
  ELSE 'n/a' END"""


# Day-count normaliser.
@register("days_normalize", oracle=f"""
WITH t AS (SELECT p_partkey, {DAYS_TEXT.replace('STRING', 'VARCHAR')} AS days_text FROM part),
n AS (SELECT p_partkey, days_text, {sql_normalize('days_text')} AS s FROM t),
c AS (SELECT *, CASE WHEN regexp_full_match(s, '[+-]?[0-9]+') THEN TRY_CAST(s AS INTEGER) END AS v FROM n)
SELECT p_partkey, days_text,
       CASE WHEN s IN ('NONE', 'NO DAYS') THEN '0'
            WHEN v BETWEEN 0 AND 30 THEN CAST(v AS VARCHAR)
            WHEN s IN ('77', '88', '99', 'BLANK', 'NOT FOUND') THEN s
            ELSE 'NOT FOUND' END AS days_norm
FROM c
""")
def days_normalize(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    t = p.select("p_partkey", F.expr(DAYS_TEXT).alias("days_text"))
    return t.select("p_partkey", "days_text", normalize_days("days_text").alias("days_norm"))


RAW_NAME = f"""CASE c_custkey % 7
  WHEN 0 THEN '  ' || c_name || chr(9)
  WHEN 1 THEN 'nan'
  WHEN 2 THEN ' N/A '
  WHEN 3 THEN 'b''' || c_name || ''''
  WHEN 4 THEN '   '
  WHEN 5 THEN c_name || '{NBSP}' || chr(10)
  ELSE c_name END"""


# Loader cleaning (strip, sentinels, bytes wrapper).
@register("clean_text", oracle=f"""
WITH t AS (SELECT c_custkey, {RAW_NAME} AS raw_text FROM customer)
SELECT c_custkey, raw_text, {sql_clean('raw_text')} AS cleaned,
       {sql_clean("replace(replace(raw_text, 'b''', ''), '''', '')")} AS cleaned_special
FROM t
""")
def clean_text_q(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name")
    t = c.select("c_custkey", F.expr(RAW_NAME).alias("raw_text"))
    return t.select("c_custkey", "raw_text", clean_text("raw_text").alias("cleaned"),
                    clean_special_text("raw_text").alias("cleaned_special"))


ANSWERS = ["Yes", " y ", "TRUE", "1", "no", "N", "false", "Don't know", "dont know", "maybe",
           "whatever", "null", "  "]
_ANS_SQL = "[" + ", ".join("'" + a.replace("'", "''") + "'" for a in ANSWERS) + "]"
_ANS_SPARK = "array(" + ", ".join("'" + a.replace("'", "\\'") + "'" for a in ANSWERS) + ")"


# Yes/No normaliser.
@register("yes_no_map", oracle=f"""
WITH t AS (SELECT event_id, {_ANS_SQL}[event_id % {len(ANSWERS)} + 1] AS raw_answer FROM events),
c AS (SELECT event_id, raw_answer, {sql_clean('raw_answer')} AS v FROM t)
SELECT event_id, raw_answer,
       CASE lower({sql_strip('v')})
            WHEN 'yes' THEN 'Yes' WHEN 'y' THEN 'Yes' WHEN 'true' THEN 'Yes' WHEN '1' THEN 'Yes'
            WHEN 'no' THEN 'No' WHEN 'n' THEN 'No' WHEN 'false' THEN 'No' WHEN '0' THEN 'No'
            WHEN 'don''t know' THEN 'Don''t know' WHEN 'dont know' THEN 'Don''t know'
            WHEN 'maybe' THEN 'Maybe' ELSE v END AS answer
FROM c
""")
def yes_no_map(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id")
    t = ev.select("event_id", F.expr(f"element_at({_ANS_SPARK}, CAST(event_id % {len(ANSWERS)} + 1 AS INT))")
                  .alias("raw_answer"))
    return t.select("event_id", "raw_answer", yes_no("raw_answer").alias("answer"))


RAW_CODE = """CASE p_partkey % 6
  WHEN 0 THEN CAST(p_size AS STRING) || '.0'
  WHEN 1 THEN ' ' || CAST(p_size AS STRING) || ' '
  WHEN 2 THEN CAST(p_size AS STRING) || '.7'
  WHEN 3 THEN 'x' || CAST(p_size AS STRING)
  WHEN 4 THEN 'nan'
  ELSE CAST(p_size AS STRING) END"""

_FLOAT_RE = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*"


def sql_canonical(x: str) -> str:
    return (f"(CASE WHEN regexp_full_match({x}, '{_FLOAT_RE}') "
            f"THEN CAST(TRY_CAST(trunc(TRY_CAST(trim({x}) AS DOUBLE)) AS INTEGER) AS VARCHAR) END)")


# Canonical numeric code text.
@register("canonical_code", oracle=f"""
WITH t AS (SELECT p_partkey, {RAW_CODE.replace('STRING', 'VARCHAR')} AS raw_code FROM part)
SELECT p_partkey, raw_code, {sql_canonical('raw_code')} AS code FROM t
""")
def canonical_code_q(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_size")
    t = p.select("p_partkey", F.expr(RAW_CODE).alias("raw_code"))
    return t.select("p_partkey", "raw_code", canonical_code("raw_code").alias("code"))


# percent text of a conditional count.
@register("percent_text", oracle=f"""
SELECT l_returnflag, COUNT(*) AS total_lines,
       CAST(SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS closed_lines,
       {sql_pct("SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS closed_share
FROM lineitem GROUP BY l_returnflag
""")
def percent_text_q(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_returnflag", "l_linestatus")
    g = li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(F.col("l_linestatus") == "F").alias("closed_lines"))
    return g.withColumn("closed_share", percent_text("closed_lines", "total_lines"))


RAW_DIGITS = """CASE
  WHEN o_orderkey % 11 = 0 THEN '13' || substr(CAST(o_orderkey + 100000 AS STRING), 3, 2) || CAST(year(o_orderdate) AS STRING)
  WHEN o_orderkey % 3 = 0 THEN 'b''' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0')
       || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || CAST(year(o_orderdate) AS STRING) || ''''
  ELSE CAST(month(o_orderdate) AS STRING) || lpad(CAST(day(o_orderdate) AS STRING), 2, '0')
       || CAST(year(o_orderdate) AS STRING) END"""


# MMDDYYYY digits (leading zero lost, bytes wrapper) -> DATE.
@register("date_from_digits", oracle=f"""
WITH t AS (SELECT o_orderkey, {RAW_DIGITS.replace('STRING', 'VARCHAR')} AS raw_digits FROM orders),
c AS (SELECT o_orderkey, raw_digits, {sql_clean("replace(replace(raw_digits, 'b''', ''), '''', '')")} AS d FROM t)
SELECT o_orderkey, raw_digits, CAST(try_strptime(right('00000000' || d, 8), '%m%d%Y') AS DATE) AS parsed_date
FROM c
""")
def date_from_digits_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    t = o.select("o_orderkey", F.expr(RAW_DIGITS).alias("raw_digits"))
    return t.select("o_orderkey", "raw_digits",
                    date_from_digits(clean_special_text("raw_digits")).alias("parsed_date"))


PARTS = ["o_orderkey",
         """CASE WHEN o_orderkey % 4 = 0 THEN CAST(year(o_orderdate) AS STRING) || '.0'
            ELSE CAST(year(o_orderdate) AS STRING) END AS year_text""",
         """CASE WHEN o_orderkey % 13 = 0 THEN CAST(month(o_orderdate) + 12 AS STRING)
            WHEN o_orderkey % 17 = 0 THEN CAST(month(o_orderdate) AS STRING) || '.5'
            ELSE CAST(month(o_orderdate) AS STRING) END AS month_text""",
         "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) END AS known_date"]


# F16: first day of year/month, existing date wins.
@register("date_from_parts", oracle=f"""
WITH t AS (SELECT {", ".join(PARTS).replace('STRING', 'VARCHAR')} FROM orders),
n AS (SELECT *, TRY_CAST(year_text AS DOUBLE) AS y, TRY_CAST(month_text AS DOUBLE) AS m FROM t)
SELECT o_orderkey, year_text, month_text, known_date,
       COALESCE(known_date, CASE WHEN y = floor(y) AND m = floor(m) AND m BETWEEN 1 AND 12
                                 THEN make_date(CAST(y AS BIGINT), CAST(m AS BIGINT), 1) END) AS built_date
FROM n
""")
def date_from_parts_q(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    t = o.selectExpr(*PARTS)
    return t.select("o_orderkey", "year_text", "month_text", "known_date",
                    date_from_parts("year_text", "month_text", "known_date").alias("built_date"))


HASH_COLS = ["c_custkey", "c_name", "c_nationkey", "CAST(c_acctbal AS DECIMAL(18,2))",
             "NULLIF(c_mktsegment, 'BUILDING')"]


# Row fingerprint with every slot kept.
@register("row_hash", oracle="""
SELECT c_custkey, sha256(""" + " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in HASH_COLS) + """) AS row_hash
FROM customer
""")
def row_hash_q(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    return c.select("c_custkey", row_hash([F.expr(x) for x in HASH_COLS]).alias("row_hash"))
