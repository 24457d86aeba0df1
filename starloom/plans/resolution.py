"""Value resolution: countries and states by priority, and all attributes of a survey row in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.hierarchy import Hierarchy, resolve_hierarchy
from starloom.operators.resolution import resolve_all
from starloom.plans.registry import register, sql_normalize
from starloom.plans.scalar import sql_canonical
from starloom.sources import catalogue
from starloom.sources.tables import read_table, spread

# ---------------------------------------------------------------------------
# Regions and nations from noisy text.  Every fifth nation
# has a namesake in another region; 'ASIA' has an unknown nation of its own.
# ---------------------------------------------------------------------------
RAW_PARENT = """CASE c_custkey % 8
  WHEN 0 THEN r_name WHEN 1 THEN '  ' || lower(r_name) || '. ' WHEN 2 THEN 'Region of ' || r_name WHEN 3 THEN NULL
  WHEN 4 THEN 'the ' || r_name WHEN 5 THEN '' WHEN 6 THEN 'U.S.A.' ELSE 'Not Found' END"""
RAW_CHILD = """CASE c_custkey % 5
  WHEN 0 THEN ' ' || CAST(n_nationkey AS STRING) || '.0' WHEN 1 THEN lower(n_name) || ' ;' WHEN 2 THEN 'nowhere'
  WHEN 3 THEN NULL ELSE 'NATION_' || CAST(n_nationkey - n_nationkey % 5 AS STRING) END"""

HIERARCHY_SQL = f"""
WITH raw AS (
  SELECT c_custkey, {RAW_PARENT} AS raw_region, {RAW_CHILD.replace('STRING', 'VARCHAR')} AS raw_nation
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON r_regionkey = (n_regionkey + c_custkey // 40) % 5),
parents AS (SELECT r_regionkey AS id, r_name AS name FROM region UNION ALL SELECT -1, 'Not Found'),
children AS (
  SELECT n_nationkey AS id, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, n_regionkey AS pid FROM nation
  UNION ALL SELECT n_nationkey + 1000, NULL, n_name, (n_regionkey + 1) % 5 FROM nation WHERE n_nationkey % 5 = 0
  UNION ALL SELECT 9000, NULL, 'Not Found', r_regionkey FROM region WHERE r_name = 'ASIA'
  UNION ALL SELECT 9999, NULL, 'Not Found', -1),
pmap AS (SELECT {sql_normalize('r_name')} AS k, r_regionkey AS id FROM region UNION ALL SELECT {sql_normalize("'the ' || r_name")}, r_regionkey FROM region
         UNION ALL SELECT 'UNITED STATES', r_regionkey FROM region WHERE r_name = 'AMERICA'),
cmap AS (SELECT {sql_normalize('name')} AS k, id, pid FROM children WHERE name <> 'Not Found'),
folded AS (SELECT *, {sql_normalize('raw_region')} AS n0, {sql_normalize('raw_nation')} AS nk, {sql_canonical('raw_nation')} AS ck FROM raw),
keyed AS (SELECT *, CASE WHEN n0 IN ('US', 'USA', 'U S A', 'UNITED STATES OF AMERICA', 'U S', 'AMERICA') THEN 'UNITED STATES' ELSE n0 END AS pk FROM folded),
found AS (
  SELECT k.*, (SELECT min(id) FROM parents p WHERE p.name = k.raw_region) AS w1,
         (SELECT min(CASE WHEN m.k = 'AMERICA' THEN NULL ELSE m.id END) FROM pmap m WHERE m.k = k.pk) AS w2,
         (SELECT min(pid) FROM children c WHERE c.code = k.ck) AS w3,
         (SELECT arg_min(m.pid, m.id) FROM cmap m WHERE m.k = k.nk) AS w4
  FROM keyed k),
placed AS (SELECT *, COALESCE(w1, w2, w3, w4, -1) AS pid,
                  CASE WHEN w1 IS NOT NULL THEN 1 WHEN w2 IS NOT NULL THEN 2 WHEN w3 IS NOT NULL THEN 3 WHEN w4 IS NOT NULL THEN 4 ELSE 5 END AS region_way FROM found),
inside AS (
  SELECT p.*, (SELECT min(id) FROM children c WHERE c.code = p.ck AND c.pid = p.pid) AS c1,
         (SELECT min(m.id) FROM cmap m WHERE m.k = p.nk AND m.pid = p.pid) AS c2,
         (SELECT min(id) FROM children c WHERE c.name = 'Not Found' AND c.pid = p.pid) AS c3
  FROM placed p)
SELECT i.c_custkey, i.raw_region, i.raw_nation, p.id AS region_id, p.name AS region_name, i.region_way, c.id AS nation_id, c.name AS nation_name,
       CASE WHEN c1 IS NOT NULL THEN 1 WHEN c2 IS NOT NULL THEN 2 WHEN c3 IS NOT NULL THEN 3 ELSE 4 END AS nation_way
FROM inside i JOIN parents p ON p.id = i.pid JOIN children c ON c.id = COALESCE(c1, c2, c3, 9999)
"""


def nation_hierarchy(spark, sf_dir) -> Hierarchy:
    """Regions and nations with namesakes, unknown ones and spellings."""
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    none = F.lit(None).cast("string")
    parents = r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")).unionByName(
        spark.range(1).select(F.lit(-1).alias("id"), F.lit("Not Found").alias("name")))
    own = n.select(F.col("n_nationkey").alias("id"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"),
                   F.col("n_regionkey").alias("parent_id"))
    namesakes = n.filter("n_nationkey % 5 = 0").select((F.col("n_nationkey") + 1000).alias("id"), none.alias("code"), F.col("n_name").alias("name"),
                                                       ((F.col("n_regionkey") + 1) % 5).alias("parent_id"))
    unknown = r.filter("r_name = 'ASIA'").select(F.lit(9000).alias("id"), none.alias("code"), F.lit("Not Found").alias("name"), F.col("r_regionkey").alias("parent_id"))
    nowhere = spark.range(1).select(F.lit(9999).alias("id"), none.alias("code"), F.lit("Not Found").alias("name"), F.lit(-1).alias("parent_id"))
    children = own.unionByName(namesakes).unionByName(unknown).unionByName(nowhere)
    spelled = F.explode(F.array(F.col("r_name"), F.concat(F.lit("the "), "r_name")))
    parent_spellings = r.select(spelled.alias("raw"), F.col("r_regionkey").alias("id"))
    child_spellings = own.unionByName(namesakes).select(F.col("name").alias("raw"), "id")
    return Hierarchy(parents, children, parent_spellings, child_spellings)


@register("hierarchy_resolve", oracle=HIERARCHY_SQL)
def hierarchy_resolve(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n, r = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    shifted = F.pmod(F.col("n_regionkey") + F.floor(F.col("c_custkey") / 40), F.lit(5))
    raw = (c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, r["r_regionkey"] == shifted)
           .select("c_custkey", F.expr(RAW_PARENT).alias("raw_region"), F.expr(RAW_CHILD).alias("raw_nation")))
    return resolve_hierarchy(raw, nation_hierarchy(spark, sf_dir), "raw_region", "raw_nation", ("region", "nation"))


# ---------------------------------------------------------------------------
# D5, D6, section 2.14: all attributes.  A part's raw values are picked from
# each domain's codes and spellings, made noisy, and from text it doesn't know.
# ---------------------------------------------------------------------------
def _noisy(values: list[str]) -> list[str | None]:
    """Raw values as files hold them: floats for codes, stray blanks, case and signs, unknown text, blanks and NULL."""
    out: list[str | None] = [None, "", "  ", "zzz", "Not Found", "12345"]
    for k, v in enumerate(values):
        out += [f"{v}.0" if v.isdigit() else f" {v.lower()}" if k % 2 else f"{v.upper()}. ", v]
    return out


RAW_VALUES: dict[str, list[str | None]] = {d.name: _noisy(sorted({r for r, _ in d.raw_values} | set(d.labels))) for d in catalogue.DOMAINS}
RAW_VALUES["Country"] = _noisy(["United States", "usa", "Canada", "England", "France", "UK"])
RAW_VALUES["State"] = _noisy(["6", "25", "78", "3", "Texas", "TX", "NY", "Ontario", "Ohio"])
RAW_VALUES["MentalHealthDays"] = _noisy(["0", "30", "31", "77", "88", "-1"])


def _literal(x: object) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def _raw_sql(name: str, index: int) -> str:
    values = RAW_VALUES[name]
    return f"list_extract([{', '.join(map(_literal, values))}], CAST((p_partkey * {2 * index + 1} + p_size) % {len(values)} + 1 AS BIGINT)) AS {name}"


def _values_sql(rows: list[tuple], names: str) -> str:
    return f"(VALUES {', '.join('(' + ', '.join(x if isinstance(x, str) and x.startswith('upper(') else _literal(x) for x in r) + ')' for r in rows)}) v({names})"


def _resolve_all_sql() -> str:
    """Masters and maps as two relations; one scalar lookup for each attribute and way."""
    codes = [(d.name, c, x) for d in catalogue.DOMAINS for c, x in d.codes.items()]
    maps = [(d.name, r, x) for d in catalogue.DOMAINS for r, x in d.raw_values]
    labels = []
    for d in catalogue.DOMAINS:
        tries = [f"(SELECT min(label) FROM codes WHERE domain = '{d.name}' AND code = {sql_canonical('t.' + d.name)})"] if d.codes else []
        tries.append(f"(SELECT min(label) FROM maps WHERE domain = '{d.name}' AND raw_key = {sql_normalize('t.' + d.name)})")
        if d.keep_raw:
            tries.append(f"NULLIF(trim(t.{d.name}), '')")
        labels.append(f"COALESCE({', '.join(tries)}, 'Not Found') AS {d.name}")
    folded = f"CASE WHEN {sql_normalize('t.Country')} IN ('US', 'USA', 'U S A', 'AMERICA') THEN 'UNITED STATES' " \
             f"WHEN {sql_normalize('t.Country')} IN ('UK', 'GREAT BRITAIN', 'ENGLAND') THEN 'UNITED KINGDOM' ELSE {sql_normalize('t.Country')} END"
    return f"""
WITH t AS (SELECT p_partkey, {', '.join(_raw_sql(n, i) for i, n in enumerate(RAW_VALUES))} FROM part),
codes AS (SELECT domain, code, label FROM {_values_sql(codes, 'domain, code, label')}),
maps AS (SELECT DISTINCT domain, {sql_normalize('raw')} AS raw_key, label FROM {_values_sql(maps, 'domain, raw, label')}),
country AS (SELECT CAST(id AS INTEGER) AS id, name FROM {_values_sql(catalogue.country_rows(), 'id, name')}),
state AS (SELECT CAST(id AS INTEGER) AS id, code, name, CAST(pid AS INTEGER) AS pid FROM {_values_sql(catalogue.state_rows(), 'id, code, name, pid')}),
smap AS (SELECT DISTINCT {sql_normalize('raw')} AS raw_key, CAST(id AS INTEGER) AS id FROM {_values_sql(catalogue.state_raw(), 'raw, id')}),
found AS (
  SELECT t.*, (SELECT min(id) FROM country WHERE name = t.Country) AS w1, (SELECT min(id) FROM country WHERE upper(name) = {folded}) AS w2,
         (SELECT min(id) FROM state WHERE code = {sql_canonical('t.State')}) AS s1, (SELECT min(id) FROM smap WHERE raw_key = {sql_normalize('t.State')}) AS s2,
         ({sql_normalize('t.Country')}) = 'BLANK' AS blank
  FROM t),
placed AS (
  SELECT f.*, COALESCE(w1, w2, CASE WHEN blank THEN 1 END, a.pid, b.pid, 1) AS cid, a.pid AS p1, b.pid AS p2
  FROM found f LEFT JOIN state a ON a.id = f.s1 LEFT JOIN state b ON b.id = f.s2),
done AS (SELECT *, CASE WHEN p1 = cid THEN s1 WHEN p2 = cid THEN s2 ELSE 1 END AS sid FROM placed)
SELECT t.p_partkey, {', '.join(labels)}, t.cid AS CountryID, c.name AS Country, t.sid AS StateID, s.name AS State,
       CASE WHEN TRY_CAST(trim(t.MentalHealthDays) AS INTEGER) BETWEEN 0 AND 30 AND NOT contains(t.MentalHealthDays, '.') THEN TRY_CAST(trim(t.MentalHealthDays) AS INTEGER) END AS MentalHealthDays,
       CASE WHEN (SELECT min(label) FROM maps WHERE domain = 'Treatment' AND raw_key = {sql_normalize('t.Treatment')}) = 'Yes' THEN 1 ELSE 0 END AS TreatmentFlag
FROM done t JOIN country c ON c.id = t.cid JOIN state s ON s.id = t.sid
"""


@register("resolve_all", oracle=_resolve_all_sql())
def resolve_all_q(spark, sf_dir):
    p = spread(read_table(spark, sf_dir, "part", "p_partkey", "p_size"))
    raw = []
    for i, (name, values) in enumerate(RAW_VALUES.items()):
        at = F.pmod(F.col("p_partkey") * (2 * i + 1) + F.col("p_size"), F.lit(len(values))) + 1
        raw.append(F.element_at(F.array(*[F.lit(v) for v in values]), at.cast("int")).alias(name))
    return resolve_all(p.select("p_partkey", *raw))
