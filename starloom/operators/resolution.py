"""All attributes resolved in one pass, from seeds held as constants.

A domain's codes and normalised spellings are two constant maps; a row then
needs no join and no shuffle for any number of attributes.  Seeds are part
of the program, so their size is fixed; a lookup that grows with the data
belongs in ``lookups.resolve`` or ``hierarchy.resolve_hierarchy``, which
join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.codes import canonical_code, flag, range_guard, try_int
from starloom.functions.text import BLANK, NOT_FOUND, folded_text, normalize_country, normalize_text, normalized, normalized_country
from starloom.operators.hierarchy import Hierarchy, choose
from starloom.operators.lookups import DuplicateMapKey, seed_frame
from starloom.sources import catalogue
from starloom.sources.catalogue import Domain


def _quoted(text: str | None) -> str:
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_map(entries: Iterable[tuple[str, str]]) -> Column:
    """A constant map from text to values written as SQL; equal entries count once, two values for one key are an error."""
    known: dict[str, str] = {}
    for key, value in entries:
        if known.setdefault(key, value) != value:
            raise DuplicateMapKey(f"duplicate map key {key!r}")
    return F.expr("map(" + ", ".join(f"{_quoted(k)}, {v}" for k, v in known.items()) + ")")


def by_spelling(entries: Iterable[tuple[str, str]], text: Column) -> Column:
    """The value of a normalised spelling; blank text has that of ``BLANK``, under both, so that a text is normalised once."""
    known = list(entries)
    return F.try_element_at(constant_map(known + [("", v) for k, v in known if k == BLANK]), folded_text(text))


def label_of(domain: Domain, raw: str | Column) -> Column:
    """The standard label of a raw value: by numeric code, else by normalised spelling, else the raw text where kept, else 'Not Found'."""
    text = (F.col(raw) if isinstance(raw, str) else raw).cast("string")
    tries = []
    if domain.codes:
        tries.append(F.try_element_at(constant_map((c, _quoted(x)) for c, x in domain.codes.items()), canonical_code(text)))
    tries.append(by_spelling(((normalized(r), _quoted(x)) for r, x in domain.raw_values), text))
    if domain.keep_raw:
        tries.append(F.nullif(F.trim(text), F.lit("")))
    return F.coalesce(*tries, F.lit(NOT_FOUND))


def with_location(df: DataFrame, country: str, state: str) -> DataFrame:
    """``row, parent, child``: country and state from the fixed seeds, by the ways of ``hierarchy.choose``."""
    states, names = catalogue.state_rows(), dict(catalogue.country_rows())
    unknown_of = {c: i for i, _, name, c in states if name == NOT_FOUND}
    no_child = "CAST(NULL AS STRUCT<child_id: INT, child_name: STRING>)"

    def parent(i: int) -> str:
        unknown = f"named_struct('child_id', {unknown_of[i]}, 'child_name', {_quoted(NOT_FOUND)})" if i in unknown_of else no_child
        return f"named_struct('parent_id', {i}, 'parent_name', {_quoted(names[i])}, 'unknown', {unknown})"

    child = {i: f"named_struct('child_id', {i}, 'child_name', {_quoted(name)}, 'parent', {parent(c)})" for i, _, name, c in states}
    nowhere = next(i for i, n in names.items() if n == NOT_FOUND)
    c, s = F.col(country).cast("string"), F.col(state).cast("string")
    return choose(df.select(
        F.struct(*[F.col(x) for x in df.columns]).alias("row"),
        F.try_element_at(constant_map((n, parent(i)) for i, n in names.items()), c).alias("exact"),
        F.try_element_at(constant_map((normalized_country(r), parent(i)) for r, i in catalogue.country_raw()), normalize_country(c)).alias("spelled"),
        F.try_element_at(constant_map((code, child[i]) for i, code, _, _ in states if code), canonical_code(s)).alias("coded"),
        by_spelling(((normalized(r), f"array({child[i]})") for r, i in catalogue.state_raw()), s).alias("named"),
        F.expr(parent(nowhere)).alias("nowhere")))


def resolve_all(df: DataFrame, columns: Mapping[str, str] | None = None, domains: Sequence[Domain] = catalogue.DOMAINS,
                country: str | None = "Country", state: str | None = "State", days: str | None = "MentalHealthDays") -> DataFrame:
    """``df`` with every attribute replaced by its standard label.

    ``columns`` names the input column of a domain (default: the domain's
    own name); the labels go to columns of the domain's name.  Country and
    state are resolved together and add ``CountryID`` and ``StateID``; day
    counts outside 0 to 30 become NULL; ``TreatmentFlag`` is 1 where the
    treatment resolves to Yes.  Columns that aren't attributes stay.
    """
    columns = columns or {}
    place: dict[str, Column] = {}
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    if country and state:
        rows = with_location(df, country, state)
        place = {"CountryID": F.col("parent.parent_id"), "Country": F.col("parent.parent_name"), "StateID": F.col("child.child_id"), "State": F.col("child.child_name")}
    out = {d.name: label_of(d, F.col("row").getField(columns.get(d.name, d.name))) for d in domains} | place
    if days:
        out["MentalHealthDays"] = range_guard(try_int(F.col("row").getField(days)), 0, 30)
    used = {columns.get(d.name, d.name) for d in domains} | {x for x in (country, state, days) if x}
    rest = [F.col("row").getField(c).alias(c) for c in df.columns if c not in used and c not in out]
    resolved = rows.select(*rest, *[c.alias(name) for name, c in out.items()])
    return resolved.withColumn("TreatmentFlag", flag(F.col("Treatment") == "Yes")) if "Treatment" in out else resolved


def lookup_masters(spark: SparkSession, domains: Sequence[Domain] = catalogue.DOMAINS) -> DataFrame:
    """One relation of all masters: ``domain, value_id, code, label``."""
    return seed_frame(spark, [(d.name, *row) for d in domains for row in d.masters], "domain string, value_id int, code string, label string")


def lookup_maps(spark: SparkSession, domains: Sequence[Domain] = catalogue.DOMAINS, normalizer: Callable[[Column], Column] = normalize_text) -> DataFrame:
    """One relation of all maps: ``domain, raw_key, value_id, label``, a row for each normalised spelling."""
    raw = seed_frame(spark, [(d.name, r, x) for d in domains for r, x in d.raw_values], "domain string, raw string, label string")
    keyed = raw.select("domain", normalizer(F.col("raw")).alias("raw_key"), "label").distinct()
    return keyed.join(lookup_masters(spark, domains).drop("code"), ["domain", "label"]).select("domain", "raw_key", "value_id", "label")


def survey_hierarchy(spark: SparkSession) -> Hierarchy:
    """The survey's countries and states as relations, for ``resolve_hierarchy``."""
    return Hierarchy(seed_frame(spark, catalogue.country_rows(), "id int, name string"),
                     seed_frame(spark, catalogue.state_rows(), "id int, code string, name string, parent_id int"),
                     seed_frame(spark, catalogue.country_raw(), "raw string, id int"), seed_frame(spark, catalogue.state_raw(), "raw string, id int"))
