"""Two-level resolution: a noisy parent and child text to rows of a hierarchy.

The parent is chosen by the first of five ways that finds one: its exact
name, its normalised spelling, the parent of the child that the child text
codes for, the parent of the child that it spells, the 'Not Found' parent.
The child is then chosen *inside that parent*: the coded one, the spelled
one, the parent's own 'Not Found' child, that of the 'Not Found' parent.

The second choice depends on the first one's answer for each row.  Instead
of a lookup per row, every candidate brings its parent along, and a spelling
that several parents share brings all its children, so both choices are
expressions over three equi joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.codes import canonical_code
from starloom.functions.text import NOT_FOUND, normalize_country, normalize_text


@dataclass(frozen=True)
class Hierarchy:
    """``parents``: id, name.  ``children``: id, code, name, parent_id.  ``parent_spellings``: raw, id.  ``child_spellings``: raw, id."""

    parents: DataFrame
    children: DataFrame
    parent_spellings: DataFrame
    child_spellings: DataFrame
    parent_normalizer: Callable[[Column], Column] = normalize_country
    child_normalizer: Callable[[Column], Column] = normalize_text
    unknown: str = NOT_FOUND


def _known_parents(h: Hierarchy) -> DataFrame:
    """``p_id, parent``: the parent with its own unknown child, if it has one."""
    unknown = (h.children.filter(F.col("name") == h.unknown).groupBy(F.col("parent_id").alias("u_id"))
               .agg(F.min("id").alias("child_id")).select("u_id", F.struct("child_id", F.lit(h.unknown).alias("child_name")).alias("unknown")))
    return (h.parents.join(unknown, F.col("id") == F.col("u_id"), "left")
            .select(F.col("id").alias("p_id"), F.struct(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"), "unknown").alias("parent")))


def _known_children(h: Hierarchy) -> DataFrame:
    """``c_id, c_code, child``: the child with its parent."""
    return (h.children.join(_known_parents(h), F.col("parent_id") == F.col("p_id"))
            .select(F.col("id").alias("c_id"), F.col("code").alias("c_code"),
                    F.struct(F.col("id").alias("child_id"), F.col("name").alias("child_name"), "parent").alias("child")))


def choose(found: DataFrame) -> DataFrame:
    """Both choices: ``row, parent, parent_way, child, child_way`` from ``row`` and its candidates.

    ``exact`` and ``spelled`` are parents, ``coded`` a child, ``named`` the
    children of one spelling by ascending id, ``nowhere`` the unknown
    parent; each may be null.
    """
    first = F.try_element_at("named", F.lit(1))
    parent = F.coalesce("exact", "spelled", "coded.parent", first["parent"], "nowhere")
    parent_way = (F.when(F.col("exact").isNotNull(), 1).when(F.col("spelled").isNotNull(), 2).when(F.col("coded").isNotNull(), 3)
                  .when(first.isNotNull(), 4).otherwise(5))
    placed = found.select("row", "coded", "named", "nowhere", parent.alias("parent"), parent_way.alias("parent_way"))
    same = F.col("coded.parent.parent_id") == F.col("parent.parent_id")
    inside = F.try_element_at(F.filter("named", lambda c: c["parent"]["parent_id"] == F.col("parent.parent_id")), F.lit(1))
    own = placed.select("row", "parent", "parent_way", "nowhere", F.when(same, F.col("coded")).alias("by_code"), inside.alias("by_name"))

    def plain(c: str) -> Column:
        # a null struct stays null
        return F.when(F.col(c).isNotNull(), F.struct(F.col(f"{c}.child_id").alias("child_id"), F.col(f"{c}.child_name").alias("child_name")))

    child = F.coalesce(plain("by_code"), plain("by_name"), "parent.unknown", "nowhere.unknown")
    child_way = (F.when(F.col("by_code").isNotNull(), 1).when(F.col("by_name").isNotNull(), 2).when(F.col("parent.unknown").isNotNull(), 3).otherwise(4))
    return own.select("row", "parent", "parent_way", child.alias("child"), child_way.alias("child_way"))


def candidates(h: Hierarchy) -> tuple[DataFrame, DataFrame, DataFrame, Column]:
    """The three relations that rows are joined to, each with one row for a key, and the unknown parent as a scalar.

    A normalised parent spelling has the parents of that exact name, by
    name, and the one it stands for; a code has its child; a normalised
    child spelling has its children.  Of several rows with one key the
    smallest id counts, but for children of different parents.
    """
    known = _known_parents(h)
    names = known.select(h.parent_normalizer(F.col("parent.parent_name")).alias("p_key"), F.col("parent.parent_name").alias("name"), "parent")
    names = names.groupBy("p_key", "name").agg(F.min_by("parent", "parent.parent_id").alias("parent"))
    names = names.groupBy("p_key").agg(F.map_from_entries(F.collect_list(F.struct("name", "parent"))).alias("by_name"))
    spelled = (h.parent_spellings.select(h.parent_normalizer(F.col("raw")).alias("s_key"), F.col("id").alias("s_id"))
               .join(known, F.col("s_id") == F.col("p_id")).groupBy("s_key").agg(F.min_by("parent", "p_id").alias("spelled")))
    parents = names.join(spelled, F.col("p_key") == F.col("s_key"), "full").select(F.coalesce("p_key", "s_key").alias("p_key"), "by_name", "spelled")
    children = _known_children(h)
    codes = children.filter("c_code is not null").groupBy(F.col("c_code").alias("code_key")).agg(F.min_by("child", "c_id").alias("coded"))
    spellings = (h.child_spellings.select(h.child_normalizer(F.col("raw")).alias("c_key"), F.col("id").alias("s_id"))
                 .join(children, F.col("s_id") == F.col("c_id"))
                 .groupBy("c_key", F.col("child.parent.parent_id").alias("of")).agg(F.min_by("child", "c_id").alias("child"))
                 .groupBy("c_key").agg(F.array_sort(F.collect_list("child"), lambda a, b: F.when(a["child_id"] < b["child_id"], -1).otherwise(1)).alias("named")))
    nowhere = known.filter(F.col("parent.parent_name") == h.unknown).select(F.min_by("parent", "p_id").alias("nowhere")).scalar()
    return parents, codes, spellings, nowhere


def resolve_hierarchy(df: DataFrame, h: Hierarchy, parent_raw: str, child_raw: str, prefix: tuple[str, str] = ("parent", "child")) -> DataFrame:
    """``df`` with id, name and way (1 to 5, 1 to 4) of the resolved parent and child, named by ``prefix``.

    Every row of ``df`` stays once, whatever its texts (null, blank, unknown).
    The joined relations have one row for a key, so none fans out, and no
    side is hinted: their size decides how they are joined.
    """
    parents, codes, spellings, nowhere = candidates(h)
    keyed = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(parent_raw).cast("string").alias("raw_parent"),
                      h.parent_normalizer(F.col(parent_raw)).alias("k_parent"), canonical_code(F.col(child_raw)).alias("k_code"),
                      h.child_normalizer(F.col(child_raw)).alias("k_child"))
    joined = (keyed.join(parents, F.col("k_parent") == F.col("p_key"), "left")
              .join(codes, F.col("k_code") == F.col("code_key"), "left")
              .join(spellings, F.col("k_child") == F.col("c_key"), "left"))
    found = joined.select("row", F.try_element_at("by_name", F.col("raw_parent")).alias("exact"), "spelled", "coded", "named", nowhere.alias("nowhere"))
    p, c = prefix
    return choose(found).select("row.*", F.col("parent.parent_id").alias(f"{p}_id"), F.col("parent.parent_name").alias(f"{p}_name"), F.col("parent_way").alias(f"{p}_way"),
                                F.col("child.child_id").alias(f"{c}_id"), F.col("child.child_name").alias(f"{c}_name"), F.col("child_way").alias(f"{c}_way"))
