"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest neighbour, shortens the hooks
by pointer jumping and contracts the links.  A round at least halves the
nodes that still have links, so the rounds grow with the logarithm of the
nodes.  Links and labels stay in written tables; the driver sees counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import store


def _roots(hooks: DataFrame) -> DataFrame:
    """Pointer jumping: ``node, up`` with every ``up`` replaced by the root of its tree."""
    while True:
        above = hooks.select(F.col("node").alias("u_node"), F.col("up").alias("u_up"))
        jumped = store(hooks.join(above, hooks["up"] == above["u_node"])
                       .select("node", F.col("u_up").alias("up"), (F.col("up") != F.col("u_up")).alias("moved")), "jump")
        moved = jumped.filter("moved").limit(1).count()
        hooks = jumped.drop("moved")
        if not moved:
            return hooks


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of a link; ``root`` is the smallest node reachable."""
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = store(links.union(links.select("b", "a")).distinct(), "edges")
    labels = None
    while labels is None or edges.limit(1).count():
        least = edges.groupBy("a").agg(F.min("b").alias("b"))
        hooks = _roots(store(least.select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "hooks"))
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("root"))
        else:
            labels = store(labels.join(hooks.withColumnRenamed("node", "h"), F.col("root") == F.col("h"), "left")
                           .select("node", F.coalesce("up", "root").alias("root")), "labels")
        left = hooks.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        edges = store(edges.join(left, "a").join(right, "b").filter("ra <> rb")
                      .select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return labels
