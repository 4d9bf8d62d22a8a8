"""Connected components by hooking and pointer jumping, as joins of link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of any direction to ``(node, root)``, root being the smallest node reachable.

    Only nodes that have a link occur in the result. Links of a node with
    itself, repeated links and an empty table are allowed; a null end drops the
    link. Each round hooks every node to its smallest neighbour, shortens the
    chains by doubling and contracts the links to roots; at least half of the
    nodes that still have links go in every round. Tables between rounds are
    written to the shared folder, so lost executors cost no earlier round.
    """
    links = settle(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    labels = links.select(F.col("b").alias("node"), F.col("a").alias("root")).limit(0)
    while not links.isEmpty():
        parents = settle(links.groupBy("b").agg(F.min("a").alias("p")))
        changed = True
        while changed:
            up = parents.select(F.col("b").alias("p"), F.col("p").alias("pp"))
            parents = settle(
                parents.select("b", "p").join(up, "p", "left")
                .select("b", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("changed"))
            )
            changed = not parents.where("changed").isEmpty()
        up = parents.select(F.col("b").alias("root"), F.col("p").alias("up"))
        labels = settle(
            labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
            .unionByName(up.select(F.col("root").alias("node"), F.col("up").alias("root")))
        )
        one = up.select(F.col("root").alias("a"), F.col("up").alias("ua"))
        two = up.select(F.col("root").alias("b"), F.col("up").alias("ub"))
        links = settle(
            links.join(one, "a", "left").join(two, "b", "left")
            .select(F.coalesce("ua", "a").alias("x"), F.coalesce("ub", "b").alias("y"))
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
    return labels
