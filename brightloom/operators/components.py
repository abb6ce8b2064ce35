"""Connected components of a large undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightloom.operators.joins import lookup_join
from brightloom.staging import stage
from brightloom.unions import union_all


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, label): label is the smallest node id of the component.

    ``nodes(id)``; ``edges(u, v)`` in one direction. Every round hooks trees onto smaller neighbouring
    grandparents and halves the paths; rounds grow with the logarithm of the longest path. Each round is
    a written table, and the number of changed nodes is the only thing read by the driver.
    """
    both = stage(
        union_all(edges.select("u", "v"), edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(),
        "edges",
    )
    # a hub may hold a large share of all edges, so edges meet their end nodes through a dealt join
    degrees = both.groupBy(F.col("v").alias("id")).agg(F.count(F.lit(1)).alias("deg"))
    forest = stage(
        nodes.join(degrees, "id", "left").select("id", F.col("id").alias("f"), F.coalesce("deg", F.lit(0)).alias("deg")),
        "forest",
    )
    for _ in range(max_rounds):
        # grandparent of each node: a root may be the parent of most nodes, so its rows are dealt out
        weights = forest.groupBy(F.col("f").alias("p")).agg(F.count(F.lit(1)).alias("_w"))
        parents = stage(
            weights.join(forest.select(F.col("id").alias("p"), F.col("f").alias("g")), "p"), "parents"
        )
        with_g = stage(
            lookup_join(forest.withColumnRenamed("f", "p"), parents, ["p"], weight="_w", spread_by=["id"]).select("id", "p", "g", "deg"), "grand"
        )
        near = (
            lookup_join(
                both, with_g.select(F.col("id").alias("v"), F.col("g").alias("gv"), "deg"), ["v"], weight="deg",
                how="inner", spread_by=["u"],
            )
            .groupBy("u").agg(F.min("gv").alias("m"))
        )
        found = stage(
            with_g.join(near, F.col("id") == F.col("u"), "left").select("id", "p", "g", F.coalesce("m", "g").alias("m"), "deg"),
            "found",
        )
        hooked = found.groupBy(F.col("p").alias("id")).agg(F.min("m").alias("h"))
        nxt = stage(
            found.join(hooked, "id", "left").select(
                "id", "deg", F.col("p").alias("old"), F.least(F.coalesce("h", "g"), "m", "g", "p").alias("f")
            ),
            "forest",
        )
        changed = nxt.filter("f <> old").limit(1).count()
        forest = nxt.select("id", "f", "deg")
        if not changed:
            return forest.select("id", F.col("f").alias("label"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
