"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfsight.session import stage


def _compressed(parents: DataFrame) -> DataFrame:
    """Point every node at the root of its tree, by doubling."""
    while True:
        above = parents.select(F.col("node").alias("at"), F.col("root").alias("next"))
        jumped = stage(
            parents.join(above, F.col("root") == F.col("at"), "left").select(
                "node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "jumped",
        )
        parents = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            return parents


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node over the undirected edges ``a``, ``b``.

    Returns (node, component) for every node that is not itself the smallest of
    its component; the others need no row. Ids of any ordered type.

    Each round hooks every node to its smallest smaller neighbour, compresses
    the trees, and keeps the edges between different roots. Local minima alone
    survive a round, so rounds grow with the logarithm of the longest path. All
    steps are joins and minima, so a node with very many edges is split by AQE
    and combined before the shuffle; every table is written to the shared folder.
    Null ids and loops are left out.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return (
            df.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            .distinct()
        )

    links, rounds = stage(tidy(edges), "links"), []
    while not rounds or not links.isEmpty():
        parents = stage(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "parents")
        parents = _compressed(parents)
        rounds.append(parents)
        low = parents.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        high = parents.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
        links = stage(
            tidy(
                links.join(low, "lo", "left")
                .join(high, "hi", "left")
                .select(F.coalesce("lo_root", "lo").alias("a"), F.coalesce("hi_root", "hi").alias("b"))
            ),
            "links",
        )
    out = rounds.pop()
    while rounds:
        above = out.select(F.col("node").alias("at"), F.col("root").alias("top"))
        earlier = rounds.pop().join(above, F.col("root") == F.col("at"), "left")
        out = out.unionByName(earlier.select("node", F.coalesce("top", "root").alias("root")))
    return stage(out.select("node", F.col("root").alias("component")), "components")


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """What :func:`components` gives for the edges behind ``labels`` and these together.

    Only the smallest nodes of the components are linked anew, so the work on a
    few more edges does not repeat that on the many before.
    """
    low = labels.select(F.col("node").alias("a"), F.col("component").alias("root_a"))
    high = labels.select(F.col("node").alias("b"), F.col("component").alias("root_b"))
    roots = edges.join(low, "a", "left").join(high, "b", "left")
    more = components(roots.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
    above = more.select(F.col("node").alias("component"), F.col("component").alias("top"))
    old = labels.join(above, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return stage(old.unionByName(more), "components")
