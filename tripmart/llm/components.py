"""Connected components of an edge table by hooking to the smallest neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b) that is not its own root; root is the component's smallest id.

    Each pass lets every node hook to its smallest neighbour below it, follows the hooks to their ends and
    replaces edges by edges between these ends. A pass removes every node that has a smaller neighbour, so few
    passes are needed. Edges and labels stay in tables; only row counts reach the driver.
    """
    edges = _ordered(edges, "a", "b")
    edges = stored(edges, "edges")
    labels = None
    while not edges.isEmpty():
        hooks = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = stored(
                hooks.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                "jump",
            )
            hooks = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = hooks
        else:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = labels.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            labels = stored(moved.unionByName(hooks), "labels")
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("left"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("right"))
        joined = edges.join(left, "a", "left").join(right, "b", "left")
        edges = stored(_ordered(joined, F.coalesce("left", "a"), F.coalesce("right", "b")), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def _ordered(frame: DataFrame, one, other) -> DataFrame:
    """Distinct edges from the larger to the smaller end, without loops."""
    one, other = (F.col(x) if isinstance(x, str) else x for x in (one, other))
    return frame.select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).where("a > b").distinct()
