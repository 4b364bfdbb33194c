"""Connected components as alternating large-star / small-star steps (the
distributed form of union-find), each step a grouped aggregate and a join.

No link, node or component ever reaches the driver. Every step's table is
written to the shared folder, so a lost executor costs one step at most, and
the per-node minima are written before they are joined, so that Spark's
skew join can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blobferry.llm.common import materialize

MAX_STEPS = 64  # far above the O(log^2 n) steps needed; guards against a bug only


def _is_star(e: DataFrame) -> bool:
    """Every node has one parent, and no parent has a parent."""
    ends = (e.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent"))
            .unionAll(e.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent"))))
    return ends.groupBy("x").agg(F.sum("child").alias("c"), F.max("parent").alias("p")) \
        .where("c > 1 or (c > 0 and p > 0)").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a link to another node; ``root``
    is the smallest node of its component (its own row included). Nulls and
    loops are ignored, repeated links count once."""
    e = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "links")
    for _ in range(MAX_STEPS):
        if _is_star(e):
            break
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m"))
                          .select("u", F.least("u", "m").alias("m")), "links-min")
        large = materialize(both.where("v > u").join(low, "u")
                            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "links-min")
        e = materialize(large.join(low, "u")
                        .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                F.col("m").alias("v")).distinct(), "links")
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
