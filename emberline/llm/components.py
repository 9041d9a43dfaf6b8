"""Connected components by alternating large-star and small-star steps, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.llm.common import drop_table, splittable, table


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph: one row (node, component) for each node that has an edge to another node.

    component is the smallest node of the component. Node ids are longs; null ends and loops are ignored. Each round
    points neighbours at smaller neighbours until every node points at its component's smallest one; a round's edges
    are written to the shared folder, so no lineage grows and a lost executor costs one round at most.
    """
    now = table(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u", splittable("u")).agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u", splittable("u")).agg(F.min("v").alias("m")).drop("_one")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = table(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        seen = _mark(after)
        drop_table(now)
        now, done = after, seen == mark
        if done:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (row[0], row[1])
