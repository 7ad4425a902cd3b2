"""Connected components of an edge table by repeated contraction, without a hub ever meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firn.llm.common import salted_join, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of the undirected edges; equal labels, one component.

    Each round maps every node to the least of itself and its neighbours, in the order of a hash, so that paths shrink by a
    constant factor, and moves the edges to the images. What is left at the end are single nodes. Null ends are dropped;
    no edges give no rows.
    """
    keyed = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    left = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(keyed(a).alias("a"), keyed(b).alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("up")), "contraction")
        maps.append(up)
        step = salted_join(left, up, ["a"], F.col("b"))
        step = salted_join(step.select(F.col("up").alias("x"), F.col("b").alias("a")), up, ["a"], F.col("x"))
        left = written(step.select(F.least("x", "up").alias("a"), F.greatest("x", "up").alias("b")).where("a <> b").distinct(), "edges")
    if not maps:
        return left.select(F.col("a.v").alias("node"), F.col("b.v").alias("label"))
    labels = maps[0].select(F.col("a").alias("node"), F.col("up").alias("a"))
    for up in maps[1:]:
        labels = salted_join(labels, up, ["a"], F.col("node"), "left").select("node", F.coalesce("up", "a").alias("a"))
    return written(labels.select(F.col("node.v").alias("node"), F.col("a.v").alias("label")), "labels")
