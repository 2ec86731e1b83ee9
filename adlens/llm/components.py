"""Connected components by union-find over a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of the edges ``a, b``: the smallest node of each component.

    Union: every root hooks itself under its smallest smaller neighbour. Find:
    parents are replaced by their parents until none changes. The edges are
    then rewritten between roots and those inside a tree dropped; each round at
    least halves the roots that still have edges. All of it is joins and
    minima; no neighbour list is ever gathered, so a node that a third of all
    others are linked to is no special case.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(edges.distinct(), "cc-edges")
    roots = stored(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                   .withColumn("root", F.col("node")), "cc-roots")
    while not edges.isEmpty():
        parents = stored(edges.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent")), "cc-parents")
        while True:
            up = parents.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
            jumped = stored(parents.join(up, "parent", "left").select(
                "child", F.coalesce("above", "parent").alias("parent"),
                F.col("above").isNotNull().alias("moved")), "cc-jump")
            parents = jumped.select("child", "parent")
            if jumped.where("moved").isEmpty():
                break
        find = {x: parents.select(F.col("child").alias(x), F.col("parent").alias(f"{x}_up"))
                for x in ("a", "b", "root")}
        roots = stored(roots.join(find["root"], "root", "left")
                       .select("node", F.coalesce("root_up", "root").alias("root")), "cc-roots")
        moved = edges.join(find["a"], "a", "left").join(find["b"], "b", "left").select(
            F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y"))
        edges = stored(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .distinct(), "cc-edges")
    return roots
