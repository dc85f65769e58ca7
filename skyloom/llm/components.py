"""Connected components of a table of links, by smallest labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyloom.llm.common import dealt, hot_keys, repeated
from skyloom.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours and then that label's own label,
    so the number of rounds grows with the logarithm of the longest chain. Labels are aggregated
    before the shuffle; the links of a node with very many of them are dealt over several places, to
    which its label is sent. State is a written table.
    """
    one, other = F.col("a").alias("node"), F.col("b").alias("beside")
    edges = links.select(one, other).union(links.select(F.col("b").alias("node"), F.col("a").alias("beside")))
    edges = stored(edges.where("node != beside").distinct())
    hot = hot_keys(edges.groupBy("beside").agg(F.count("*").alias("n")), "beside", edges.count())
    edges = stored(dealt(edges, "beside", hot, ["node"]))
    labels = stored(edges.groupBy("node").agg(F.min("beside").alias("comp")).select("node", F.least("node", "comp").alias("comp")))
    while True:
        near = edges.join(repeated(labels.withColumnRenamed("node", "beside"), "beside", hot), ["beside", "salt"]).select("node", "comp")
        least = near.union(labels).groupBy("node").agg(F.min("comp").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        jumped = least.join(up, "comp").select("node", F.least("comp", "next").alias("comp"))
        moved = stored(jumped.join(labels.withColumnRenamed("comp", "old"), "node"))
        labels = moved.drop("old")
        if moved.where("comp != old").isEmpty():
            return labels


def extended(comps: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the components that the new links touch are joined anew."""
    mine = lambda end: comps.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
    ends = links.join(mine("a"), "a", "left").join(mine("b"), "b", "left")
    ends = stored(ends.select("a", "b", F.coalesce("comp_a", "a").alias("comp_a"), F.coalesce("comp_b", "b").alias("comp_b")))
    roots = components(ends.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    new = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(comps, "node", "left_anti")
    known = comps.unionByName(new.withColumn("comp", F.col("node")))
    moved = known.join(roots.select(F.col("node").alias("comp"), F.col("comp").alias("root")), "comp", "left")
    return stored(moved.select("node", F.coalesce("root", "comp").alias("comp")))
