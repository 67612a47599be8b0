"""Connected components of a link table, by Spark jobs only.

Each round hooks every node that has a smaller neighbour onto its smallest
one, shortens the chains by pointer doubling, and replaces the links' ends by
their roots.  Links inside one tree vanish, so few rounds are needed.  Every
intermediate table is written to the shared folder and read again; joins read
both sides from files, so a hot root is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemart.llm.common import discard, publish


def _oriented(links: DataFrame) -> DataFrame:
    return (links.filter("a <> b")
            .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())


def _roots(links: DataFrame) -> DataFrame:
    """(node, root) of the forest in which each node hangs on its smallest neighbour."""
    tree = publish(links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "cc-hook")
    while True:
        up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = tree.join(up, "root", "left").select(
            "node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        jumped = publish(jumped, "cc-jump")
        discard(tree)
        tree = jumped
        if not tree.filter("moved").limit(1).count():
            return tree


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is
    the smallest node that can be reached.  Nulls, self links and repeated
    links are ignored; no links give an empty table."""
    links = publish(_oriented(links), "cc-links")
    labels = None
    while links.limit(1).count():
        tree = _roots(links)
        ends = tree.select(F.col("node").alias("hi"), F.col("root").alias("r1"))
        other = tree.select(F.col("node").alias("lo"), F.col("root").alias("r2"))
        rest = (links.join(ends, "hi", "left").join(other, "lo", "left")
                .select(F.coalesce("r1", "hi").alias("a"), F.coalesce("r2", "lo").alias("b")))
        rest = publish(_oriented(rest), "cc-links")
        if labels is None:
            new = tree.select("node", "root")
        else:
            up = tree.select(F.col("node").alias("root"), F.col("root").alias("above"))
            new = (labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
                   .unionByName(tree.select("node", "root").join(labels, "node", "left_anti")))
        labels = publish(new, "cc-labels")
        discard(links)
        discard(tree)
        links = rest
    if labels is None:
        return links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return (labels.select("node", F.col("root").alias("component"))
            .unionByName(labels.select(F.col("root").alias("node"), F.col("root").alias("component"))).distinct())
