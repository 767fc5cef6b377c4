"""Connected components of a graph in DataFrames: links between components shrink to none, with each round cut in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import cut, discard


def relabelled(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links between the labels of their ends, each once and none within a label; an end without a label is its own."""
    for x in ("a", "b"):
        to = labels.select(F.col("node").alias(x), F.col("root").alias("to"))
        links = links.join(to, x, "left").withColumn(x, F.coalesce("to", x)).drop("to")
    return links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def ranked(name: str) -> Column:
    """An order of nodes that has nothing to do with theirs, so that chains of them shrink everywhere at once."""
    return F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("x"))


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node, root: the least node of its component, for each node of links(a, b) and of `known`, the components of links before these. No link or node is collected.

    In each round a node takes the first node, in a random order, that is two links away at most, and only links between
    different labels go on. A star ends in one round; of a long chain more than half goes in each. A node with many links
    is met only by aggregates and joins that split it.
    """
    held = [cut(relabelled(links.select("a", "b"), known) if known is not None else links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")]
    labels, first = known, None
    while held[-1].limit(1).count():
        left = held[-1]
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min(ranked("b")).alias("low")).select(F.col("a").alias("b"), F.least(ranked("a"), "low").alias("low")), "labels")
        step = cut(both.join(low, "b").groupBy("a").agg(F.min("low").alias("root")).select(F.col("a").alias("node"), F.col("root.x").alias("root")), "labels")
        held += [low, step]
        if labels is None:
            labels = step
        else:
            if known is not None and first is None:
                new = step.join(known.select("node"), "node", "left_anti")  # a root of `known` is a node of it
                labels, first = known.union(new.select("node", F.col("node").alias("root"))), step
            to = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
            labels = labels.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        held.append(cut(relabelled(left, step), "links"))
    labels = labels if labels is not None else held[0].select(F.col("a").alias("node"), F.col("b").alias("root"))
    least = labels.groupBy("root").agg(F.min("node").alias("least"))
    out = cut(labels.join(least, "root").select("node", F.col("least").alias("root")), "labels")
    discard(*held)
    return out
