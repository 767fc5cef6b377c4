"""Transitive closure of a table of links, by ways of doubled length between chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan.operators.shared import discard, written

#: Nodes of a chain's block, so that a pair of blocks stands for a million pairs; pairs of blocks a task; tasks at most.
BLOCK, TASK, TASKS = 1024, 16, 10_000


def transitive_closure(links: DataFrame, a: str, b: str, rounds: int | None = None) -> DataFrame:
    """a, b: all distinct pairs such that links lead from a to b, in at most `rounds` links if that is given.

    Nodes between which there is only one way on and one way back are a chain: its members reach those behind them, and
    all that its end reaches. So the closure is found between chains, and pairs of members are spread from pairs of
    blocks when the result is read; they are never written or shuffled. Chains are found in as many rounds as the longest
    has digits of base four. Rings of which nothing leads away are found as well.

    Between chains, pairs keep the length of their shortest way. When all up to some length are known, those of just that
    length are joined with all known ones: what is new is up to twice as long. So there are as many rounds as the longest
    of the shortest ways has binary digits. Each round's new pairs are written, so that the lineage ends there; the hot
    end of a join is split by adaptive execution, as both sides are written tables. With `rounds`, which counts single
    links, and for nodes in no chain, it is these pairs that take disk.

    A cycle ends by itself, and its members lead to themselves. Links with a null are left out.
    """
    kept = links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("x"), F.col(b).alias("y"))
    if rounds is not None:
        out = _by_length(kept, rounds)
    else:
        common = kept.select("x").union(kept.select("y")).schema[0].dataType
        out = _by_chains(written(kept.select(F.col("x").cast(common), F.col("y").cast(common)).distinct(), "edges"))
    return out.select(*(F.col(c).cast(kept.schema[c].dataType).alias(name) for c, name in (("x", a), ("y", b))))


def _by_length(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """x, y: the closure by ways of doubled length."""
    edges = links.select("x", "y", F.lit(1).cast("bigint").alias("n")).distinct()
    found, length = [written(edges, "edges")], 1
    while rounds is None or length < rounds:
        known = reduce(DataFrame.union, found)
        # ways of just this length are among the last round's pairs
        ends = found[-1].where(F.col("n") == length).select("x", F.col("y").alias("via"))
        reached = ends.join(known.select(F.col("x").alias("via"), "y", "n"), "via").select("x", "y", (F.col("n") + length).alias("n"))
        new = known.unionByName(reached).groupBy("x", "y").agg(F.min("n").alias("n")).where(F.col("n") > length)
        delta = written(new if rounds is None else new.where(F.col("n") <= rounds), "delta")
        if not delta.limit(1).count():
            break
        found.append(delta)
        length *= 2
    return reduce(DataFrame.union, found).select("x", "y")


def _by_chains(edges: DataFrame) -> DataFrame:
    """x, y: the closure of a written table of distinct links, by chains."""
    ways, rings = _ways(edges)
    members = ways.count()
    if not members:
        return _by_length(edges)
    # done, `up` is the head and n the place behind it; a row of a ring has the least of the ring
    heads = ways.where("done AND n = 1").select(F.col("up").alias("node"), F.col("up").alias("chain"), F.lit(0).cast("bigint").alias("at"))
    own = heads.unionByName(ways.where("done").select("node", F.col("up").alias("chain"), F.col("n").alias("at"))).withColumn("block", F.expr(f"at div {BLOCK}"))
    if rings:
        ring = ways.where("NOT done").select("node", F.col("low").alias("chain"), F.lit(0).cast("bigint").alias("at"))
        ring = ring.join(ring.groupBy("chain").agg(F.count("*").alias("size")), "chain")
        own = own.unionByName(ring.select("node", "chain", "at", F.expr(f"pmod(xxhash64(node), 1 + size div {BLOCK})").alias("block")))
    blocks = own.groupBy("chain", "block").agg(F.sort_array(F.collect_list(F.struct("at", "node"))).getField("node").alias("nodes"))
    blocks = written(blocks, "blocks")
    spans = blocks.join(blocks.groupBy("chain").agg(F.max("block").alias("last")), "chain")
    if not rings and edges.count() == members:
        return _spread(_within(spans, blocks))
    # a link into a chain leads to its head, one out of it comes from its end
    between = edges.join(ways.select(F.col("node").alias("y")), "y", "left_anti").join(ways.select(F.col("node").alias("x"), "up"), "x", "left")
    between = between.select(F.coalesce("up", "x").alias("x"), "y").union(ways.where("NOT done").select("low", "low").distinct())
    reach = _by_length(between)
    # who reaches itself reaches all of its chain
    within = _within(spans.join(reach.where("x = y").select(F.col("x").alias("chain")), "chain", "left_anti"), blocks)
    pairs = reach.join(blocks.select(F.col("chain").alias("x"), F.col("nodes").alias("xs")), "x", "left").join(blocks.select(F.col("chain").alias("y"), F.col("nodes").alias("ys")), "y", "left")
    single = F.col("xs").isNull() & F.col("ys").isNull()
    across = pairs.where(~single).select(F.coalesce("xs", F.array("x")).alias("xs"), F.coalesce("ys", F.array("y")).alias("ys"), F.lit(False).alias("same"))
    return pairs.where(single).select("x", "y").union(_spread(within.unionByName(across)))


def _ways(edges: DataFrame) -> tuple[DataFrame, int]:
    """Of each member of a chain but its head the way back, written: node, up (the head, once done), n links, the least node before up; and how many are in rings, which have no head."""
    on = edges.groupBy("x").agg(F.count("*").alias("k"), F.first("y").alias("y")).where("k = 1").select("x", "y")
    back = edges.groupBy("y").agg(F.count("*").alias("k"), F.first("x").alias("x")).where("k = 1").select("x", "y")
    inner = on.join(back, ["x", "y"]).where(F.col("x") != F.col("y"))
    inner = inner.join(inner.select(F.col("y").alias("x"), F.lit(False).alias("done")), "x", "left")
    one = F.lit(1).cast("bigint").alias("n")
    ways = written(inner.select(F.col("y").alias("node"), F.col("x").alias("up"), one, F.col("y").alias("low"), F.coalesce("done", F.lit(True)).alias("done")), "ways")
    length, before = 1, -1
    # each round ends some way of a chain; when none ends, the rest go round, and have been all around at this length
    while (left := ways.where("NOT done").count()) and not (left == before and length >= left):
        old, ways = ways, written(_jump(_jump(ways)), "ways")
        discard(old)
        length, before = length * 4, left
    return ways, left


def _jump(ways: DataFrame) -> DataFrame:
    """Ways that have not come to a head go on by that of the node where they are."""
    further = ways.select(F.col("node").alias("up"), F.col("up").alias("to"), F.col("n").alias("more"), F.col("low").alias("lower"), F.col("done").alias("ends"))
    longer = ways.where("NOT done").join(further, "up")
    return ways.where("done").unionByName(longer.select("node", F.col("to").alias("up"), (F.col("n") + F.col("more")).alias("n"), F.least("low", "lower").alias("low"), F.col("ends").alias("done")))


def _within(spans: DataFrame, blocks: DataFrame) -> DataFrame:
    """xs, ys, same: each block of a chain with itself and those behind it."""
    first = spans.select("chain", "block", F.col("nodes").alias("xs"), F.explode(F.sequence("block", "last")).alias("to"))
    pairs = first.join(blocks.select("chain", F.col("block").alias("to"), F.col("nodes").alias("ys")), ["chain", "to"])
    return pairs.select("xs", "ys", (F.col("block") == F.col("to")).alias("same"))


def _spread(pairs: DataFrame) -> DataFrame:
    """x, y: all pairs of two blocks, of one and the same only those in its order; dealt out, as a pair of blocks is small and its pairs are many."""
    dealt = pairs.repartition(min(TASKS, 1 + pairs.count() // TASK))
    rows = dealt.select("ys", "same", F.posexplode("xs").alias("p", "x"))
    return rows.select("x", F.explode(F.when(F.col("same"), F.slice("ys", F.col("p") + 2, F.size("ys"))).otherwise(F.col("ys"))).alias("y"))
