"""Approximate nearest neighbours by a permutation index.

Each distinct vector is represented by its nearest pivots in order. Blocks of the index post them in inverted files, one
for each pivot, which say for each vector of the block how early it names the pivot, if it does so among its first
PREFIX: a byte each, as a fourth of the vectors are posted in each file. A query adds up the files of its own first
pivots to the footrule distance of the two orders; the nearest of a block by that distance are reranked by the exact
inner product. The largest inner product becomes the least distance by one more coordinate, which lifts all vectors to
the largest norm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.common import cut, discard

#: Of a block of n vectors, LEAST + SHARE * n are reranked for a query. PREFIX is 127 at most.
PIVOTS, PREFIX, SHARE, LEAST = 256, 64, 0.06, 256
#: Vectors in a block of the index, and queries in a block of these.
BLOCK, QUERIES = 8192, 4096


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and x, an array<double>: without null ids, and vectors that are null, zero or have null or non-finite components."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where(~bad & F.exists("x", lambda v: v != 0)).distinct()


def as_long(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with zeros after shorter vectors, which change no inner product, and the longest length; 0 without rows."""
    longest = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("x")))).distinct(), longest


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """x and its k + 1 least ids, ascending: no other copy can be among the k nearest of a query."""
    rank = F.row_number().over(Window.partitionBy("x").orderBy("vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def orders(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The first `prefix` pivots of each vector, nearest first. The last column of pivots is their own lift."""
    near = x @ pivots[:, :-1].T + lift[:, None] * pivots[:, -1]
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


class Block:
    """Some distinct vectors, by their least ids, and their inverted files."""

    def __init__(self, x: np.ndarray, ids: list[list[int]], first: np.ndarray, pivots: int):
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        x, ids, first = x[order], [ids[i] for i in order], first[order]
        self.x, self.ids, self.n, self.prefix = x, ids, len(x), first.shape[1]
        self.files = np.zeros((pivots, self.n), np.int8)
        self.files[first, np.arange(self.n)[:, None]] = np.arange(self.prefix, 0, -1)

    def search(self, query: np.ndarray, own: int, first: np.ndarray, k: int, share: float, least: int) -> list[tuple[float, int]]:
        """(score, id) of the k nearest found, without the query's own id. Of a footrule distance, what shared pivots save counts."""
        saved = np.zeros(self.n, np.int16)
        for weight, p in zip(range(self.prefix, 0, -1), first.tolist()):
            saved += np.minimum(self.files[p], np.int8(weight))
        most = least + int(self.n * share)
        got = np.arange(self.n)
        if most < self.n:
            # of rows as near as the last that is reranked, those of the smaller ids, in whatever order the block came
            last = np.partition(saved, self.n - most)[self.n - most]
            nearer = np.flatnonzero(saved > last)
            got = np.concatenate([nearer, np.flatnonzero(saved == last)[: most - len(nearer)]])
        scores = (self.x[got] * query).sum(1)
        if len(got) > k + 1:
            keep = scores >= np.partition(scores, -(k + 1))[-(k + 1)]  # one more: the query's own may be among them
            got, scores = got[keep], scores[keep]
        return sorted(((float(s), i) for s, g in zip(scores, got, strict=True) for i in self.ids[g] if i != own), key=lambda x: (-x[0], x[1]))[:k]


def matrix(arrays: pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length as rows."""
    return arrays.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(arrays), -1)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, pivots: int = PIVOTS, prefix: int = PREFIX, share: float = SHARE, least: int = LEAST, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each row whose id is divisible by `every`, by the largest inner product.

    All other rows are candidates; ties go to the smaller id. Vectors that are null, zero or have null or non-finite
    components take no part; a shorter vector counts as one with zeros after it. An id with several vectors is several
    rows; none of them is found for a query of that id. An empty table gives no row; other columns are ignored, whatever
    their names. The pivots are a bounded sample, the first vectors by a hash; every vector is indexed.

    Each pair of a block of vectors and a block of queries is a group of its own, so that no task holds more than both.
    """
    spark = vectors.sparkSession
    rows, longest = as_long(valid(vectors))
    if not longest:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = cut(rows, "vectors")
    classes = cut(distinct_vectors(rows, k).withColumn("norm", F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)), "vector-classes")
    stats = classes.agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).first()
    n, top = stats["n"], stats["top"]
    chosen = classes.select("x", "norm").orderBy(F.xxhash64("x"), "x").limit(pivots).collect()
    table = np.array([[*r["x"], max(0.0, top - r["norm"]) ** 0.5] for r in chosen])
    prefix = min(prefix, len(table))
    held = spark.sparkContext.broadcast(table)  # `pivots` rows
    asked = rows.where(F.col("vec_id") % every == 0)
    v_blocks, q_blocks = max(1, -(-n // block)), max(1, -(-asked.count() // queries))

    def to(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    vector_rows = classes.select("x", "ids", "norm", F.pmod(F.xxhash64("x"), F.lit(v_blocks)).cast("int").alias("v")).withColumn("q", to(q_blocks))
    query_rows = asked.select("vec_id", "x", F.pmod(F.xxhash64("vec_id", "x"), F.lit(q_blocks)).cast("int").alias("q")).withColumn("v", to(v_blocks))
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(own: pa.Table, others: pa.Table) -> pa.Table:
        hits: list[tuple[int, int, float]] = []
        if len(own) and len(others):
            x, y = matrix(own["x"]), matrix(others["x"])
            files = Block(x, own["ids"].to_pylist(), orders(x, np.sqrt(np.maximum(0, top - own["norm"].to_numpy())), held.value, prefix), len(held.value))
            firsts = orders(y, np.zeros(len(y)), held.value, prefix)
            for q, v, f in zip(others["vec_id"].to_pylist(), y, firsts, strict=True):
                hits += [(q, i, s) for s, i in files.search(v, q, f, k, share, least)]
        return pa.table([pa.array([h[c] for h in hits], f.type) for c, f in enumerate(kinds)], schema=kinds)

    found = vector_rows.groupBy("v", "q").cogroup(query_rows.groupBy("v", "q")).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = cut(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "neighbours")
    discard(rows, classes)
    return out
