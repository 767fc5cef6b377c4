"""Hard negatives by a vantage-point tree.

The largest inner product becomes the least distance by one more coordinate, which lifts all vectors to the largest norm;
an anchor gets 0 there. A window of scores is then an annulus around the anchor: from the distance of its highest score
to that of its lowest. A tree over the lifted vectors splits rows by their distance from a vantage point; the bounds of
these distances say how near and how far the rows below a node can be. Leaves inside the annulus are visited nearest
first, until the rows sought are found and no other leaf can hold a nearer one.

The upper levels of the tree are fitted on a bounded sample and deal all rows out to its leaves, so that an anchor goes
only to those that its annuli reach; the rows of a leaf are cut into blocks, each with a tree of its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.common import cut, discard

#: Rows of a leaf of a block's tree; vectors of a block; anchors that meet a block together.
LEAF, BLOCK, ANCHORS = 128, 16_384, 8192
#: Vectors that the upper levels are fitted on, and how many levels there are at most.
SAMPLE, DEPTH = 8192, 8
#: Bounds are loosened by this share of the norms; scores themselves are compared exactly.
SLACK = 1e-6


class Tree:
    """A vantage-point tree over rows of one length (lifted vectors). Row i of `rows` is row order[i] of x; leaves are runs of these."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, depth: int = 64):
        self.order, self.nodes = np.arange(len(x)), []
        norms = np.einsum("ij,ij->i", x, x)
        todo = [(0, len(x), depth, None)]
        while todo:
            a, b, left, place = todo.pop()
            at = len(self.nodes)
            if place is not None:
                self.nodes[place[0]][place[1]] = at
            if b - a <= leaf or not left:
                self.nodes.append([a, b, None])
                continue
            own = self.order[a:b]
            v = own[0]
            d = np.sqrt(np.maximum(0, norms[own] + norms[v] - 2 * (x[own] @ x[v])))
            mid = (b - a) // 2
            near = np.argpartition(d, mid)
            self.order[a:b], d = own[near], d[near]
            self.nodes.append([a, b, x[v], norms[v], (d[:mid].min(), d[:mid].max()), (d[mid:].min(), d[mid:].max()), 0, 0])
            todo += [(a, a + mid, left - 1, (at, 6)), (a + mid, b, left - 1, (at, 7))]
        self.rows = x[self.order]

    def leaves(self, q: np.ndarray, inner: float, outer: float, slack: float) -> Iterator[tuple[int, int]]:
        """The runs of rows that may lie from `inner` to `outer` of q, nearest first. A number sent back becomes `outer`."""
        norm, heap = float(q @ q), [(0.0, 0)]
        while heap:
            low, at = heapq.heappop(heap)
            if low > outer + slack:
                return
            node = self.nodes[at]
            if node[2] is None:
                got = yield node[0], node[1]
                outer = outer if got is None else min(outer, got)
                continue
            d = max(0.0, norm + node[3] - 2 * float(q @ node[2])) ** 0.5
            for (least, most), child in zip(node[4:6], node[6:8], strict=True):
                near = max(low, d - most, least - d)
                if near <= outer + slack and d + most >= inner - slack:
                    heapq.heappush(heap, (near, child))

    def deal(self, x: np.ndarray) -> np.ndarray:
        """The leaf (its place among the nodes) of each row, also of rows that the tree wasn't fitted on."""
        out, todo = np.zeros(len(x), np.int32), [(0, np.arange(len(x)))]
        norms = np.einsum("ij,ij->i", x, x)
        while todo:
            at, own = todo.pop()
            node = self.nodes[at]
            if node[2] is None or not len(own):
                out[own] = at
                continue
            inside = norms[own] + node[3] - 2 * (x[own] @ node[2]) <= node[4][1] ** 2
            todo += [(node[6], own[inside]), (node[7], own[~inside])]
        return out

    def reached(self, q: np.ndarray, annuli: list[tuple[float, float]], slack: float) -> list[int]:
        """The leaves of deal() that an annulus around q can reach. Beyond the sample only the split radius is a bound."""
        norm, out, todo = float(q @ q), [], [0]
        while todo:
            node = self.nodes[at := todo.pop()]
            if node[2] is None:
                out.append(at)
                continue
            d, r = max(0.0, norm + node[3] - 2 * float(q @ node[2])) ** 0.5, node[4][1]
            if any(d - r <= outer + slack and d + r >= inner - slack for inner, outer in annuli):
                todo.append(node[6])
            if any(r - d <= outer + slack for _, outer in annuli):
                todo.append(node[7])
        return out


class Finder:
    """The lifted vectors of a block with their labels and ids, asked for the first rows of a window of scores."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ids: list[list[int]], top: float):
        self.top = top
        self.tree = Tree(lifted(x, top))
        self.x, self.labels, self.ids = x[self.tree.order], labels[self.tree.order], [ids[i] for i in self.tree.order]

    def first(self, anchor: np.ndarray, own: int, label: int, same: bool, low: float, high: float, k: int) -> list[tuple[int, int]]:
        """(score, id) of the first k rows of the anchor's label (or, if not `same`, of other labels) with low <= score <= high, without the id `own`."""
        q, norm = np.append(anchor, 0.0), float(anchor @ anchor)
        away = lambda s: max(0.0, norm + self.top - 2 * s) ** 0.5
        walk = self.tree.leaves(q, 0.0 if high == inf else away(high), inf if low == -inf else away(low), SLACK * (1 + norm**0.5 + self.top**0.5))
        best: list[tuple[int, int]] = []
        run = next(walk, None)
        while run:
            a, b = run
            scores = self.x[a:b] @ anchor
            hit = (scores >= (low if len(best) < k else -best[-1][0])) & (scores <= high) & ((self.labels[a:b] == label) == same)
            for i in np.flatnonzero(hit).tolist():
                best += [(-int(scores[i]), n) for n in self.ids[a + i] if n != own]
            best = sorted(best)[:k]
            try:
                run = walk.send(away(-best[-1][0]) if len(best) == k else None)
            except StopIteration:
                break
        return [(-s, i) for s, i in best]


def matrix(arrays: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length, which may be 0, as rows."""
    flat = arrays.combine_chunks() if isinstance(arrays, pa.ChunkedArray) else arrays
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), len(flat[0]) if len(flat) else 0)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(0, top - np.einsum("ij,ij->i", x, x)))])


def whole_rows(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label, v: distinct rows without nulls whose components are all finite, as whole numbers, with zeros after shorter vectors."""
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.transform("embedding", lambda c: c.cast("double")).alias("v"))
    rows = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))).withColumn("v", F.transform("v", lambda c: F.floor(c * scale).cast("double")))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("v")))).distinct()


def in_blocks(table: DataFrame, keys: list[str], size: int, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a block of about `size` rows of their key each, and how many blocks a key has."""
    number = table.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias(f"{name}_n"))
    own = F.pmod(F.xxhash64("v", "label"), F.col(f"{name}_n")).cast("int")
    return table.join(number, keys).withColumn(name, own).drop(f"{name}_n"), number


def meet(rows: DataFrame, anchors: DataFrame, keys: list[str], block: int, size: int) -> tuple[DataFrame, DataFrame]:
    """Both sides in blocks of their keys, each row copied to every block of the other side."""
    rows, row_blocks = in_blocks(rows, keys, block, "b")
    anchors, anchor_blocks = in_blocks(anchors, keys, size, "q")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    return rows.join(anchor_blocks, keys).withColumn("q", each("q_n")).drop("q_n"), anchors.join(row_blocks, keys).withColumn("b", each("b_n")).drop("b_n")


def found(rows: DataFrame, anchors: DataFrame, keys: list[str], top: float, same: bool, k: int, low: int, block: int, size: int) -> DataFrame:
    """key, positive_score, score, id: the first k rows that each anchor finds in each block, in all or in the windows below its `scores`."""
    left, right = meet(rows, anchors, keys, block, size)
    kinds = pa.schema([("key", pa.int64()), ("anchor_id", pa.int64()), ("positive_score", pa.int64()), ("score", pa.int64()), ("id", pa.int64())])

    def search(own: pa.Table, asked: pa.Table) -> pa.Table:
        hits: list[tuple] = []
        if len(own) and len(asked):
            finder = Finder(matrix(own["v"]), own["label"].to_numpy(), own["ids"].to_pylist(), top)
            windows = asked["scores"].to_pylist() if not same else [None] * len(asked)
            for key, anchor, label, v, scores in zip(asked["key"].to_pylist(), asked["vec_id"].to_pylist(), asked["label"].to_pylist(), matrix(asked["v"]), windows, strict=True):
                for p in (None,) if same else scores:
                    least, most = (-inf, inf) if same else (-(-low * p // 100), p)
                    hits += [(key, anchor, p, s, i) for s, i in finder.first(v, anchor, label, same, least, most, k)]
        return pa.table([pa.array([h[c] for h in hits], f.type) for c, f in enumerate(kinds)], schema=kinds)

    group = [*keys, "b", "q"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(search, "key bigint, anchor_id bigint, positive_score bigint, score bigint, id bigint")


def leaf_column(v: Column, tree: Tree, top: float) -> Column:
    """The leaf of the upper levels that each row belongs to."""

    @F.arrow_udf("int")
    def leaf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for x in batches:
            yield pa.array(tree.deal(lifted(matrix(x), top)), pa.int32())

    return leaf(v)


def reached_column(v: Column, scores: Column, tree: Tree, top: float, low: int) -> Column:
    """The leaves that an anchor's windows reach."""

    @F.arrow_udf("array<int>")
    def leaves(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for x, own in batches:
            out = []
            for q, ps in zip(matrix(x), own.to_pylist(), strict=True):
                norm = float(q @ q)
                away = lambda s: max(0.0, norm + top - 2 * s) ** 0.5  # noqa: B023, E731
                out.append(tree.reached(np.append(q, 0.0), [(away(p), away(-(-low * p // 100))) for p in ps], SLACK * (1 + norm**0.5 + top**0.5)))
            yield pa.array(out, pa.list_(pa.int32()))

    return leaves(v, scores)


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, k: int = 5, low: int = 80, scale: int = 256, block: int = BLOCK, anchors: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score: hard negatives of the rows whose vec_id is divisible by `every`.

    A component x counts as floor(scale * x); a score is the inner product of two rows, and higher ones come first, ties
    by the smaller vec_id. An anchor's positives are its first other rows of the same label. For each of them its first k
    rows of other labels come whose score is at most the positive's, and at least `low` hundredths of it. A positive score
    under 0 has no such window.

    Rows with a null vec_id, label, vector or component, or a component that isn't finite, take no part; a zero vector
    does. A shorter vector counts as one with zeros after it. Repeated rows count once; an id with several rows is several
    rows and anchors, none of which is found for an anchor of that id. An empty table gives no row; other columns are
    ignored, whatever their names. Scores must stay within the whole numbers of a double, else an error says so.
    """
    spark = vectors.sparkSession
    rows = cut(whole_rows(vectors, scale), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    stats = rows.agg(F.max(norm).alias("top"), F.count(F.lit(1)).alias("n")).first()
    if not stats["n"]:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    top = stats["top"]
    if top >= 1 << 53:
        raise ValueError(f"a squared norm of {top}: use a smaller scale")
    # of equal rows no others can be among the first ones found
    least = max(positives, k) + 1
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("v", "label").orderBy("vec_id"))).where(F.col("rank") <= least)
    classes = cut(ranked.groupBy("v", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "vector-classes")
    asked = cut(rows.where(F.col("vec_id") % every == 0).withColumn("key", F.xxhash64("vec_id", "label", "v")), "anchors")

    near = found(classes, asked, ["label"], top, True, positives, low, block, anchors)
    rank = F.row_number().over(Window.partitionBy("key", "anchor_id").orderBy(F.desc("score"), "id"))
    near = cut(near.withColumn("n", rank).where(F.col("n") <= positives).select("key", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    windows = near.where("positive_score >= 0").groupBy("key", "anchor_id").agg(F.collect_set("positive_score").alias("scores"))
    asked_again = cut(asked.join(windows.withColumnRenamed("anchor_id", "vec_id"), ["key", "vec_id"]), "windows")
    count = classes.count()
    depth = min(DEPTH, max(0, (count - 1) // block).bit_length())
    sample = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE if depth else 1).collect()
    upper = Tree(lifted(np.array([r[0] for r in sample], float).reshape(len(sample), -1), top), 1, depth)  # 2 ** DEPTH vantage points at most
    dealt = classes.withColumn("leaf", leaf_column(F.col("v"), upper, top))
    sent = asked_again.withColumn("leaf", F.explode(reached_column(F.col("v"), F.col("scores"), upper, top, low)))
    far = found(dealt, sent, ["leaf"], top, False, k, low, block, anchors)
    rank = F.row_number().over(Window.partitionBy("key", "anchor_id", "positive_score").orderBy(F.desc("score"), "id"))
    far = far.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    out = near.join(far, ["key", "anchor_id", "positive_score"])
    out = cut(out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-negatives")
    discard(rows, classes, asked, near, asked_again)
    return out


def oracle() -> str:
    """The registered query in DuckDB SQL."""
    return """WITH r AS (SELECT DISTINCT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, s.b AS n, p.score AS ps, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT a AS anchor_id, p AS positive_id, rank::INT AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE rank <= 5"""
