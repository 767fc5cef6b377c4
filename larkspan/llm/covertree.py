"""Near-duplicate vectors of one label, by dual traversal of cover trees.

A cover tree holds nested levels of centres: those below a node are within half its radius of its rows and further apart
from each other than that. Two trees are traversed together. A pair of nodes whose centres are further apart than both
covering radii and the threshold's distance has no links and is left out; one that is so near that all pairs below it
are links is counted as a whole; of any other the children are paired. So all links are found and counted, and those
within a dense group need not be made one by one: a task gives numbers of links and a spanning forest.

Distances are those of the vectors at unit length, which the cosine determines. The upper levels of the tree are a bounded
sample's; they deal the vectors of each label out into cells, with a covering radius each, and cells into blocks, with a
tree each. Pairs of blocks go through the same test before they are sent to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import cut, discard
from larkspan.llm.components import components

THRESHOLD = 0.98
#: Vectors of a block; rows of a leaf; vectors that the upper levels are fitted on; most cells of these.
BLOCK, LEAF, SAMPLE, CELLS = 4096, 8, 2048, 256
#: Bounds are loosened by this much; inner products of unit vectors are compared exactly.
SLACK, TINY = 1e-6, 1e-5
#: Centres that are tried together; numbers of a matrix of inner products; pairs of rows below two nodes that are compared without further levels.
TRIED, MATRIX, DIRECT = 256, 1 << 21, 1 << 20


def distance(s: np.ndarray) -> np.ndarray:
    """Of unit vectors with these inner products."""
    return np.sqrt(np.maximum(0, 2 - 2 * s))


def net(u: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres that are further apart than `radius`, the first row among them, and for each row a centre within it (their number)."""
    bound, owner, centres = 1 - radius * radius / 2, np.full(len(u), -1), []
    rest = np.arange(len(u))
    while len(rest):
        batch = rest[:TRIED]
        s = u[rest] @ u[batch].T
        near, covered, chosen = s[: len(batch)] >= bound, np.zeros(len(batch), bool), []
        for i in range(len(batch)):
            if not covered[i]:
                chosen.append(i)
                covered |= near[i]
        s = s[:, chosen]
        best = s.argmax(1)
        hit = s[np.arange(len(rest)), best] >= bound
        best[chosen], hit[chosen] = np.arange(len(chosen)), True
        owner[rest[hit]] = len(centres) + best[hit]
        centres += batch[chosen].tolist()
        rest = rest[~hit]
    return np.array(centres), owner


class CoverTree:
    """Nodes are runs of rows, their centre first. Of node i the children are kids[i]: first rows, covering radii, and nodes, -1 for single rows."""

    def __init__(self, u: np.ndarray):
        self.order, self.kids, self.runs = np.zeros(len(u), np.int64), [], []
        self.grow(u, np.arange(len(u)), 2.0, 0)

    def grow(self, u: np.ndarray, rows: np.ndarray, radius: float, base: int) -> int:
        at = len(self.kids)
        self.kids.append(None)
        self.runs.append((base, base + len(rows)))
        centres = [0]
        while len(rows) > LEAF and radius > TINY and len(centres) == 1:
            radius /= 2
            centres, owner = net(u[rows], radius)
        if len(centres) == 1:
            self.order[base : base + len(rows)] = rows
            self.kids[at] = np.arange(base, base + len(rows)), np.zeros(len(rows)), np.full(len(rows), -1)
            return at
        rank = np.ones(len(rows), np.int64)
        rank[centres] = 0
        by = np.lexsort((rank, owner))
        sizes = np.bincount(owner, minlength=len(centres))
        begins = np.cumsum(sizes) - sizes
        away = distance(np.einsum("ij,ij->i", u[rows[by]], u[rows[centres]][owner[by]])) + SLACK / 8
        radii, nodes = np.where(sizes > 1, np.maximum.reduceat(away, begins), 0.0), np.full(len(centres), -1)
        self.order[base : base + len(rows)] = rows[by]
        for i in np.flatnonzero(sizes > 1).tolist():
            nodes[i] = self.grow(u, rows[by[begins[i] : begins[i] + sizes[i]]], radius, base + int(begins[i]))
        self.kids[at] = base + begins, radii, nodes
        return at


def upper_cells(u: np.ndarray, most: int = CELLS) -> np.ndarray:
    """The centres of the lowest level that has `most` at most. A level's centres come first when the next one is made, so that they are in it."""
    centres, radius = np.zeros(1, np.int64), 2.0
    while radius > TINY:
        radius /= 2
        order = np.concatenate([centres, np.setdiff1d(np.arange(len(u)), centres)])
        lower = order[net(u[order], radius)[0]]
        if len(lower) > most:
            break
        centres = lower
    return u[centres]


class Side:
    """A block's unit vectors, copies and tree, and what a traversal finds of them."""

    def __init__(self, row: dict):
        self.nodes, self.n = row["nodes"], np.array(row["n"], np.int64)
        self.u = np.frombuffer(row["units"], float).reshape(len(self.n), -1)
        self.before = np.concatenate([[0], np.cumsum(self.n)])
        ends = np.array(row["ends"])
        cut_at = lambda x: np.split(np.array(x), ends[:-1])
        self.kids = list(zip(cut_at(row["kids"]), cut_at(row["radii"]), cut_at(row["below"]), strict=True))
        self.runs = list(zip(row["begins"], row["stops"], strict=True))
        self.links = np.zeros(len(self.n), np.int64)

    def children(self, node: int, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.kids[node] if node >= 0 else self.rows(node, row)

    def rows(self, node: int, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All rows of a node as its children."""
        run = np.arange(*self.run(node, row))
        return run, np.zeros(len(run)), np.full(len(run), -1)

    def run(self, node: int, row: int) -> tuple[int, int]:
        return self.runs[node] if node >= 0 else (row, row + 1)

    def weight(self, run: tuple[int, int]) -> int:
        return int(self.before[run[1]] - self.before[run[0]])


def joined(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Brings the rows i and j together, pair by pair; a root is the least row of its component."""
    while True:
        a, b = roots[i], roots[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(further := roots[roots], roots):
            roots[:] = further


def traverse(a: Side, b: Side | None, threshold: float) -> np.ndarray:
    """Counts the links of two blocks, or of one with itself (b: None), and gives the root of each row, those of b after those of a."""
    own, far = b is None, distance(np.array([threshold]))[0]
    b, shift = (a, 0) if own else (b, len(a.n))
    roots = np.arange(len(a.n) + (0 if own else len(b.n)))
    stack = [(0, 0, 0, 0)]
    while stack:
        na, ra, nb, rb = stack.pop()
        x, y = a.run(na, ra), b.run(nb, rb)
        few = (x[1] - x[0]) * (y[1] - y[0]) <= DIRECT
        rows_a, radii_a, below_a = a.rows(na, ra) if few else a.children(na, ra)
        rows_b, radii_b, below_b = b.rows(nb, rb) if few else b.children(nb, rb)
        same = own and (na, ra) == (nb, rb)
        step = max(1, MATRIX // len(rows_b))
        for at in range(0, len(rows_a), step):
            s = a.u[rows_a[at : at + step]] @ b.u[rows_b].T
            reach = radii_a[at : at + step, None] + radii_b[None, :]
            bound = np.where(reach > 0, 1 - (reach + far + SLACK) ** 2 / 2, threshold)
            i, j = np.nonzero(s >= bound)
            if same:
                keep = i + at <= j
                i, j = i[keep], j[keep]
            s, reach, i = s[i, j], reach[i, j], i + at
            single = (below_a[i] < 0) & (below_b[j] < 0)
            if same:
                single &= i != j
            x, y = rows_a[i[single]], rows_b[j[single]]
            np.add.at(a.links, x, b.n[y])
            np.add.at(b.links, y, a.n[x])
            joined(roots, x, y + shift)
            for k in np.flatnonzero(~single).tolist():
                p, q = (int(below_a[i[k]]), int(rows_a[i[k]])), (int(below_b[j[k]]), int(rows_b[j[k]]))
                if same and i[k] == j[k]:
                    if p[0] < 0:
                        continue
                    if 2 * radii_a[i[k]] <= far - SLACK:
                        run = a.run(*p)
                        a.links[run[0] : run[1]] += a.weight(run) - a.n[run[0] : run[1]]
                        joined(roots, np.arange(*run), np.full(run[1] - run[0], run[0]))
                        continue
                elif distance(s[k : k + 1])[0] + reach[k] <= far - SLACK:
                    x, y = a.run(*p), b.run(*q)
                    a.links[x[0] : x[1]] += b.weight(y)
                    b.links[y[0] : y[1]] += a.weight(x)
                    rows = np.concatenate([np.arange(*x), np.arange(*y) + shift])
                    joined(roots, rows, np.full(len(rows), rows[0]))
                    continue
                stack.append((*p, *q))
    return roots


TREE = "units binary, nodes array<binary>, n array<bigint>, ends array<int>, kids array<int>, radii array<double>, below array<int>, begins array<int>, stops array<int>"


def grown(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each block: its vectors in the order of its tree, and the tree."""

    def build(table: pa.Table) -> pa.Table:
        u = unit_rows(table["x"])
        tree = CoverTree(u)
        ends = np.cumsum([len(k[0]) for k in tree.kids])
        place = pa.array(tree.order)
        out = {k: [table[k][0].as_py()] for k in keys}
        kids, radii, below = (np.concatenate([k[c] for k in tree.kids]) for c in range(3))
        out |= {"units": [u[tree.order].tobytes()], "nodes": [table["node"].take(place).to_pylist()], "n": [table["n"].take(place).to_pylist()], "ends": [ends], "kids": [kids], "radii": [radii], "below": [below], "begins": [[r[0] for r in tree.runs]], "stops": [[r[1] for r in tree.runs]]}
        kinds = {"units": pa.binary(), "nodes": pa.list_(pa.binary()), "n": pa.list_(pa.int64()), "radii": pa.list_(pa.float64())}
        return pa.table({k: pa.array(v, table.schema.field(k).type if k in keys else kinds.get(k, pa.list_(pa.int32()))) for k, v in out.items()})

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, "x", "node", "n").groupBy(*keys).applyInArrow(build, f"{fields}, {TREE}")


def unit_rows(arrays: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Arrays of one length at unit length; scaled by the largest component first, so that no square is lost."""
    flat = arrays.combine_chunks() if isinstance(arrays, pa.ChunkedArray) else arrays
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cell_column(x: Column, centres: np.ndarray) -> Column:
    """The nearest centre of each vector, and its distance."""

    @F.arrow_udf("struct<cell: int, away: double>")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in batches:
            s = unit_rows(part) @ centres.T if len(part) else np.zeros((0, 1))
            cell = s.argmax(1)
            yield pa.StructArray.from_arrays([pa.array(cell, pa.int32()), pa.array(distance(s[np.arange(len(s)), cell]))], ["cell", "away"])

    return nearest(x)


def compared(pairs: DataFrame, threshold: float) -> DataFrame:
    """a, b, links: for each pair of blocks the links of its vectors (b: null), and links that span its components."""
    names = [f.split()[0] for f in TREE.split(", ")]
    kinds = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = {k: v[0] for k, v in batch.slice(at, 1).to_pydict().items()}
                a = Side({k: row[f"l_{k}"] for k in names})
                b = None if row["own"] else Side({k: row[f"r_{k}"] for k in names})
                roots = traverse(a, b, threshold)
                nodes, links = a.nodes + (b.nodes if b else []), np.concatenate([a.links, b.links]) if b else a.links
                linked, moved = np.flatnonzero(links), np.flatnonzero(roots != np.arange(len(roots)))
                first = [nodes[i] for i in linked] + [nodes[i] for i in moved]
                second = [None] * len(linked) + [nodes[i] for i in roots[moved]]
                counts = np.concatenate([links[linked], np.zeros(len(moved), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(counts)], schema=kinds)

    return pairs.mapInArrow(run, "a binary, b binary, links bigint")


def link(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """One row for each row of `vectors`: vec_id, n_links (other rows of its label whose cosine reaches the threshold), component_id (the least vec_id reachable by links) and kept (vec_id is component_id).

    Rows whose label is null, or whose vector is null, zero or holds null or non-finite components, link with nothing and
    are their own components. Repeated rows stay, and are links of each other. A null vec_id comes after all others; it
    is kept where its component has no other. Shorter vectors count as ones with zeros after them. An empty table gives
    no row; other columns are ignored, whatever their names. Copies of a vector are one row with a count until the end.
    """
    spark, t = vectors.sparkSession, float(distance(np.array([threshold]))[0]) + SLACK
    x = F.transform("embedding", lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    rows = vectors.select("vec_id", "label", x.alias("x"))
    fine = F.coalesce(F.col("label").isNotNull() & ~F.exists("x", bad) & F.exists("x", lambda c: c != 0), F.lit(False))
    longest = rows.where(fine).agg(F.max(F.size("x"))).first()[0] or 0
    rows = rows.withColumn("x", F.when(fine, F.concat("x", F.array_repeat(F.lit(0.0), F.lit(longest) - F.size("x")))))
    rows = rows.withColumn("node", F.when(F.col("x").isNotNull(), F.unhex(F.md5(F.concat(F.col("label").cast("string"), F.lit(":"), F.col("x").cast("string"))))))
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not longest:
        return alone
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    classes = cut(classes, "vector-classes")
    sample = classes.select("x").orderBy("node").limit(SAMPLE).collect()
    centres = upper_cells(unit_rows(pa.array([r[0] for r in sample], pa.list_(pa.float64()))), cells)
    placed = classes.withColumn("own", cell_column(F.col("x"), centres)).select("label", "x", "node", "n", "own.cell", "own.away")
    placed = cut(placed, "cells")
    size = placed.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    trees = cut(grown(placed.join(size, ["label", "cell"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), ["label", "cell", "block"]), "cover-trees")
    # pairs of blocks of a label whose cells can hold links
    radii = placed.groupBy("label", "cell").agg(F.max("away").alias("radius")).join(size, ["label", "cell"])
    parts = cut(radii.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"), "blocks")
    between = distance(centres @ centres.T)
    apart = F.broadcast(spark.createDataFrame([(i, j, float(between[i, j])) for i in range(len(centres)) for j in range(len(centres))], "l_cell int, y_cell int, apart double"))  # cells squared at most
    left, right = (parts.select(*(F.col(c).alias(f"{s}_{c}") for c in parts.columns)) for s in "lr")
    pairs = left.join(apart, "l_cell").join(right, (F.col("l_label") == F.col("r_label")) & (F.col("y_cell") == F.col("r_cell")) & (F.struct("l_cell", "l_block") <= F.struct(F.col("r_cell").alias("l_cell"), F.col("r_block").alias("l_block"))))
    own = (F.col("l_cell") == F.col("r_cell")) & (F.col("l_block") == F.col("r_block"))
    pairs = pairs.where(own | (F.col("apart") <= F.col("l_radius") + F.col("r_radius") + t)).select("l_label", "l_cell", "l_block", "r_cell", "r_block", own.alias("own"))
    pairs = cut(pairs, "block-pairs")
    left, right = (trees.select(*(F.col(c).alias(f"{s}_{c}") for c in trees.columns)) for s in "lr")
    # both trees of a block that meets itself are one
    full = pairs.join(left, ["l_label", "l_cell", "l_block"])
    both = full.where("NOT own").join(right.withColumnRenamed("r_label", "l_label"), ["l_label", "r_cell", "r_block"])
    found = cut(compared(full.where("own").unionByName(both, allowMissingColumns=True), threshold), "vector-links")

    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    spans = cut(found.where("b IS NOT NULL").select("a", "b"), "spans")
    roots = cut(components(spans), "roots")
    known = classes.select("node", "n", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut(known.join(least, "root").join(counts, "node", "left").select("node", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "linked")
    out = cut(rows.where("node IS NOT NULL").select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")).union(alone), "embedding-classes")
    discard(classes, placed, trees, parts, pairs, found, spans, roots, known)
    return out


def oracle() -> str:
    """The registered query in DuckDB SQL, for unique ids."""
    return """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a"""
