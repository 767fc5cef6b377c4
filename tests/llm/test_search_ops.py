"""Hard negatives, vector near-dedup and ranked search against brute force, and their edge cases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from math import floor, inf, log, nan

import duckdb
import numpy as np
import pytest

from larkspan.llm import covertree, tput, vptree
from larkspan.llm.queries import ORACLES, QUERIES

SF01 = "/root/testdata/sf0.01"
NAMES = ["op11_hard_negatives", "op12_embedding_dedup", "op13_ranked_search"]
VECTORS = "vec_id bigint, label int, embedding array<float>"


@pytest.mark.parametrize("name", NAMES)
def test_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF01).select(*want.columns)
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall()) and got.count()


def crowd(seed, n, dims=8, groups=4, spread=0.03):
    """Vectors of which half stand close to a few others, with copies."""
    rng = np.random.default_rng(seed)
    base, x = rng.normal(size=(groups, dims)), rng.normal(size=(n, dims))
    near = rng.random(n) < 0.5
    x[near] = base[rng.integers(0, groups, near.sum())] + rng.normal(size=(near.sum(), dims)) * spread
    x[rng.integers(0, n, n // 10)] = x[0]
    return x.astype(np.float32)


def odd(spark, rows):
    return spark.createDataFrame(rows, VECTORS).selectExpr("*", "vec_id AS node", "label AS v", "1 AS score", "'x' AS rank", "embedding AS x", "2 AS cell")


# op11


def plain_negatives(rows, every, positives, k, low):
    v = {(i, label, tuple(floor(256 * float(c)) for c in x)) for i, label, x in rows}
    out = Counter()
    for a, label, x in v:
        if a % every:
            continue
        score = lambda y: sum(p * q for p, q in zip(x, y))  # noqa: B023, E731
        others = sorted((-score(y), i, other) for i, other, y in v if i != a)
        for s, p in [(-s, i) for s, i, other in others if other == label][:positives]:
            hits = [(-t, i) for t, i, other in others if other != label and low * s <= 100 * -t <= 100 * s][:k]
            out.update((a, p, n, i, s, t) for n, (t, i) in enumerate(hits, 1))
    return out


@pytest.mark.parametrize(("block", "anchors"), [(16_384, 8192), (40, 7)])
def test_negatives_equal_brute_force(spark, block, anchors):
    rows = [(i, i % 3, x.tolist()) for i, x in enumerate(crowd(1, 300))]
    got = vptree.mine(odd(spark, rows), every=10, block=block, anchors=anchors)
    want = plain_negatives(rows, 10, 5, 5, 80)
    order = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == order and Counter(map(tuple, got.collect())) == want and want


@pytest.mark.parametrize("seed", range(4))
def test_tree_visits_nearest_first(seed):
    x = crowd(seed, 500).astype(float)
    top = float(np.einsum("ij,ij->i", x, x).max())
    lift = vptree.lifted(x, top)
    tree, q = vptree.Tree(lift, 16), np.append(x[3], 0.0)
    d = np.sqrt(((tree.rows - q) ** 2).sum(1))
    inner, outer = np.quantile(d, [0.2, 0.5])
    runs = list(tree.leaves(q, inner, outer, 1e-9))
    inside = {i for i in range(500) if inner <= d[i] <= outer}
    assert inside <= {i for a, b in runs for i in range(a, b)} and sorted(tree.order.tolist()) == list(range(500))
    assert len(runs) < len([n for n in tree.nodes if n[2] is None])
    # leaves of the upper levels: every row that an annulus holds lies in one that it reaches
    upper = vptree.Tree(lift[:200], 1, 4)
    leaf, reached = upper.deal(lift), set(upper.reached(q, [(inner, outer)], 1e-9))
    apart = np.sqrt(((lift - q) ** 2).sum(1))
    assert {int(leaf[i]) for i in range(500) if inner <= apart[i] <= outer} <= reached


def test_negative_edges(spark):
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.5]), (3, 2, [0.9]), (4, 1, [0.0, 0.0]), (1, 1, [1.0, 0.0])]
    bad = [(None, 1, [1.0, 0.0]), (5, None, [1.0, 0.0]), (6, 1, None), (7, 2, [nan, 1.0]), (8, 2, [inf, 1.0]), (9, 2, [None, 1.0])]
    got = Counter(map(tuple, vptree.mine(odd(spark, good + bad)).collect()))
    # the zero vector is a positive of score 0, and no other row has that score
    assert got == Counter({(0, 1, 1, 2, 65536, 58880): 1, (0, 1, 2, 3, 65536, 58880): 1})
    assert vptree.mine(odd(spark, bad)).count() == 0 and vptree.mine(odd(spark, [])).count() == 0
    assert vptree.mine(odd(spark, [(0, 1, []), (1, 1, []), (2, 2, [])])).count() == 1  # all scores are 0
    with pytest.raises(ValueError, match="scale"):
        vptree.mine(odd(spark, [(0, 1, [3e38])]))


# op12


def plain_classes(rows, threshold):
    fine = [(n, i, label, np.array(x, float)) for n, (i, label, x) in enumerate(rows) if label is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    links, above = defaultdict(int), list(range(len(rows)))

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, (m, _, p, x) in enumerate(fine):
        for n, _, q, y in fine[a + 1 :]:
            if p == q and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[m] += 1
                links[n] += 1
                above[top(m)] = top(n)
    least = {}
    for n, (i, _, _) in enumerate(rows):
        if i is not None:
            least[top(n)] = min(i, least.get(top(n), i))
    return Counter((i, links[n], least.get(top(n)), i == least.get(top(n))) for n, (i, _, _) in enumerate(rows))


@pytest.mark.parametrize(("block", "cells"), [(4096, 256), (30, 256), (30, 1), (500, 6)])
def test_classes_equal_brute_force(spark, block, cells):
    rows = [(i, i % 2, x.tolist()) for i, x in enumerate(crowd(2, 400))]
    got = covertree.link(odd(spark, rows), 0.98, block, cells)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == plain_classes(rows, 0.98)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("spread", [0.001, 0.03, 0.1])
def test_dual_traversal(seed, spread):
    x = crowd(seed, 600, spread=spread).astype(float)
    u = np.unique(x / np.sqrt((x * x).sum(1))[:, None], axis=0)
    n = np.random.default_rng(seed).integers(1, 4, len(u))

    def side(u, n):
        tree = covertree.CoverTree(u)
        kids, radii, below = (np.concatenate([k[c] for k in tree.kids]) for c in range(3))
        return covertree.Side({"nodes": tree.order.tolist(), "n": n[tree.order], "units": u[tree.order].tobytes(), "ends": np.cumsum([len(k[0]) for k in tree.kids]), "kids": kids, "radii": radii, "below": below, "begins": [r[0] for r in tree.runs], "stops": [r[1] for r in tree.runs]}), tree

    a, tree = side(u, n)
    covertree.traverse(a, None, 0.98)
    near = a.u @ a.u.T >= 0.98
    np.fill_diagonal(near, False)
    assert (a.links == near @ a.n).all()
    for (rows, radii, _), (begin, end) in zip(tree.kids, tree.runs, strict=True):
        ends = [*rows[1:].tolist(), end]
        assert rows[0] == begin  # nested: a node's centre is its first child's
        for row, radius, stop in zip(rows.tolist(), radii.tolist(), ends, strict=True):
            assert (np.sqrt(np.maximum(0, 2 - 2 * a.u[row:stop] @ a.u[row])) <= radius + 1e-7).all()
    half = len(u) // 2
    (b, _), (c, _) = side(u[:half], n[:half]), side(u[half:], n[half:])
    covertree.traverse(b, c, 0.98)
    near = b.u @ c.u.T >= 0.98
    assert (b.links == near @ c.n).all() and (c.links == near.T @ b.n).all()


def test_class_edges(spark):
    rows = [(1, 1, [1.0, 0.0]), (2, 1, [2.0]), (2, 1, [2.0]), (3, 2, [1.0, 0.0]), (None, 2, [1.0, 0.01]), (None, 3, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 1, None), (6, 1, [0.0, 0.0]), (7, 1, [nan, 1.0]), (8, 1, [1.0, None]), (9, 1, []), (10, 1, [1e30, 1e-30]), (11, 4, [1e-30, 0.0])]
    got = Counter(map(tuple, covertree.link(odd(spark, rows)).collect()))
    want = plain_classes([(i, label, x and [c / 2e29 if c and c == 1e30 else c for c in x] + [0.0] * (2 - len(x))) for i, label, x in rows], 0.98)
    assert got == Counter({(i, n, c, True if i is None and c is None else k): m for (i, n, c, k), m in want.items()})
    assert covertree.link(odd(spark, [])).count() == 0
    assert list(map(tuple, covertree.link(odd(spark, [(1, 1, None)])).collect())) == [(1, 0, 1, True)]


# op13


def plain_ranks(docs, items, k):
    split = lambda s: re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))
    own = [(i, Counter(split(t))) for i, t in docs]
    n, length = sum(1 for _, c in own if c), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = Counter()
    for item, text in set(items):
        scores = []
        for i, c in own:
            m = 25 + (75 * sum(c.values()) * n) // max(length, 1)
            s = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in split(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out.update((item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1))
    return out


def test_ranks_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "ß9"]
    docs = [(i, " ".join(rng.choices(words, [1 / (n + 1) for n in range(62)], k=rng.randint(0, 30)))) for i in range(200)]
    docs += [(500, docs[5][1])] * 4 + [(None, docs[5][1].upper()), (501, None), (502, "!!"), (503, "w1 " * 30_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for i in range(12)] + [(3, "w1 w1 w50"), (None, "w2, W3-w2"), (20, ""), (21, None), (22, "nowhere"), (3, "w1 w1 w50")]
    for k in (1, 10, 400):
        d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS item", "2 AS term", "'x' AS doc", "3 AS part")
        b = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 AS item", "2 AS term", "3 AS score")
        got = tput.search(d, b, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and Counter(map(tuple, got.collect())) == plain_ranks(docs, items, k)


def test_rank_edges(spark):
    docs, items = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert tput.search(docs.limit(0), items).count() == 0 and tput.search(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in tput.search(docs, items).collect()] == [tuple(k) for k in plain_ranks([(1, "a b"), (2, None)], [(1, "a")], 10)]
