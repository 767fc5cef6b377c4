from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from larkspan.llm import components, decontam, features, langid, linedup, orderdup, permindex, quality
from larkspan.llm.queries import ORACLES, QUERIES

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF01 = "/root/testdata/sf0.01"


def odd_docs(spark, texts):
    """Rows with nulls, repeated rows and ids, and extra columns whose names the operators use inside."""
    rows = [(i, t, None, None, None) for i, t in texts] * 2 + [(None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "text AS gone", "doc_id AS node", "text AS hits", "1 AS score", "2 AS label", "text AS bands")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF01}/documents.parquet").cache()


# op3


def edit_distance_within(pattern: str, text: str) -> int:
    """Sellers: the least distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", min_size=1, max_size=30), st.text("abc ", max_size=80))
def test_myers(pattern, text):
    masks = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    assert decontam.occurs(masks, len(pattern), text) == edit_distance_within(pattern, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcd ", min_size=5, max_size=40), min_size=1, max_size=4), st.text("abcd ", max_size=150), st.sampled_from([0.0, 0.1, 0.2]))
def test_pigeonhole_finds_all(items, text, rate):
    got = decontam.Matcher(list(enumerate(items)), rate).find(text)
    want = [(n, d, int(rate * len(t))) for n, t in enumerate(items) if (d := edit_distance_within(t, text)) <= int(rate * len(t))]
    assert got == want


def test_decontamination(spark, documents):
    benchmark = spark.read.parquet(f"{SF01}/benchmark.parquet")
    clean = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    items = {r["item_id"]: clean(r["text"]) for r in benchmark.collect()}
    exact = {(r["doc_id"], i) for r in documents.collect() for i, t in items.items() if f" {t} " in f" {clean(r['text'])} "}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op3_decontamination"](spark, SF01).collect()}
    assert exact and {k for k, d in got.items() if d == 0} == exact
    kept = decontam.clean(documents, benchmark)
    assert {r["doc_id"] for r in documents.collect()} - {r["doc_id"] for r in kept.collect()} == {d for d, _ in got}


def test_decontamination_edges(spark):
    item = "The quick brown fox, jumps over the lazy dog; and then it sleeps for a very long while."
    other = "An item without an id, which is as much a part of the benchmark as all the others are."
    bench = spark.createDataFrame([(1, item), (2, None), (None, "x"), (3, ""), (None, other)], "item_id bigint, text string")
    hurt = item.replace("brown", "brawn").replace("lazy", "lzy")
    docs = odd_docs(spark, [(1, None), (2, ""), (3, "x " * 20000 + hurt.upper() + " y" * 20000), (4, "clean text"), (5, f"So {other}"), (6, f"{other} {item}")])
    got = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontam.contaminated(docs, bench).collect())
    assert got == {(3, 1, 2): 2, (5, None, 0): 2, (6, 1, 0): 2, (6, None, 0): 2}
    assert decontam.clean(docs, bench).count() == 7 and decontam.clean(docs, bench).columns == docs.columns
    assert decontam.contaminated(docs.limit(0), bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_short_items_and_blocks(spark, monkeypatch):
    long = [f"{w} {w[::-1]} over {w}" for w in ("copper", "window", "garden", "saddle", "thirty", "jumped")]
    bench = spark.createDataFrame([(1, "yes"), (2, "a"), *((10 + i, t) for i, t in enumerate(long))], "item_id bigint, text string")
    docs = odd_docs(spark, [(1, "Yes!"), (2, "yesterday was a fine day"), (3, f"x {long[3]} y"), (4, f"x{long[3]}y"), (5, None), (6, long[0] + " " + long[5])])
    want = {(1, 1, 0): 2, (3, 13, 0): 2, (4, 13, 2): 2, (6, 10, 0): 2, (6, 15, 0): 2}
    for block in (decontam.BLOCK, 60):
        monkeypatch.setattr(decontam, "BLOCK", block)
        assert Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontam.contaminated(docs, bench).collect()) == want
        kept = decontam.clean(docs, bench)
        assert Counter(r["doc_id"] for r in kept.collect()) == {2: 2, 5: 2, None: 1} and kept.columns == docs.columns


def test_decontamination_equals_sellers(spark, documents):
    benchmark = spark.read.parquet(f"{SF01}/benchmark.parquet").limit(12)
    docs = documents.where("n_chars < 1500").orderBy("doc_id").limit(120)
    clean = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    hurt = lambda s, n: "".join("q" if i % n == 3 else c for i, c in enumerate(s))
    texts = [r["text"] for r in docs.collect()][:60] + [f"before {hurt(r['text'], n)} after" for r in benchmark.collect() for n in (9, 12, 14, 30)]
    items = {r["item_id"]: clean(r["text"]) for r in benchmark.collect()}
    want = {(i, k, d, int(0.08 * len(t))) for i, x in enumerate(texts) for k, t in items.items() if (d := edit_distance_within(f" {t} ", f" {clean(x)} ")) <= int(0.08 * len(t))}
    got = decontam.contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), benchmark).collect()
    assert {tuple(r) for r in got} == want and len(want) >= 24


# op4


def test_quality_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_quality"](spark, SF01).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def plain_quality_score(model, text):
    """Features and average one by one: byte n-grams of <word>, the whole word, and word pairs that come back."""
    mask, base, spread = (1 << 64) - 1, int(features.BASE), int(features.SPREAD)
    bucket = lambda h, salt: (((h ^ salt * 0x51ED27) * spread) & mask) >> (64 - quality.BITS)
    words, total, n = text.split(), 0.0, 0
    for word in words:
        own = f"<{word}>".encode()
        for size in quality.SIZES:
            for i in range(len(own) - size + 1):
                total, n = total + float(model.weights[bucket(sum(c * base ** (size - 1 - j) for j, c in enumerate(own[i : i + size])) & mask, size)]), n + 1
        total, n = total + float(model.weights[bucket(sum((c + 1) * base ** (len(own) - j) for j, c in enumerate(own)) & mask, 99)]), n + 1
    again = quality.REPEAT_WEIGHT * sum(any(words[i] == words[i - g] and words[i - 1] == words[i - 1 - g] for g in range(1, min(quality.LAG, i - 1) + 1)) for i in range(1, len(words)))
    return 1 / (1 + math.exp(-((total + float(model.weights[quality.REPEAT]) * again) / max(1, n + again) + model.bias)))


def test_quality_equals_plain_version(documents, spark):
    model = quality.learn(documents, spark.read.parquet(f"{SF01}/labels.parquet"))
    texts = ["", "a", "one two one two one two", "é ü 漢字 🙂", "x " * 60, *(r["text"] for r in documents.where("n_chars < 900").orderBy("doc_id").limit(60).collect())]
    got = model.score_texts(pa.array(texts, pa.large_string()))
    assert np.allclose(got, [plain_quality_score(model, t) for t in texts], atol=1e-6) and got.min() < 0.3 and got.max() > 0.9


def test_quality_edges(spark):
    docs = odd_docs(spark, [(1, None), (2, ""), (3, "good words here"), (4, "$$$ " * 30000), (5, "é" * 50000)])
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == 11 and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["predicted"] for r in quality.score_documents(docs, labels.limit(0)).collect()} == {1}
    assert quality.score_documents(docs.limit(0), labels).count() == 0
    by_slice = quality.SubwordModel(np.linspace(-1, 1, quality.REPEAT + 1).astype(np.float32), 0.1)
    texts = ["a b c a b c a b c", "", "x", "one two  three\nfour"]
    assert by_slice.score_texts(pa.array(texts)).tolist() == [by_slice.score_texts(pa.array([t]))[0] for t in texts]


# op5


def brute_neighbours(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        others = np.flatnonzero(ids != ids[i])
        scores = (x[others] * x[i]).sum(1)
        best = np.lexsort((ids[others], -scores))[:k]
        out[int(ids[i])] = [(int(ids[others][j]), float(scores[j])) for j in best]
    return out


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    want = brute_neighbours(table["vec_id"].to_numpy(), np.array(table["embedding"].tolist(), float), 20, 20)
    got = defaultdict(dict)
    for r in QUERIES["op5_neighbours"](spark, "/root/testdata/sf0.1").collect():
        got[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys() and all(sorted(v) == [*range(1, 21)] for v in got.values())
    assert np.mean([len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) / 20 for q in want]) >= 0.9
    exact = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(abs(s - exact[q, i]) < 1e-12 for q, v in got.items() for i, s in v.values() if (q, i) in exact)


def test_neighbours_do_not_depend_on_the_order_of_rows():
    """Rows of equal footrule distance at the cut."""
    rng = np.random.default_rng(0)
    x, ids = rng.normal(size=(600, 8)), [[i] for i in range(600)]
    pivots = np.column_stack([rng.normal(size=(16, 8)), np.zeros(16)])
    order = rng.permutation(600)
    first = permindex.orders(x, np.zeros(600), pivots, 3)
    blocks = [permindex.Block(x[o], [ids[i] for i in o], first[o], 16) for o in (np.arange(600), order)]
    for q in range(100):
        own = permindex.orders(x[q : q + 1], np.zeros(1), pivots, 3)[0]
        assert blocks[0].search(x[q], q, own, 5, 0.02, 10) == blocks[1].search(x[q], q, own, 5, 0.02, 10)


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [2.0, 1.0]), (5, [0.0, 0.0]), (6, None), (7, [nan, 1.0]), (8, [None, 1.0]), (40, [inf, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (4, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS x", "2 AS ids", "3 AS rank")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in permindex.nearest(df).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, 2.0), (0, 2, 3, 1.0), (0, 3, 9, 1.0), (0, 4, 20, 1.0), (20, 1, 4, 2.0), (20, 2, 0, 1.0), (20, 3, 3, 1.0), (20, 4, 9, 1.0)]
    by_blocks = permindex.nearest(df, block=2, queries=1).orderBy("query_id", "rank").collect()
    assert got == [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in by_blocks]
    assert permindex.nearest(df.limit(0)).count() == 0


# op6


def test_line_oracle(spark, data):
    for path in (data, SF01):
        con = duckdb.connect()
        con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
        got = Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in QUERIES["op6_line_dedup"](spark, path).collect())
        assert got == Counter(con.sql(f"SELECT doc_id, n_lines, n_removed, text FROM ({ORACLES['op6_line_dedup']})").fetchall())


def test_line_edges(spark):
    rows = [(i, f"head\nown {i}\n\n tail ", None, f"s{i}", None) for i in range(12)] + [(100, "head", None, None, None), (None, "tail\nhead", None, "s1", None), (101, None, None, "s2", None), (102, "", None, "s3", None), (5, "other\nhead", None, "s3", None), (103, "z\n" * 30000, None, "s1", None), (None, "head\nmine", None, "s2", None), (None, "head\nmine", None, "s2", None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "text AS gone", "1 AS n_lines", "doc_id AS gone_id")
    out = linedup.dedup_lines(docs)
    assert out.columns == [*docs.columns, "_n_lines", "n_removed"]
    got = Counter((r["doc_id"], r["text"], r["_n_lines"], r["n_removed"]) for r in out.collect())
    assert got == Counter([(i, f"own {i}\n", 4, 2) for i in range(12)] + [(100, "", 1, 1), (None, "", 2, 2), (101, None, 0, 0), (102, "", 1, 0), (5, "other", 2, 1), (103, "z\n" * 30000, 30001, 0), (None, "mine", 2, 1), (None, "mine", 2, 1)])
    assert linedup.dedup_documents(docs.limit(0)).count() == 0


# op7


def plain_grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_edits(a, b):
    row = [*range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def fast_edits(a, b):
    """The same by numpy rows, for longer texts."""
    codes = {}
    a, b = (np.array([codes.setdefault(w, len(codes)) for w in x], int) for x in (a, b))
    place = np.arange(len(b) + 1)
    row = place
    for i, x in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (b != x))])
        row = np.minimum.accumulate(new - place) + place
    return int(row[-1])


def plainly_near(a, b):
    """Of two word lists: 1 - edits / words of the longer one is 0.8 at least."""
    longer = max(len(a), len(b))
    bags = Counter(a), Counter(b)
    if longer - sum((bags[0] & bags[1]).values()) > 0.2 * longer + 1e-9:
        return False  # each word of the longer text that the other lacks is an edit
    return fast_edits(a, b) <= 0.2 * longer + 1e-9


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14), st.lists(st.integers(0, 3), max_size=14), st.integers(0, 9))
def test_banded_alignment(a, b, most):
    want = plain_edits(a, b)
    assert orderdup.edits(a, b, most) == min(want, most + 1) and fast_edits(a, b) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=60), st.data())
def test_banded_alignment_of_copies(a, data):
    b = list(a)
    for _ in range(data.draw(st.integers(0, 12))):
        at = data.draw(st.integers(0, len(b)))
        b[at : at + data.draw(st.integers(0, 2))] = [data.draw(st.integers(0, 300))] * data.draw(st.integers(0, 2))
    for most in (0, 1, 5, 12, 40):
        assert orderdup.edits(a, b, most) == min(plain_edits(a, b), most + 1)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.lists(st.integers(0, 2**64 - 1), max_size=40))
def test_bags_bound_edits(a, b):
    x, y = (orderdup.bag(np.array(w, np.uint64)).astype(int) for w in (a, b))
    assert np.abs(x - y).sum() <= 2 * plain_edits(a, b)


def components_of(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = n = root[root[n]]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def all_near(words):
    """The pairs of all texts that are plainly near. Word counts in cells spare most alignments: an edit changes two of them by one."""
    cells = np.zeros((len(words), 512), np.int32)
    for i, own in enumerate(words):
        np.add.at(cells[i], [zlib.crc32(w.encode()) % 512 for w in own], 1)
    sizes, out = np.array([*map(len, words)]), []
    for i in range(len(words)):
        longer = np.maximum(sizes[i], sizes[i + 1 :])
        maybe = np.flatnonzero(np.abs(cells[i + 1 :] - cells[i]).sum(1) <= 0.4 * longer + 1e-6) + i + 1
        out += [(i, j) for j in maybe.tolist() if plainly_near(words[i], words[j])]
    return out


def test_near_classes(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    ids = [*texts]
    want = components_of(texts, [(ids[i], ids[j]) for i, j in all_near([t.lower().split() for t in texts.values()])])
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in QUERIES["op7_near_dedup"](spark, SF01).collect()}
    assert {i: c for i, (c, _) in got.items()} == want
    sizes = Counter(want.values())
    assert all(n == sizes[c] for c, n in got.values())
    assert {r["doc_id"] for r in orderdup.keep_one(documents).collect()} == set(want.values())


def scattered(rng, words, n):
    """n edits at places of their own: changed, lost and added words."""
    out = [[w] for w in words]
    for i in rng.sample(range(len(words)), n):
        out[i] = rng.choice([["x%d" % rng.randrange(10**9)]] * 2 + [[], out[i] + ["y%d" % rng.randrange(10**9)]])
    return [w for own in out for w in own]


@pytest.mark.parametrize("size", [1, 3, 5, 6, 8, 10, 12, 18, 24, 26, 30, 31, 40, 60, 100, 126, 160, 250, 1000])
def test_pairs_at_the_threshold_share_a_band(size):
    """All pairs of a text and its edited copies are the truth, whatever bands they have."""
    rng, met, near = random.Random(size), 0, 0
    for share in (0.05, 0.1, 0.15, 0.2):
        for _ in range(60 if size < 500 else 15):
            a = ["w%d" % rng.randrange(10**9) for _ in range(size)]
            b = scattered(rng, a, int(share * size + 1e-9))
            if not b or not plainly_near(a, b):
                continue
            x, y = (set(orderdup.band_values(orderdup.word_hashes(w), 0.8).tolist()) for w in (a, b))
            near, met = near + 1, met + bool(x & y)
    assert near >= 50 and met >= 0.98 * near and (met == near or size > orderdup.TINY)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=24), st.lists(st.integers(0, 2), min_size=1, max_size=30), st.sampled_from([0.5, 0.8, 0.9, 1.0]))
def test_pieces_miss_no_pair(a, b, threshold):
    most = orderdup.budget(max(len(a), len(b)), threshold)
    own = [set(orderdup.pieces(np.array(w, np.uint64), threshold).tolist()) for w in (a, b)]
    assert own[0] & own[1] or plain_edits(a, b) > most


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=24), st.data())
def test_pieces_find_edited_texts(a, data):
    b = list(a)
    for _ in range(orderdup.budget(len(a), 0.8)):
        at = data.draw(st.integers(0, len(b)))
        b[at : at + data.draw(st.integers(0, 1))] = [data.draw(st.integers(0, 9))] * data.draw(st.integers(0, 1))
    if b and plain_edits(a, b) <= orderdup.budget(max(len(a), len(b)), 0.8):
        own = [set(orderdup.pieces(np.array(w, np.uint64), 0.8).tolist()) for w in (a, b)]
        assert own[0] & own[1]


def test_one_word_changed(spark):
    """Short texts, which have few k-mers or none in common."""
    texts = ["one two three four five six seven eight", "one two three FOR five six seven eight", "a b c d e", "a b x d e", "a y c d e", "p q r s", "p q r t"]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r["class_id"] for r in orderdup.classify_documents(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 2, 5: 5, 6: 6}


def test_labels_of_repeats():
    """A k-mer's first occurrence is the same in a text without repeats."""
    once, twice = orderdup.word_runs(pa.array(["a b c d e f g", "a b c d e f g a b c d e f g"], pa.large_string()))
    once, twice = orderdup.kmers(once), orderdup.kmers(twice)
    assert len(set(twice.tolist())) == 11 and set(once.tolist()) < set(twice.tolist())


def near_groups(texts):
    """Classes by comparing all texts."""
    return components_of(range(len(texts)), all_near([t.split() for t in texts]))


@pytest.mark.parametrize(("pairs", "block"), [(orderdup.PAIRS, orderdup.BLOCK), (0, 8), (1 << 30, 8), (0, 60)])
def test_near_crowds(spark, monkeypatch, pairs, block):
    """Copies that are near to their original, but not to each other, and texts that share a template and are copied again."""
    monkeypatch.setattr(orderdup, "PAIRS", pairs)
    monkeypatch.setattr(orderdup, "BLOCK", block)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))

    def changed(base, n):
        copy = list(base)
        for i in rng.sample(range(len(base)), n):
            copy[i] = word()
        return copy

    texts = []
    for n in (120, 40):
        first = [word() for _ in range(200)]
        for base in (first, first[:150] + [word() for _ in range(50)]):
            texts += [base, *(changed(base, 24) for _ in range(n))]
    template = [word() for _ in range(190)]
    for _ in range(80):  # half of each is its own
        own = template[:95] + [word() for _ in range(95)]
        texts += [own] + [changed(own, 6)] * (rng.random() < 0.3)
    texts = [" ".join(t) for t in texts]
    want = near_groups(texts)
    assert max(Counter(want.values()).values()) > 100
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    assert {r["doc_id"]: r["class_id"] for r in orderdup.classify_documents(docs).collect()} == want


def test_copies_meet_in_few_of_their_bands(spark, monkeypatch):
    """A group of copies comes together by one band in LEAD; its other bands make no rows then, and other texts aren't fetched."""
    sizes, real = Counter(), orderdup.cut

    def counted(df, kind):
        out = real(df, kind)
        sizes[kind] += out.count()
        return out

    monkeypatch.setattr(orderdup, "cut", counted)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    copies = [" ".join(base[:i] + [f"x{i}"] + base[i + 1 :]) for i in range(0, 200, 5)]
    alone = [" ".join(f"y{rng.randrange(10**6)}" for _ in range(50)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(copies + alone)], DOCS)
    got = {r["doc_id"]: r["class_id"] for r in orderdup.classify_documents(docs).collect()}
    assert got == dict.fromkeys(range(40), 0) | {i: i for i in range(40, 80)}
    assert sizes["members"] < 40 * orderdup.SKETCHES / 2 and sizes["met-texts"] == 40


def test_near_edges(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    docs = odd_docs(spark, [(1, None), (2, ""), (3, "one two"), (4, "One  two"), (5, long), (6, long + " tail"), (7, " \n "), (3, "other text of this id")])
    got = Counter((r["doc_id"], r["class_id"], r["class_size"]) for r in orderdup.classify_documents(docs).collect())
    assert got == {(1, 1, 5): 2, (2, 1, 5): 2, (None, 1, 5): 1, (3, 3, 4): 2, (4, 3, 4): 2, (5, 5, 4): 2, (6, 5, 4): 2, (7, 7, 2): 2, (3, 3, 2): 2}
    kept = orderdup.keep_one(docs)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == {1: 1, 3: 2, 5: 1, 7: 1}
    assert orderdup.classify_documents(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(30)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == components_of({n for p in real for n in p}, real)


def test_components_go_on_from_known_ones(spark, monkeypatch):
    """Links within known components don't go on, and a star ends in one round: what the rounds join doesn't grow with their number."""
    sizes, real = [], components.cut

    def counted(df, kind):
        out = real(df, kind)
        sizes.append((kind, out.count()))
        return out

    monkeypatch.setattr(components, "cut", counted)
    star = [(50, i) for i in range(100) if i != 50]
    known = components.components(spark.createDataFrame(star, "a bigint, b bigint"))
    assert [n for kind, n in sizes if kind == "links"] == [99, 0]
    sizes.clear()
    more = [(i, i + 1) for i in range(99)] + [(3, 200), (300, 301)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(more, "a bigint, b bigint"), known).collect()}
    assert got == dict.fromkeys([*range(100), 200], 0) | {300: 300, 301: 300}
    assert [n for kind, n in sizes if kind == "links"] == [2, 0]


# op9


def test_language_held_out(spark, documents):
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = [r for r in QUERIES["op9_language"](spark, SF01).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) >= 0.97


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    emit, start, move = rng.random((4, 1, 3)) + 0.1, rng.random(3) + 0.1, rng.random((3, 3)) + 0.1
    ahead, back, _ = langid.forward_backward(emit, np.array([[True], [False], [False], [False]]), start, move)
    p = ahead * back
    p /= p.sum(2, keepdims=True)
    want = np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        w = start[path[0]] * np.prod([emit[t, 0, y] for t, y in enumerate(path)]) * np.prod([move[a, b] for a, b in zip(path, path[1:])])
        for t, y in enumerate(path):
            want[t, y] += w
    assert np.allclose(p[:, 0], want / want.sum(1, keepdims=True))


def test_chain_gradients():
    """fit() against AdaGrad steps by numeric gradients of the log-likelihood, whose normalizer sums over all label paths."""
    rows = [("abc cde abc efg", "x"), ("ghi abc ijk", "y"), ("klm ghi mno cde", "z")]
    got = langid.ChainModel.fit(rows, epochs=2)
    rng, k = np.random.default_rng(7), 3
    for _ in rows:
        rng.integers(8, 40)  # texts this short are one piece each
    words = sorted({w for t, _ in rows for w in t.split()})
    word, bucket = got.features(words)
    feats = np.unique(bucket)
    counts = np.zeros((len(words), len(feats)))
    np.add.at(counts, (word, np.searchsorted(feats, bucket)), 1)
    pieces = [([words.index(w) for w in t.split()], got.langs.index(lang)) for t, lang in rows]
    shapes = [(len(feats), k), (k,), (k, k)]
    sizes = np.cumsum([0, *(int(np.prod(x)) for x in shapes)])

    def likelihood(params, seqs):
        w, start, move = (params[a:b].reshape(x) for a, b, x in zip(sizes[:-1], sizes[1:], shapes, strict=True))
        total = 0.0
        for seq, gold in seqs:
            emit = counts[seq] @ w
            paths = np.array(np.meshgrid(*[np.arange(k)] * len(seq))).reshape(len(seq), -1).T
            score = lambda y: start[y[:, 0]] + emit[np.arange(len(seq)), y].sum(1) + move[y[:, :-1], y[:, 1:]].sum(1)  # noqa: B023, E731
            total += score(np.array([gold]))[0] - np.logaddexp.reduce(score(paths))
        return total

    params = np.concatenate([np.zeros(sizes[2]), np.eye(k).ravel()])
    square = np.full(len(params), 1e-3)
    for _ in range(2):
        mix = rng.permutation(len(pieces))
        seqs = [(sum((pieces[j][0] for j in g), []), sum(([pieces[j][1]] * len(pieces[j][0]) for j in g), [])) for g in (mix[:2], mix[2:])]
        steps = np.eye(len(params)) * 1e-5
        g = np.array([(likelihood(params + d, seqs) - likelihood(params - d, seqs)) / 2e-5 for d in steps])
        g[: sizes[1]] -= 1e-4 * params[: sizes[1]]
        square += g * g
        params = params + 0.3 * g / np.sqrt(square)
    want = [params[a:b].reshape(x) for a, b, x in zip(sizes[:-1], sizes[1:], shapes, strict=True)]
    for a, b in zip((got.weights[feats], got.start, got.move), want, strict=True):
        assert np.allclose(a, b, atol=1e-4)
    assert not np.delete(got.weights, feats, 0).any()
    texts = ["abc ghi zzz", "klm " * 9, "cde", "", "mno efg " * 20]
    together = got.predict_texts(pa.array(texts))
    alone = [got.predict_texts(pa.array([t])) for t in texts]
    assert together[0] == [x[0] for x, _ in alone] and np.allclose(together[1], [y[0] for _, y in alone], atol=1e-12)


def test_language_edges_and_switches(spark, documents):
    model = langid.learn(documents)
    by = {r["lang"]: r["text"] for r in documents.where("n_chars > 400").dropDuplicates(["lang"]).collect()}
    mixed = " ".join(by["en"].split()[:30] + by["de"].split()[:30])
    docs = spark.createDataFrame([(1, mixed)], "doc_id bigint, text string")
    labels = [w["lang"] for w in docs.select(model.label_words(spark, docs.text).alias("w")).first()["w"]]
    assert labels[:25].count("en") >= 20 and labels[-25:].count("de") >= 20
    assert model.predict_texts(pa.array(["½ ② ²"]))[0] == ["und"]
    odd = odd_docs(spark, [(1, None), (2, ""), (3, "123 ..."), (4, by["fr"] * 40), (5, "x" * 100000)])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in odd.select("doc_id", model.predict(spark, odd.text).alias("p")).select("doc_id", "p.*").collect()}
    assert got[1] == got[2] == got[3] == got[None] == ("und", 0.0) and got[4][0] == "fr" and 0 <= got[5][1] <= 1
    assert {r["lang_pred"] for r in langid.identify_documents(odd).collect()} == {"und"}
    assert langid.identify_documents(odd.limit(0)).count() == 0


def test_language_learns_all(spark, monkeypatch):
    words = {f"l{k:02}": [f"{a}{chr(97 + k % 26)}{chr(97 + k // 26)}{b}" for a in "bdfg" for b in "aeiou"] for k in range(70)}
    rows = [(i * 70 + k, " ".join(w), x, None, None) for i in range(6) for k, (x, w) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, DOCS)
    got = langid.identify_documents(docs).join(docs, "doc_id").where("lang_pred = lang").select("lang").distinct().count()
    assert got == 70
    monkeypatch.setattr(langid, "ROWS", 70)
    assert langid.learn(docs).langs == sorted(words)


# the pipeline


def test_pipeline(spark, documents):
    benchmark = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, SF01).collect()}
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op4_quality"](spark, SF01).collect()}
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, corpus_pipeline.cut(stage(spark, docs, SF01), "test")
        assert docs.columns == documents.columns and 0 < docs.count() <= before.count()
    kept = {r["doc_id"] for r in docs.collect()}
    assert not kept & benchmark and all(scores[i] for i in kept)
    again = docs.select("doc_id", "text")
    classes = orderdup.classify_documents(again).collect()
    assert all(r["class_size"] == 1 for r in classes)
    rows = corpus_pipeline.run(spark, SF01).collect()
    assert {r["doc_id"] for r in rows} == kept and len(rows) == len(kept)


def test_pipeline_equals_plain_version(spark):
    """The whole pipeline over a small table, with odd rows, against plain Python; the trained scores are the model's own."""
    from tokenizers import Tokenizer

    own = spark.read.parquet(f"{SF01}/documents.parquet").where("n_chars < 1500").orderBy("doc_id").limit(150).collect()
    items = [r["text"] for r in spark.read.parquet(f"{SF01}/benchmark.parquet").orderBy("item_id").limit(12).collect()]
    rows = [tuple(r) for r in own]
    prose = [r["text"] for r in own if len(r["text"].split()) > 60][:6]
    rows += [(10_000 + i, f"{t} once more", "en", f"s{i}", 0) for i, t in enumerate(prose)]
    rows += [(10_100 + i, f"Shared by all sites\n{prose[0]} {i}", "en", f"t{i}", 0) for i in range(12)]
    rows += [(10_200 + i, f"{prose[1]} {t} {prose[2]}", "en", "u", 0) for i, t in enumerate(items)]
    rows += [(10_300, None, None, None, None), (10_301, "", "en", "u", 0), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    model = quality.learn(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    left = [(r, r[1]) for r in rows]
    left = [x for x, s in zip(left, model.score_texts(pa.array([t or "" for _, t in left], pa.large_string())), strict=True) if s >= 0.7]

    sites = defaultdict(set)
    for r, t in left:
        for line in (t or "").split("\n"):
            sites[line.strip(" ")].add(r[3] or "")
    common = {line for line, own_sites in sites.items() if line and len(own_sites) >= 10}
    left = [(r, t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in common)) for r, t in left]

    words = [(t or "").lower().split() for _, t in left]
    near = [(i, j) for i in range(len(left)) for j in range(i) if words[i] == words[j] or (min(len(words[i]), len(words[j])) >= 0.8 * max(len(words[i]), len(words[j])) and plainly_near(words[i], words[j]))]
    firsts = {}
    for n, c in components_of(range(len(left)), near).items():
        firsts[c] = min(firsts.get(c, n), n, key=lambda x: left[x][0][0])
    left = [left[n] for n in firsts.values()]

    clean = lambda s: " ".join("".join(c if c.isalnum() else " " for c in s.lower()).split())
    bench = [clean(t) for t in items]
    left = [(r, t) for r, t in left if not any(edit_distance_within(f" {b} ", f" {clean(t or '')} ") <= int(0.08 * len(b)) for b in bench)]
    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path())
    library.no_truncation()
    library.no_padding()
    want = Counter((r[0], r[2], r[3], len(library.encode(t or "", add_special_tokens=False).ids)) for r, t in left)

    with pytest.MonkeyPatch.context() as patch:
        real = corpus_pipeline.load
        tables = {"documents": docs, "benchmark": spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")}
        patch.setattr(corpus_pipeline, "load", lambda s, d, name: tables[name] if name in tables else real(s, d, name))
        got = Counter((r["doc_id"], r["lang"], r["source"], r["n_tokens"]) for r in corpus_pipeline.run(spark, SF01).collect())
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    assert len(want) < len(rows) - 20


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_edges(spark, name):
    """Each stage alone: nulls, empty and very long texts, repeated rows, an empty table, and columns of names that stages use inside."""
    stage, last = dict(corpus_pipeline.STAGES)[name], corpus_pipeline.STAGES[-1][0]
    long = " ".join(f"word{i}" for i in range(60_000))
    docs = odd_docs(spark, [(1, None), (2, ""), (3, "Two plain sentences. They stand here alone."), (4, long), (5, "\n \n")])
    got = stage(spark, docs, SF01)
    assert stage(spark, docs.limit(0), SF01).count() == 0
    if name == last:
        assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == docs.count()
        assert stage(spark, docs.drop("lang", "source"), SF01).columns[0] == "doc_id"
        return
    assert got.columns == docs.columns
    rows = Counter(r["doc_id"] for r in got.collect())
    if name == "MinHash near-dedup":
        assert rows == {1: 1, 3: 1, 4: 1, 5: 1}
    elif name == "quality classifier":
        assert all(rows[i] in (0, n) for i, n in ((1, 2), (2, 2), (3, 2), (4, 2), (5, 2), (None, 1))) and rows[1] == rows[2] == 2 * rows[None]
    else:
        assert rows == {1: 2, 2: 2, 3: 2, 4: 2, 5: 2, None: 1}
