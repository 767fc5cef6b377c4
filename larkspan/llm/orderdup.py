"""Near-duplicates by Order MinHash.

A text is its occurrence-labelled k-mers of SHINGLE words. Each of SKETCHES hash functions samples the two least of them
and keeps these in text order, so that texts agree in a sketch as their order of k-mers agrees: a measure that follows
the edit distance. Texts that agree in a sketch share a band. Two texts of a band are linked, if the banded alignment of
their words confirms a similarity of THRESHOLD: 1 - edits / words of the longer text. Classes are the links' components.

Texts of SMALL words at most have few k-mers, of which edits touch many: theirs are of FINE words. For texts of TINY words
at most the search is exact: of the longer of two texts cut into one piece more than its budget of
edits, one piece at least stands unchanged in the other, shifted by no more than the edits beside it; each such piece
with its place is a band, too.

The texts of a band are compared with its most central one first. Those that are not yet in one component are compared
with each other, in pairs of blocks where the band has many; the texts' word counts spare the alignment of most pairs. No
pair of a band is left out: a pair's word counts and lengths bound its edits from below.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import cut, discard, fresh, whole_text
from larkspan.llm.components import components
from larkspan.llm.features import BASE, SPREAD, words_of

SHINGLE, THRESHOLD = 4, 0.8
SKETCHES = 64
#: Words of a k-mer of texts of SMALL words at most; the most words of a text whose pieces are compared.
FINE, SMALL, TINY = 3, 125, 24
#: Words are counted in 1 << BAG_BITS cells of a text's bag, a byte each.
BAG_BITS = 8
#: Of how many bands one is looked at before the others.
LEAD = 8
#: Links of a representative that are verified together.
SALT = 256
#: Pairs left for each text of a shared band at which all are compared at once; above it, texts are first compared with their nearest.
PAIRS = 256
#: Texts of a block; a band that has more is compared in pairs of blocks.
BLOCK = 1024
#: Pairs that a text gives at most in a round in which it meets the others of its block.
NEAREST = 4
#: Words of a block's texts, or one text.
WORDS = 1_000_000
CHUNK = 1_000_000


def stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * SPREAD
    return x ^ (x >> np.uint64(29))


#: Each hash function multiplies by an odd number after an exclusive or.
with np.errstate(over="ignore"):
    XOR = stir(stir(np.arange(1, SKETCHES + 1, dtype=np.uint64) * BASE))
    TIMES = stir(XOR + BASE) | np.uint64(1)


def word_hashes(words: list[str]) -> np.ndarray:
    coded = [w.encode("utf-8", "replace") or b"\0" for w in words]
    lens = np.fromiter(map(len, coded), np.int64, len(coded))
    if not len(lens):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(lens)
    left = np.repeat(ends, lens) - np.arange(ends[-1])
    powers = np.cumprod(np.full(int(lens.max()), BASE, np.uint64))
    return stir(np.add.reduceat((np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64) + np.uint64(1)) * powers[left - 1], ends - lens))


def word_runs(texts: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of the lower-case words of each text, in order."""
    split, at, offsets = words_of(pc.utf8_lower(texts))
    hashes = word_hashes(split)
    empty = np.array([not w for w in split] or [False])
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        own = at[a:b]
        yield hashes[own[~empty[own]]] if len(own) else np.zeros(0, np.uint64)


def kmers(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The labelled k-mers of a text in order: one of all words if they are fewer than `size`, none without words."""
    size = min(size, len(words))
    if not size:
        return words
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(size))
        for j in range(size):
            h = h * BASE + words[j : j + n]
        h = stir(h)
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        same = ranked[1:] == ranked[:-1]
        if same.any():
            begins = np.concatenate([[0], np.flatnonzero(~same) + 1])
            label = np.empty(n, np.uint64)
            label[order] = (np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))).astype(np.uint64)
            # a first occurrence keeps its value, also in a text without repeats
            h = np.where(label > 0, stir(h + label * BASE), h)
    return h


def sketch(own: np.ndarray) -> np.ndarray:
    """The band values of a text's k-mers: one for each hash function, of the two least k-mers in text order."""
    xor, times = XOR[:, None], TIMES[:, None]
    best, where = np.full((len(xor), 2), np.iinfo(np.uint64).max), np.zeros((len(xor), 2), np.int64)
    rows = np.arange(len(xor))
    with np.errstate(over="ignore"):
        for at in range(0, len(own), 1 << 13):
            h = (own[None, at : at + (1 << 13)] ^ xor) * times
            values, places = [best], [where]
            for _ in range(min(2, h.shape[1])):
                i = h.argmin(1)
                values.append(h[rows, i][:, None])
                places.append((i + at)[:, None])
                h[rows, i] = np.iinfo(np.uint64).max
            values, places = np.concatenate(values, 1), np.concatenate(places, 1)
            pick = np.argsort(values, axis=1, kind="stable")[:, :2]
            best, where = np.take_along_axis(values, pick, 1), np.take_along_axis(places, pick, 1)
        if len(own) == 1:
            where[:, 1] = where[:, 0]
        where.sort(axis=1)
        return stir(rows.astype(np.uint64) * BASE + stir(own[where[:, 0]] * BASE + own[where[:, 1]]))


def pieces(words: np.ndarray, threshold: float) -> np.ndarray:
    """A value for each piece of a short text and its place: as the longer one of a pair, and, up to TINY words, as one of the same length or a shorter one."""
    mask, base, out, n = (1 << 64) - 1, int(BASE), [], len(words)
    before, powers = [0], [1]
    for w in words.tolist():
        before.append((before[-1] * base + w + 1) & mask)
        powers.append(powers[-1] * base & mask)
    longer = n
    while longer - (most := budget(longer, threshold)) <= n and (n <= TINY or longer == n):
        shift = n - longer
        for i in range(most + 1):
            a, b = longer * i // (most + 1), longer * (i + 1) // (most + 1)
            low, high = max(0, a - i, a + shift - (most - i)), min(n - b + a, a + i, a + shift + most - i)
            for at in range(low, high + 1) if n <= TINY else (a,):
                own = before[at + b - a] - before[at] * powers[b - a]
                out.append((own * base + (longer << 16) + i + 1) & mask)
        longer += 1
    return stir(stir(np.array(out, np.uint64)))


def band_values(words: np.ndarray, threshold: float) -> np.ndarray:
    """The bands of a text; none without words."""
    if not len(words):
        return np.zeros(0, np.int64)
    # what a text of the same pair may be no longer than
    shorter, out = len(words) - budget(len(words), threshold), []
    if len(words) > SMALL:
        out.append(sketch(kmers(words)))
    if shorter <= SMALL:
        out.append(sketch(kmers(words, FINE)))
    if shorter <= TINY:
        out.append(pieces(words, threshold))
    return np.unique(np.concatenate(out)).view(np.int64)


def bag(words: np.ndarray) -> np.ndarray:
    """How many words fall into each cell by their hash, up to 255. One edit changes two of these numbers by one at most."""
    return np.minimum(np.bincount((words >> np.uint64(64 - BAG_BITS)).astype(np.int64), minlength=1 << BAG_BITS), 255).astype(np.uint8)


def bag_rows(bags: pa.Array) -> np.ndarray:
    """A row for each of the packed bags, in numbers whose differences don't overflow."""
    return np.frombuffer(b"".join(bags.to_pylist()), np.uint8).reshape(len(bags), 1 << BAG_BITS).astype(np.int16)


def sketch_column(text: Column, threshold: float = THRESHOLD) -> Column:
    """The number of words, the band values and the bag of each text; no bands for a text without words."""
    kinds = [("size", pa.int64()), ("bands", pa.list_(pa.int64())), ("bag", pa.binary())]

    @F.arrow_udf("struct<size: bigint, bands: array<bigint>, bag: binary>")
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, bands, bags = [], [], []
            for part in slices(plain(texts), CHUNK):
                for words in word_runs(part):
                    sizes.append(len(words))
                    bands.append(band_values(words, threshold))
                    bags.append(bag(words).tobytes())
            yield pa.StructArray.from_arrays([pa.array(x, kind) for x, (_, kind) in zip((sizes, bands, bags), kinds, strict=True)], [name for name, _ in kinds])

    return sketched(text)


def budget(words: int, threshold: float) -> int:
    """Edits within the threshold for a longer text of so many words."""
    return int((1 - threshold) * words + 1e-9)


def edits(a: list, b: list, most: int) -> int:
    """The edit distance of two sequences, or most + 1 if it is over `most`.

    Bit-parallel columns of the band of 2 * most + 1 diagonals: a bit of `up` and `down` says whether a cell is one more
    or one less than the one above it.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    n = 0
    while n < len(b) and a[n] == b[n]:
        n += 1
    a, b, n = a[n:], b[n:], 0
    while n < len(b) and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[: len(a) - n], b[: len(b) - n]
    if not b or not most:
        return min(len(a), most + 1)
    # the distance is len(a) at most
    most, over = min(most, len(a) - 1), min(most + 1, len(a))
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    wide = 2 * most + 2
    full, top, shift = (1 << wide) - 1, wide - 1, most + 1 - wide
    up, down, distance, bottom = full >> (wide - most - 1) << (wide - most - 1), 0, most, wide - 2
    give_up, turn = 2 * most + len(b) - len(a), len(a) - most
    for i, x in enumerate(b):
        eq = masks.get(x, 0)
        at = shift + i
        eq = (eq >> at if at >= 0 else eq << -at) & full
        diagonal = (((eq & up) + up) ^ up | eq | down) & full
        right, left = (down | ~(diagonal | up)) & full, diagonal & up
        if i < turn:  # the band's lowest diagonal is followed down to the last row, then that row to its end
            distance += not diagonal >> top
            if distance > give_up:
                return over
        else:
            distance += (right >> bottom & 1) - (left >> bottom & 1)
            bottom -= 1
        diagonal >>= 1
        up, down = (left | ~(diagonal | right)) & full, diagonal & right
    return distance if distance <= most else over


def similar_column(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    """Whether the aligned similarity of two texts reaches the threshold."""

    @F.arrow_udf("boolean")
    def similar(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = []
            for at in range(0, len(left), 64):
                x, y = plain(left.slice(at, 64)).to_pylist(), plain(right.slice(at, 64)).to_pylist()
                seen = [*dict.fromkeys(x + y)]
                own = dict(zip(seen, (w.tolist() for part in slices(pa.array(seen, pa.large_string()), CHUNK) for w in word_runs(part)), strict=True))
                for s, t in zip(x, y, strict=True):
                    most = budget(max(len(own[s]), len(own[t])), threshold)
                    out.append(edits(own[s], own[t], most) <= most)
            yield pa.array(out, pa.bool_())

    return similar(a, b)


def address(text: Column) -> Column:
    return F.unhex(F.md5(text))


def text_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Distinct texts: node (their address), id (the least doc_id; null if all are), twins (rows of that id), copies, size (in words), bands, bag."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).select("doc_id", address(F.col("text")).alias("node"), F.col("text"))
    own = rows.select("doc_id", "node", sketch_column(F.col("text"), threshold).alias("own")).groupBy("node").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("own").alias("own"))
    # rows of an id and a text are counted apart, so that sketches are shuffled once
    twins = rows.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("twins")).where("twins > 1").select("node", F.col("doc_id").alias("id"), "twins")
    same = own.join(twins.withColumnRenamed("node", "twin").withColumnRenamed("id", "twin_id"), (F.col("node") == F.col("twin")) & F.col("id").eqNullSafe(F.col("twin_id")), "left")
    return same.select("node", "id", F.coalesce("twins", F.lit(1)).alias("twins"), "copies", "own.*")


def alike(a: str, b: str, threshold: float) -> Column:
    """Whether texts of these sizes can reach the threshold at all."""
    return F.least(a, b) >= F.greatest(a, b) - F.floor((1 - threshold) * F.greatest(a, b) + 1e-9)


def possible(pairs: DataFrame, met: DataFrame, threshold: float) -> DataFrame:
    """The pairs (node, rep) whose bags and sizes allow the threshold."""

    @F.arrow_udf("boolean")
    def allowed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b, longer in batches:
            out = [np.zeros(0, bool)]
            for at in range(0, len(a), 4096):
                most = np.floor((1 - threshold) * longer.slice(at, 4096).to_numpy(zero_copy_only=False) + 1e-9)
                out.append(np.abs(bag_rows(a.slice(at, 4096)) - bag_rows(b.slice(at, 4096))).sum(1, dtype=np.int64) <= 2 * most)
            yield pa.array(np.concatenate(out))

    own = lambda x: met.select(F.col("node").alias(x), F.col("size").alias(f"{x}_size"), F.col("bag").alias(f"{x}_bag"))
    both = pairs.join(own("node"), "node").join(own("rep"), "rep").where(alike("node_size", "rep_size", threshold))
    return both.where(allowed(F.col("node_bag"), F.col("rep_bag"), F.greatest("node_size", "rep_size"))).select("node", "rep")


def near_bags(sizes: np.ndarray, bags: np.ndarray, roots: np.ndarray, lower: np.ndarray, blocks: np.ndarray, threshold: float, nearest: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, of two blocks or of one, that are of different roots, not both lower, and whose bags and sizes allow the threshold. nearest: only so many for each row, by their bags."""
    mixed = bool((blocks != blocks[0]).any())
    if len(sizes) <= 48 and nearest is None:
        i, j = np.triu_indices(len(sizes), 1)
        most = np.floor((1 - threshold) * np.maximum(sizes[i], sizes[j]) + 1e-9).astype(np.int64)
        keep = (roots[i] != roots[j]) & ~(lower[i] & lower[j]) & (np.abs(sizes[i] - sizes[j]) <= most)
        if mixed:
            keep &= blocks[i] != blocks[j]
        i, j, most = i[keep], j[keep], most[keep]
        keep = np.abs(bags[i] - bags[j]).sum(1) <= 2 * most
        return i[keep], j[keep]
    found_i, found_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    coarse = bags.reshape(len(bags), -1, 8).sum(2)  # bounds too, and sooner
    for i in range(len(sizes) - 1):
        j = np.arange(i + 1, len(sizes))
        keep = (roots[j] != roots[i]) & ~(lower[j] & lower[i])
        if mixed:
            keep &= blocks[j] != blocks[i]
        most = np.floor((1 - threshold) * np.maximum(sizes[j], sizes[i]) + 1e-9).astype(np.int64)
        keep &= np.abs(sizes[j] - sizes[i]) <= most
        for own in (coarse, bags):
            j, most = j[keep], most[keep]
            apart = np.abs(own[j] - own[i]).sum(1)
            keep = apart <= 2 * most
        if nearest is not None and keep.sum() > nearest:
            j, keep = j[keep][np.argsort(apart[keep], kind="stable")[:nearest]], slice(None)
        j = j[keep]
        found_i.append(np.full(len(j), i))
        found_j.append(j)
    return np.concatenate(found_i), np.concatenate(found_j)


def block_pairs(members: DataFrame, met: DataFrame, threshold: float, deal: int | None = None) -> DataFrame:
    """band, cell, i, j (a group of texts), node, root, reps: texts of one band and of different roots whose bags and sizes allow the threshold. Texts that are only among the reps have a row, too.

    Two such texts lie in one cell of sizes or in two neighbouring ones, each 1 / threshold times as wide as the one
    before; a text goes to its own cell and, as a lower one, to the next. A cell's texts are dealt to blocks of BLOCK
    texts and WORDS words or so. With `deal`, a number that shuffles them, each text meets those of its block in its own
    cell and gives NEAREST pairs at most. Without it, each block of texts outside the band's largest component meets all blocks, and
    gives all its pairs.
    """
    cell = F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9) if threshold < 1 else F.col("size")
    out = F.col("root") != F.col("largest") if deal is None else F.lit(False)
    placed = members.select("band", "node", "size", F.xxhash64("root").alias("part"), cell.cast("bigint").alias("cell"), out.alias("out"))
    both = F.array(F.struct(F.col("cell").alias("at"), F.lit(False).alias("lower")), *([F.struct((F.col("cell") + 1).alias("at"), F.lit(True).alias("lower"))] if deal is None else []))
    of = lambda which, value: F.sum(F.when(which, value).otherwise(0))
    counts = [of(which, value).alias(f"{name}_{what}") for which, name in ((F.col("out"), "outer"), (~F.col("out"), "inner")) for value, what in ((F.lit(1), "n"), (F.col("size"), "words"))]
    sums = placed.groupBy("band", "cell").agg(*counts, F.min("part").alias("low"), F.max("part").alias("high"))
    blocks = lambda name: F.ceil(F.greatest(F.sum(f"{name}_n") / BLOCK, F.sum(f"{name}_words") / WORDS)).cast("int").alias(name)
    number = sums.withColumn("in", F.explode(both)).groupBy("band", "in.at").agg(blocks("outer"), blocks("inner"), F.min("in.lower").alias("only_lower"), (F.min("low") < F.max("high")).alias("apart"))
    number = number.where("apart AND NOT only_lower" + (" AND outer > 0" if deal is None else ""))
    # a band has as many cells as its texts' sizes have powers of 1 / threshold
    cells = number.groupBy("band").agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("outer", "inner")))).alias("cells"))
    held = F.filter(both, lambda x: F.map_contains_key("cells", x["at"]))
    rows = placed.drop("size", "part").join(cells, "band").withColumn("in", F.explode(held)).withColumn("n", F.try_element_at("cells", F.col("in.at")))
    rows = rows.select("band", "node", F.col("in.at").alias("cell"), "in.lower", "out", "n.outer", "n.inner")
    own = lambda n: F.pmod(F.xxhash64("node", F.lit(deal or 0)), F.col(n)).cast("int")
    dealt = rows.withColumn("block", F.when(F.col("out"), own("outer")).otherwise(F.col("outer") + own("inner")))
    if deal is None:
        last = F.col("outer") + F.when(F.col("out"), F.col("inner")).otherwise(0) - 1
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    else:
        dealt = dealt.withColumn("other", F.col("block"))
    dealt = dealt.select("band", "cell", "node", "lower", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    # a text has a bounded number of bands
    own = members.groupBy("node", "root").agg(F.collect_list("band").alias("crowded"))
    dealt = dealt.join(own, "node").join(met.select("node", "size", "bag"), "node")
    nearest = None if deal is None else NEAREST
    kinds = pa.schema([("band", pa.int64()), ("cell", pa.int64()), ("i", pa.int32()), ("j", pa.int32()), ("node", pa.binary()), ("root", pa.binary()), ("reps", pa.list_(pa.binary()))])

    def compare(table: pa.Table) -> pa.RecordBatch:
        key = [table[f.name][0].as_py() for f in list(kinds)[:4]]
        roots = table["root"].combine_chunks().dictionary_encode().indices.to_numpy()
        x, y = near_bags(table["size"].to_numpy(), bag_rows(table["bag"].combine_chunks()), roots, table["lower"].to_numpy(), table["block"].to_numpy(), threshold, nearest)
        if nearest is None and len(x):
            # of all pairs, one that shares several bands counts in the least of them
            crowded, band = [set(c) for c in table["crowded"].to_pylist()], key[0]
            first = np.array([min(crowded[i] & crowded[j]) == band for i, j in zip(x.tolist(), y.tolist(), strict=True)], bool)
            x, y = x[first], y[first]
        rows, node = np.union1d(x, y), table["node"].combine_chunks()
        ends = np.concatenate([[0], np.searchsorted(x, rows, "right")])  # x ascends
        reps = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), node.take(pa.array(y)))
        return pa.RecordBatch.from_arrays([*(pa.array([k] * len(rows), f.type) for k, f in zip(key, kinds, strict=False)), node.take(pa.array(rows)), table["root"].combine_chunks().take(pa.array(rows)), reps], schema=kinds)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Compares the rows of each group as soon as the next begins; groups come one after the other."""
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True))
            cuts = [0, *(n for n in range(1, len(keys)) if keys[n] != keys[n - 1]), len(keys)]
            for at, end in zip(cuts, cuts[1:]):
                if held and keys[at] != last:
                    if sum(map(len, held)) > 1:
                        yield compare(pa.Table.from_batches(held).combine_chunks())
                    held = []
                held.append(batch.slice(at, end - at))
                last = keys[at]
        if sum(map(len, held)) > 1:
            yield compare(pa.Table.from_batches(held).combine_chunks())

    group = ["band", "cell", "i", "j"]
    dealt = dealt.select(*group, "node", "root", "size", "lower", "block", "bag", "crowded").repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(groups, "band bigint, cell bigint, i int, j int, node binary, root binary, reps array<binary>")


def block_links(groups: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """a, b: the verified links among the pairs of block_pairs(); within a group, no pair of texts that its other links have brought together."""

    def align(table: pa.Table) -> pa.Table:
        nodes, roots = table["node"].to_pylist(), table["root"].to_pylist()
        words: dict = {}
        for part in slices(plain(table["text"]), CHUNK):
            for w in word_runs(part):
                words[nodes[len(words)]] = w.tolist()
        above = {r: r for r in roots}
        root_of, found = dict(zip(nodes, roots, strict=True)), []

        def top(r: bytes) -> bytes:
            while above[r] != r:
                above[r] = r = above[above[r]]
            return r

        for a, reps in zip(nodes, table["reps"].to_pylist(), strict=True):
            for b in reps:
                x, y = top(root_of[a]), top(root_of[b])
                most = budget(max(len(words[a]), len(words[b])), threshold)
                if x != y and edits(words[a], words[b], most) <= most:
                    above[x] = y
                    found.append((a, b))
        return pa.table({"a": [a for a, _ in found], "b": [b for _, b in found]}, pa.schema([("a", pa.binary()), ("b", pa.binary())]))

    return groups.join(texts, "node").groupBy("band", "cell", "i", "j").applyInArrow(align, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """a, b: the pairs (node, rep) whose similarity reaches the threshold."""
    # a representative may have many texts: these links are salted, and its text comes once for every SALT of them
    wide = cut(pairs.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("parts")), "representatives")
    salted = pairs.join(wide, "rep").select("node", "rep", F.pmod(F.pmod(F.xxhash64("node", "rep"), F.lit(1 << 30)), "parts").alias("salt"))
    left = salted.join(texts, "node").withColumnRenamed("text", "text_a")
    right = texts.join(wide.withColumnRenamed("rep", "node"), "node").select(F.col("node").alias("rep"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("text").alias("text_b"))
    both = left.join(right, ["rep", "salt"])
    found = cut(both.where(similar_column(F.col("text_a"), F.col("text_b"), threshold)).select(F.col("node").alias("a"), F.col("rep").alias("b")), "near-links")
    discard(wide)
    return found


def links(docs: DataFrame, groups: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """a, b: verified links of distinct texts, and node, root: their components. Two texts of a band are in one component, or were compared.

    First each text is compared with the most central one that leads one of its bands among those of one value in LEAD; a
    text is the more central, the more texts these bands have. So copies that share most of their bands come together
    before all bands are looked at, and of these only the ones that still hold several components go on. While that
    halves the pairs that are left, the texts of a band are then compared with the nearest of their block by their bags;
    at last all pairs of a band whose components differ are compared.
    """
    hashed = F.xxhash64("node")
    own = [F.count(F.lit(1)).alias("n"), F.bit_xor(hashed).alias("x")]

    def unlike(sets: DataFrame) -> DataFrame:
        """Bands of the same texts say the same: one of them is kept, such as one of all those that two copies share."""
        return cut(sets.groupBy("n", "x").agg(F.min("band").alias("band")).select("band", "n"), "bands")

    def wanted(table: DataFrame, nodes: DataFrame) -> DataFrame:
        return table.join(nodes, "node", "left_semi")

    def texts_of(nodes: DataFrame) -> DataFrame:
        texts = docs.select(whole_text().alias("text")).select(address(F.col("text")).alias("node"), "text")
        return cut(wanted(texts, nodes).groupBy("node").agg(F.first("text").alias("text")), "met-texts")

    tried, found = [], []

    def compare(pairs: DataFrame, met: DataFrame) -> None:
        """Verifies new pairs (node, rep), each once."""
        pairs = pairs.groupBy(F.least("node", "rep").alias("x"), F.greatest("node", "rep").alias("y")).agg(F.min("rep").alias("rep"))
        for old in tried:
            pairs = pairs.join(old, ["x", "y"], "left_anti")
        pairs = cut(pairs, "pairs")
        tried.append(pairs)
        maybe = cut(possible(pairs.select(F.when(F.col("rep") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("node"), "rep"), met, threshold), "possible")
        texts = texts_of(maybe.select("node").union(maybe.select("rep")))
        found.append(verified(maybe, texts, threshold))
        discard(maybe, texts)

    lead = groups.select("node", F.explode(F.filter("bands", lambda x: F.pmod(x, F.lit(LEAD)) == 0)).alias("band"))
    shared = unlike(lead.groupBy("band").agg(*own).where("n > 1"))
    weights = lead.join(shared, "band").groupBy("node").agg(F.sum("n").alias("weight"), F.collect_list("band").alias("bands"))
    met = cut(weights.join(groups.select("node", "size", "bag"), "node"), "met")
    members = cut(met.select("node", "size", "weight", F.explode("bands").alias("band")), "members")
    reps = cut(members.groupBy("band").agg(F.max(F.struct("weight", "node", "size")).alias("top")).select("band", *(F.col(f"top.{x}").alias(f"rep_{x}") for x in ("node", "size", "weight"))), "reps")
    near = members.join(reps, "band").where((F.col("node") != F.col("rep_node")) & alike("size", "rep_size", threshold))
    compare(near.groupBy("node").agg(F.max(F.struct("rep_weight", "rep_node")).alias("rep")).select("node", F.col("rep.rep_node").alias("rep")), met)
    discard(shared, members, reps, met)
    roots = components(found[0])

    placed = groups.select("node", "size", "bands").join(roots, "node", "left").select("node", "size", F.coalesce("root", "node").alias("root"), F.explode("bands").alias("band"))
    part = F.xxhash64("root")
    shared = unlike(placed.groupBy("band").agg(*own, F.min(part).alias("low"), F.max(part).alias("high")).where("low < high"))
    members = cut(placed.join(shared.select("band"), "band"), "members")
    met = cut(wanted(groups.select("node", "size", "bag"), members.select("node").distinct()), "met")
    discard(shared)
    most = PAIRS * met.count()

    def mixed_of(members: DataFrame) -> tuple[DataFrame, float]:
        """The bands that hold several components, and the pairs of different components in these."""
        parts = members.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("band")
        total = F.sum("n").cast("double")
        mixed = cut(parts.agg(F.max(F.struct("n", "root")).alias("largest"), ((total * total - F.sum(F.col("n").cast("double") * F.col("n"))) / 2).alias("left")).where("left > 0").select("band", F.col("largest.root").alias("largest"), "left"), "mixed")
        return mixed, mixed.agg(F.sum("left")).first()[0] or 0

    mixed, left = mixed_of(members)
    before, deal = float("inf"), 1
    while left > most and left <= before / 2:
        wide = cut(block_pairs(members, met, threshold, deal), "block-pairs")
        compare(wide.select("node", F.explode("reps").alias("rep")), met)
        old, roots = roots, components(found[-1], roots)
        new = cut(members.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")
        discard(members, mixed, wide, old)
        before, deal, members = left, deal + 1, new
        mixed, left = mixed_of(members)
    if left:
        wide = cut(block_pairs(members.join(mixed.select("band", "largest"), "band"), met, threshold), "block-pairs")
        texts = texts_of(wide.select("node").distinct())
        found.append(cut(block_links(wide, texts, threshold), "near-links"))
        old, roots = roots, components(found[-1], roots)
        discard(wide, texts, old)
    discard(members, mixed, met, *tried)
    out = cut(reduce(DataFrame.union, found), "near-links")
    discard(*found)
    return out, roots


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """node, class_id, keeper (the node of class_id), twins (the keeper's rows of that id), class_size, for each distinct text."""
    groups = cut(text_groups(docs, threshold), "text-groups")
    near_links, roots = links(docs, groups, threshold)
    near = groups.drop("bands", "bag").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # ids before nulls
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node", "twins"))
    by_root = near.groupBy("root").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    by_root = cut(by_root.select("root", F.col("first.id").alias("class_id"), F.col("first.node").alias("keeper"), F.col("first.twins").alias("twins"), "class_size"), "classes")
    members = cut(near.select("node", "root").join(by_root, "root").drop("root"), "class-members")
    discard(groups, near_links, roots, by_root)
    return members


def classify_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id (the least doc_id of its class) and class_size (its rows).

    Equal texts share a class; null counts as the empty text, and texts without words are similar only to their copies.
    A class whose ids are all null has a null class_id. Rows keep their number, an empty table gives none; texts of any
    length are compared whole, and columns of `docs` besides doc_id and text are ignored.
    """
    rows = docs.select("doc_id", address(whole_text()).alias("node"))
    return rows.join(classes(docs, threshold), "node").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one row of each class, of the least doc_id and its text; of rows that tie in both, the first by all columns' hash.

    Null texts count as empty. All columns of `docs` are kept, whatever their names; an empty table stays empty.
    """
    node, id_, keeper, twins = (fresh(docs, x) for x in ("near_node", "near_id", "near_keeper", "near_twins"))
    firsts = classes(docs, threshold).where(F.col("node") == F.col("keeper")).select(F.col("node").alias(node), F.col("class_id").alias(id_), F.col("twins").alias(twins))
    rows = docs.withColumn(node, address(whole_text())).join(firsts, node).where(F.col("doc_id").cast("bigint").eqNullSafe(F.col(id_)))
    single, tied = rows.where(F.col(twins) == 1), rows.where(F.col(twins) > 1)
    one = tied.groupBy(node).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias(keeper)).select(f"{keeper}.*")
    return single.select(*docs.columns).union(one.select(*docs.columns))
