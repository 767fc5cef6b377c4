"""Benchmark decontamination by pigeonhole edit matching.

An item of m characters may occur with k = RATE * m errors. Cut into k + 1 pieces, one piece of it then occurs without
error: an Aho-Corasick automaton of all pieces finds these, and Myers' bit-parallel distance verifies the item around
each. Both sides are lower-cased, with one space for whatever isn't a letter or digit, and a space at either end, so that
an item matches at the bounds of words. An item of fewer than LEAST characters, such as "yes", says nothing where it
stands among other words: it matches only a document that is nothing else.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import cut, discard, fresh, whole_text

#: Errors allowed for each character of an item.
RATE = 0.08
#: Characters of an item that can match a part of a document.
LEAST = 25
#: Items come in blocks of about as many characters; each block is one pass over the documents, written before the next.
BLOCK = 1_000_000

HITS = "array<struct<item_id: bigint, distance: int, budget: int>>"
HIT_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32())]))


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def pieces(text: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of about one length, with where they begin."""
    cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:])]


def occurs(masks: dict[str, int], m: int, text: str) -> int:
    """The least edit distance of a pattern of m characters to any part of the text. masks: for each character a bit for each place."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (~(across | up) & full), up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best = score
        plus, minus = plus << 1 & full, minus << 1 & full
        eq |= down
        up, down = minus | (~(eq | plus) & full), plus & eq
    return best


class Matcher:
    """items: (item_id or None, normalised text); empty texts match nothing. edge: put around items and texts. Items of fewer than `least` characters match whole texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE, edge: str = "", least: int = 0):
        self.edge, self.whole = edge, defaultdict(list)
        for i, t in items:
            if t and len(t) < least:
                self.whole[t].append((i, 0, 0))
        self.items = [(i, f"{edge}{t}{edge}", int(rate * len(t))) for i, t in items if t and len(t) >= least]
        self.masks: dict[int, dict[str, int]] = {}
        by_piece = defaultdict(list)
        for n, (_, text, k) in enumerate(self.items):
            for at, piece in pieces(text, k):
                by_piece[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in by_piece.items():
            self.automaton.add_word(piece, (len(piece), where))
        if by_piece:
            self.automaton.make_automaton()

    def mask(self, n: int) -> dict[str, int]:
        if n not in self.masks:
            own = self.masks[n] = defaultdict(int)
            for i, c in enumerate(self.items[n][1]):
                own[c] |= 1 << i
        return self.masks[n]

    def find(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, least distance, budget) of each item that occurs within its budget, by item_id, null ids last."""
        order = lambda h: (h[0] is None, h[0] or 0, *h[1:])
        short = self.whole.get(text, [])
        if not self.items:
            return sorted(short, key=order)
        text = f"{self.edge}{text}{self.edge}"
        begins = defaultdict(set)
        for end, (size, where) in self.automaton.iter(text):
            for n, at in where:
                begins[n].add(end + 1 - size - at)
        out = []
        for n, starts in begins.items():
            item, own, k = self.items[n]
            m, best, done = len(own), k + 1, -1
            ordered = sorted(starts)
            i = 0
            while i < len(ordered) and best:
                a = b = ordered[i]
                while i < len(ordered) and ordered[i] <= b + 2 * k:
                    b = ordered[i]
                    i += 1
                a, z = max(0, a - k), min(len(text), b + m + k)
                if z > done:
                    best, done = min(best, occurs(self.mask(n), m, text[a:z])), z
            if best <= k:
                out.append((item, best, k))
        return sorted(out + short, key=order)


def item_blocks(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The items, normalised, in blocks whose size is checked before they are collected."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), normal(whole_text()).alias("text")).where(F.col("text") != "").distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block)
    for i in range(n):
        yield [(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()]


#: A worker's matcher, kept from task to task: (key, matcher) of the block that is looked for.
HELD: list = []


def matcher_of(key: str, items: list[tuple[int, str]], rate: float) -> Matcher:
    if not HELD or HELD[0][0] != key:
        HELD.clear()
        HELD.append((key, Matcher(items, rate, " ", LEAST)))
    return HELD[0][1]


def hits_column(spark: SparkSession, items: list[tuple[int, str]], text: Column, rate: float = RATE) -> Column:
    """The hits of a block of items in each text."""
    held = spark.sparkContext.broadcast(items)  # a block
    key = uuid.uuid4().hex

    @F.arrow_udf(HITS)
    def hits(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = matcher_of(key, held.value, rate)
        for texts in batches:
            found = [matcher.find(t) for part in slices(plain(texts), 1_000_000) for t in part.to_pylist()]
            yield pa.array([[dict(zip(("item_id", "distance", "budget"), h, strict=True)) for h in own] for own in found], HIT_TYPE)

    # else the optimizer repeats it for a filter on its result
    return hits.asNondeterministic()(normal(text))


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """One row for each document and item that it holds: doc_id, item_id, distance, budget.

    Null and empty texts hold nothing; repeated rows and items of one id give a row each, with the least distance per
    item text. An item whose item_id is null is looked for as any other and reported with a null; one without a letter or
    digit matches nothing. Texts of any length are searched whole; empty tables give no rows; other columns are ignored, whatever
    their names. The hits of each block of items are written before the next block is looked for, so that no plan or
    task holds more than one.
    """
    spark = docs.sparkSession
    parts = [cut(docs.select("doc_id", F.explode(hits_column(spark, items, whole_text(), rate)).alias("hit")).select("doc_id", "hit.*"), "hits") for items in item_blocks(benchmark)]
    return reduce(DataFrame.union, parts) if parts else docs.select("doc_id", F.explode(F.array().cast(HITS)).alias("hit")).select("doc_id", "hit.*")


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """`docs` without the rows that hold an item, whatever the item's id; all its columns stay, whatever their names. Rows with null or empty texts stay, repeated rows share their fate, and empty tables leave all. What a block leaves is written before the next is looked for."""
    name, blocks = fresh(docs, "hits"), item_blocks(benchmark)
    items, held, left = next(blocks, None), None, docs
    while items is not None:
        left, last = left.withColumn(name, hits_column(docs.sparkSession, items, whole_text(), rate)).where(F.size(name) == 0).select(*docs.columns), held
        items = next(blocks, None)
        if items is not None:
            left = held = cut(left, "clean")
            if last is not None:
                discard(last)
    return left
