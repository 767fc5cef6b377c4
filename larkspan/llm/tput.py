"""Ranked lexical search by TPUT over term-partitioned postings.

The postings of the terms that are asked for lie in files ordered by term and, in a term's list, by falling strength. A
search takes three phases. The heads of an item's lists give partial scores; the k-th exact score of the best by these is
a lower bound. A share of that bound, divided by the number of lists, is one threshold for all lists: whoever reaches the
bound has an entry at or above it in some list. The entries at or above it are fetched, and give each document met an
upper bound. The exact scores of those whose upper bound reaches the lower one are then looked up.

The share (1 / PARTS) trades the phases: what isn't fetched of a document adds up to that share of the bound at most, so
that with less of it more is fetched and fewer candidates are left.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import cut, discard, whole_text

#: Fixed value: what stands between terms.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Entries of a list's head, texts of an item whose exact scores give the bound, and parts of the bound.
HEAD, PROBES, PARTS = 300, 100, 4
#: Most rows of a table about items and terms that is broadcast; each is under 100 bytes. Beyond it Spark chooses.
BROADCAST = 200_000
#: Bytes of text that are split at once.
SLICE = 2_000_000
#: Of each byte its lower-case form, and whether it belongs to a term: digits, letters and all bytes beyond ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def terms_of(text: Column) -> Column:
    """The terms of a text in order, only A-Z lower-cased."""
    return F.array_remove(F.split(F.translate(text, ascii_uppercase, ascii_lowercase), BETWEEN), "")


def term_starts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of large strings, which of them belong to terms, where terms begin, and the row of each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    rows, inside = offsets - offsets[0], INSIDE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edge = rows[:-1][rows[:-1] < len(data)]
    begins[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    return data, inside, starts, np.searchsorted(rows, starts, "right") - 1


def counted_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, n (terms of the text), term, tf for each text and each of its terms."""
    for batch in batches:
        at = 0
        for texts in slices(plain(batch.column(1)), SLICE):
            data, inside, starts, rows = term_starts(texts)
            ends = np.concatenate([np.cumsum(inside, dtype=np.int64)[starts] - 1, [np.count_nonzero(inside)]])
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
            coded = words.dictionary_encode()
            pairs, tf = np.unique(rows * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
            row, code = np.divmod(pairs, max(1, len(coded.dictionary)))
            own = pa.array(row + at)
            n = np.bincount(rows, minlength=len(texts))[row]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), pa.array(n, pa.int64()), coded.dictionary.take(pa.array(code)).cast(pa.string()), pa.array(tf, pa.int64())], ["node", "n", "term", "tf"])
            at += len(texts)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, node and n of each row."""
    for batch in batches:
        sizes = [np.bincount(term_starts(texts)[3], minlength=len(texts)) for texts in slices(plain(batch.column(2)), SLICE)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate([np.zeros(0, np.int64), *sizes]), pa.int64())], ["doc_id", "node", "n"])


def small(table: DataFrame) -> DataFrame:
    """The table, to be broadcast if its rows, which are counted, are few enough."""
    return F.broadcast(table) if table.limit(BROADCAST + 1).count() <= BROADCAST else table


def items_of(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """item (a key) and item_id; and for each item its terms, with how often it holds them."""
    rows = benchmark.select("item_id", whole_text().alias("text")).distinct()
    rows = cut(rows.select(F.xxhash64("text", "item_id", F.col("item_id").isNull()).alias("item"), "item_id", "text"), "items")
    terms = rows.select("item", F.explode(terms_of(F.col("text"))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    return rows, cut(terms, "item-terms")


def build_postings(docs: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists of the vocabulary's terms: term, node (a distinct text's address), strength, copies; and node, doc_id, rows of all documents.

    Equal texts have equal scores, so a list names each text once.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).withColumn("node", F.unhex(F.md5("text")))
    ids = rows.select("doc_id", "node", "text").mapInArrow(counted, "doc_id bigint, node binary, n bigint")
    ids = cut(ids.groupBy("node", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.first("n").alias("n")).where("n > 0"), "ids")
    n, length = (x or 0 for x in ids.agg(F.sum("rows"), F.sum(F.col("rows") * F.col("n"))).first())
    # the terms asked for meet each text's own before any shuffle, while they are few enough
    own = rows.select("node", "text").mapInArrow(counted_terms, "node binary, n bigint, term string, tf bigint").join(small(vocabulary), "term")
    own = own.groupBy("node", "term").agg(F.first("tf").alias("tf"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    strength = F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * (25 + (75 * n * {n}L) div {length or 1}L))")
    lists = own.select("term", "node", strength.alias("strength"), "copies")
    order = ["term", F.desc("strength")]
    return cut(lists.repartitionByRange(*order, "node").sortWithinPartitions(*order), "postings"), ids


def kth(rows: DataFrame, value: str, k: int, name: str) -> DataFrame:
    """The k-th largest value of each item that has so many."""
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc(value)))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).where(F.col("rank") == k).select("item", F.col(value).alias(name))


def search(docs: DataFrame, benchmark: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k documents of the highest score above 0 of each item; equal scores by ascending doc_id, a null one last.

    Null and empty texts have no terms: such items get no row, such documents are found by none. Texts of any length count
    whole. Repeated documents are found each; an item_id with several texts is several items, and repeated items are one
    (items are told apart by a 64-bit hash, texts by their MD5). A null item_id is an id like others. Empty tables give no
    row. Other columns are ignored, whatever their names.
    """
    items, item_terms = items_of(benchmark)
    postings, ids = build_postings(docs, item_terms.select("term").distinct())
    n = ids.agg(F.sum("rows")).first()[0] or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2.0 * F.col("df") + 1)))
    lists = postings.groupBy("term").agg(F.sum("copies").alias("df"), F.max("strength").alias("top")).select("term", weight.alias("weight"), "top")
    factor = F.col("times") * F.col("weight")
    wanted = cut(item_terms.join(lists, "term").where("weight > 0").select("item", "term", factor.alias("factor"), (factor * F.col("top")).alias("most")), "wanted")
    few = small(wanted.select("item", "term", "factor"))
    entries, gain = postings.select("term", "node", "strength"), F.sum(F.col("factor") * F.col("strength"))

    # 1: heads of the lists, and exact scores of the best by them
    rank = F.row_number().over(Window.partitionBy("term").orderBy(F.desc("strength"), "node"))
    heads = entries.withColumn("rank", rank).where(F.col("rank") <= max(k, HEAD))
    partial = heads.join(few, "term").groupBy("item", "node").agg(gain.alias("low"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("low"), "node"))
    probes = cut(partial.withColumn("rank", rank).where(F.col("rank") <= max(k, PROBES)).select("item", "node"), "probes")

    def exact(pairs: DataFrame) -> DataFrame:
        """The whole scores of pairs of an item and a text."""
        return entries.join(pairs, "node").join(few, ["item", "term"]).groupBy("item", "node").agg(gain.alias("score"))

    bound = kth(exact(probes), "score", k, "bound")
    each = wanted.groupBy("item").agg((F.count(F.lit(1)) * PARTS).alias("lists")).join(bound, "item", "left").select("item", "lists", F.greatest(F.coalesce("bound", F.lit(1)), F.lit(1)).alias("bound"))

    # 2: all entries at or above the uniform threshold; an entry that isn't fetched gives less than bound / lists
    thresholds = wanted.join(each, "item").withColumn("rest", F.least("most", F.expr("(bound - 1) div lists"))).withColumn("least", F.expr("(bound + lists * factor - 1) div (lists * factor)"))
    thresholds = cut(thresholds, "thresholds")
    live = thresholds.where("factor * least <= most")
    floors = live.groupBy("term").agg(F.min("least").alias("floor"))
    fetched = entries.join(small(floors), "term").where("strength >= floor").drop("floor")
    # each text's entries together, so that its sums for all items need no further shuffle
    fetched = fetched.repartition("node").join(small(live.select("item", "term", "factor", "least", "rest")), "term").where("strength >= least")
    met = fetched.groupBy("item", "node").agg(gain.alias("low"), F.sum("rest").alias("seen"))
    whole = thresholds.groupBy("item").agg(F.sum("rest").alias("rest"), F.first("bound").alias("bound"))
    candidates = cut(met.join(small(whole), "item").where("low + rest - seen >= bound").select("item", "node"), "candidates")

    # 3: exact scores of the candidates; of those that tie with the k-th all
    scored = exact(candidates).where("score > 0").withColumn("rank", F.rank().over(Window.partitionBy("item").orderBy(F.desc("score"))))
    scored = cut(scored.where(F.col("rank") <= k).drop("rank"), "scored")
    own = ids.join(scored.select("node").distinct(), "node").withColumn("row", F.explode(F.sequence(F.lit(1), F.least("rows", F.lit(k)).cast("int"))))
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.asc_nulls_last("doc_id"), "row"))
    own = own.withColumn("first", first).where(F.col("first") <= k).select("node", "doc_id", "row")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "node", "row"))
    top = scored.join(own, "node").withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    out = cut(top.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    discard(items, item_terms, postings, ids, wanted, probes, thresholds, candidates, scored)
    return out


def oracle() -> str:
    """The registered query in DuckDB SQL, for unique ids."""
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^{BETWEEN[1:]}')"
    return f"""WITH d AS (SELECT doc_id, {terms} AS t FROM documents), g AS (SELECT count(*)::BIGINT AS n, sum(len(t))::BIGINT AS l FROM d WHERE len(t) > 0),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * g.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, g.n),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * p.n * g.n) // g.l))))::BIGINT AS score FROM i JOIN p USING (term) JOIN w USING (term), g GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10"""
