"""Line dedup by distinct-site spread, with DataFrame functions alone.

A HyperLogLog sketch of the sites of each line hash merges by aggregation. Lines whose estimate lies within the
sketch's error of the threshold get exact distinct counts; lines on enough sites are boilerplate and leave all texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.common import cut, fresh, whole_text

#: A line on this many distinct sites is boilerplate.
MIN_SITES = 10
LG_K = 12
BREAK = "\n"


def keys(line: Column) -> tuple[Column, Column]:
    """96 bits that stand for a line without the spaces around it."""
    return F.xxhash64(F.trim(line)), F.hash(F.trim(line))


def row_key() -> Column:
    """What tells rows without a doc_id apart, so that they aren't one hot key: a hash of the text, else 0."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(whole_text())).otherwise(0)


def site_lines(docs: DataFrame, site: str) -> DataFrame:
    """doc_id, own, site, h1, h2 of each line that isn't blank. A null site counts as the site named by the empty string."""
    lines = docs.select("doc_id", row_key().alias("own"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), F.explode(F.split(whole_text(), BREAK)).alias("line")).where(F.trim("line") != "")
    h1, h2 = keys(F.col("line"))
    return lines.select("doc_id", "own", "site", h1.alias("h1"), h2.alias("h2"))


def removals(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, own (see row_key) and the boilerplate lines' keys, for documents that have any."""
    error = 3 * 1.04 / math.sqrt(1 << LG_K)
    low, high = min_sites * (1 - error), min_sites * (1 + error)
    lines = site_lines(docs, site)
    spread = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    spread = spread.where(F.col("n") >= min_sites).withColumn("sites", F.hll_sketch_estimate("sketch"))
    wide = cut(spread.where(F.col("sites") >= math.floor(low)).select("h1", "h2", (F.col("sites") <= math.ceil(high)).alias("near")), "wide-lines")
    held = cut(lines.join(wide, ["h1", "h2"]), "wide-line-rows")
    exact = held.where("near").select("h1", "h2", "site").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("sites")).where(F.col("sites") >= min_sites)
    boilerplate = wide.where(~F.col("near")).select("h1", "h2").union(exact.select("h1", "h2"))
    return held.join(boilerplate, ["h1", "h2"], "left_semi").groupBy("doc_id", "own").agg(F.collect_set(F.struct("h1", "h2")).alias("gone"))


def dedup_lines(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """`docs`, its texts without boilerplate lines, and two more columns: n_lines and n_removed (long).

    Lines end at a line feed; blank lines stay. Every row stays, also if its text becomes empty; a null text stays null
    and has no lines. Rows of one doc_id each keep their own text. Columns of clashing names are kept.
    """
    key, own, gone, n, m = (fresh(docs, x) for x in ("gone_id", "gone_own", "gone", "n_lines", "n_removed"))
    found = removals(docs, site, min_sites).select(F.col("doc_id").alias(key), F.col("own").alias(own), F.col("gone").alias(gone))

    def stays(line: Column) -> Column:
        h1, h2 = keys(line)
        return (F.trim(line) == "") | ~F.array_contains(F.col(gone), F.struct(h1.alias("h1"), h2.alias("h2")))

    lines = F.split(F.col("text"), BREAK)
    # merged at every size: a plan that broadcasts what is small today moves all texts only once the corpus has grown
    joined = docs.join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col(key)) & (row_key() == F.col(own)), "left")
    left = F.when(F.col(gone).isNull(), lines).otherwise(F.filter(lines, stays))
    kept = joined.withColumn(gone, left).withColumn(n, F.coalesce(F.size(lines), F.lit(0)).cast("bigint")).withColumn(m, F.col(n) - F.coalesce(F.size(gone), F.lit(0)))
    kept = kept.withColumn("text", F.when(F.col("text").isNotNull(), F.when(F.col(m) == 0, F.col("text")).otherwise(F.array_join(gone, BREAK))))
    return kept.select(*docs.columns, n, m)


def dedup_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and the remaining text of each row."""
    return dedup_lines(docs.select("doc_id", "text", "source")).select("doc_id", "n_lines", "n_removed", "text")


def oracle_text(table: str = "documents", min_sites: int = MIN_SITES) -> str:
    """DuckDB SQL of dedup_documents over a table."""
    return f"""WITH l AS (SELECT trim(unnest(string_split(coalesce(text, ''), chr(10)))) AS line, coalesce(source, '') AS site FROM {table}),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= {min_sites}),
e AS (SELECT coalesce(list(line), []) AS lines FROM b),
d AS (SELECT doc_id, text, string_split(text, chr(10)) AS has, list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(e.lines, trim(x))) AS stay FROM {table}, e)
SELECT doc_id, coalesce(len(has), 0)::BIGINT AS n_lines, coalesce(len(has) - len(stay), 0)::BIGINT AS n_removed,
CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(stay, chr(10)), '') END AS text FROM d"""
