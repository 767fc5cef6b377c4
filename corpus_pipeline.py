"""A training corpus from documents: quality, line dedup, near-dedup, decontamination, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes each one's rows to the
shared folder and reads them again for the next. All but the last return the columns of documents, and any others that
`docs` has, whatever their names. For all stages: a null text counts as the empty one and texts of any length are read
whole; rows that are repeated, or tie in doc_id, are rows of their own; null ids are ids; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm import bpe, decontam, linedup, orderdup, quality
from larkspan.llm.common import bounded, cut, fresh, load, whole_text
from larkspan.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose score is under 0.7.

    Equal texts have equal scores, so repeated rows stay or go together; empty texts have the score of a text without
    features. Labels of ids that `docs` doesn't have, or null ones, teach nothing; without any label there is no model to
    judge by and every document stays.
    """
    model = quality.learn(docs, load(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return docs.withColumn(score, model.score(spark, whole_text())).where(F.col(score) >= 0.7).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that stand on many sites; n_chars, if there is one, counts what is left.

    Every row stays, also one that loses all its lines: its text is then empty. Null texts stay null, and a null source
    is a site of its own. A line of any length is one line.
    """
    rows = linedup.dedup_lines(docs).select(*docs.columns)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one of the least doc_id, null ids last; of rows that tie in id and text the first by a hash of all columns.

    Texts without words are near only to their copies; null and empty ones are copies.
    """
    bounded(spark)
    return orderdup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item, with errors or without, whatever its id. Empty texts and items hold and match nothing; an empty benchmark leaves all."""
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source, as far as `docs` has them, and the counts and digests of the tokens of each text; an empty text has none and the digests of nothing. Each row gives one row."""
    bounded(spark)
    digests, path = fresh(docs, "digests"), tokenizer_path()
    rows = docs.withColumn(digests, bpe.digest_column(whole_text(), path))
    return rows.select(*(c for c in ("doc_id", "lang", "source") if c in docs.columns), f"{digests}.n_tokens", f"{digests}.ids_sha256", f"{digests}.decoded_sha256")


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: SQL has no trained classifier, no alignment and no BPE; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
