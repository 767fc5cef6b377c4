"""Quality classifier: hashed word and character n-gram vectors, averaged per document, with a softmax output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import crc32_mod, whole_text
from larkspan.llm.features import sums_by_text, word_features, words_of

SIZES, BITS, DIM = (3, 4, 5), 17, 10
#: Most labelled rows to learn from.
SAMPLE = 2000
CHUNK = 500_000


#: A word bigram that comes back within LAG words is one more feature, of bucket REPEAT, that counts REPEAT_WEIGHT times.
REPEAT, REPEAT_WEIGHT, LAG = 1 << BITS, 10, 24


def repeated(at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """1 for each word that, like the one before it, stood as many words earlier in its text, up to LAG; else 0."""
    out, place = np.zeros(len(at), bool), np.arange(len(at)) - np.repeat(offsets[:-1], np.diff(offsets))
    for lag in range(1, LAG + 1):
        same = at[lag:] == at[:-lag]
        out[lag + 1 :] |= same[1:] & same[:-1] & (place[lag + 1 :] > lag)
    return out.astype(np.float64)


def feature_counts(text: Column) -> Column:
    """struct(buckets, counts) of each text: its distinct features and how often each occurs."""

    @F.arrow_udf("struct<buckets: array<int>, counts: array<int>>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for part in slices(plain(texts), CHUNK):
                words, at, offsets = words_of(part)
                word, bucket = word_features(words, SIZES, BITS)
                order = np.argsort(word, kind="stable")
                bucket, begin = bucket[order], np.searchsorted(word[order], np.arange(len(words) + 1))
                again = sums_by_text(repeated(at, offsets), offsets)
                for a, b, again_here in zip(offsets[:-1], offsets[1:], again, strict=True):
                    which, times = np.unique(at[a:b], return_counts=True)
                    got = [bucket[begin[w] : begin[w + 1]] for w in which]
                    times = np.append(np.repeat(times, [len(x) for x in got]), REPEAT_WEIGHT * again_here)
                    own, back = np.unique(np.concatenate([*got, [REPEAT]]).astype(np.int64), return_inverse=True)
                    rows.append({"buckets": own, "counts": np.bincount(back, weights=times, minlength=len(own)).astype(np.int64)})
            yield pa.array(rows, pa.struct([("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]))

    return counted(text)


@dataclass
class SubwordModel:
    """weights: for each bucket its vector times the difference of the two output columns; what the average needs of both."""

    weights: np.ndarray
    bias: float

    @classmethod
    def fit(cls, rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.6, seed: int = 7) -> SubwordModel:
        """Stochastic gradient descent on the softmax loss, one document at a time. Without rows the score is 1: nothing speaks against a text."""
        if not rows:
            return cls(np.zeros(REPEAT + 1, np.float32), 50.0)
        rng = np.random.default_rng(seed)
        vectors = rng.uniform(-1 / DIM, 1 / DIM, (REPEAT + 1, DIM)).astype(np.float32)
        out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
        steps, done = epochs * len(rows), 0
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                buckets, counts, label = rows[i]
                lr, done = rate * (1 - done / steps), done + 1
                share = (counts / max(1, counts.sum())).astype(np.float32)
                hidden = share @ vectors[buckets]
                z = hidden @ out + bias
                p = np.exp(z - z.max())
                grad = p / p.sum()
                grad[label] -= 1
                back = out @ grad
                out -= lr * np.outer(hidden, grad)
                bias -= lr * 0.1 * grad
                vectors[buckets] -= (lr * min(50.0, len(buckets)) * share)[:, None] * back
        return cls((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))

    def score_texts(self, texts: pa.Array) -> np.ndarray:
        got = [np.zeros(0)]
        for part in slices(plain(texts), CHUNK):
            words, at, offsets = words_of(part)
            word, bucket = word_features(words, SIZES, BITS)
            total = np.bincount(word, weights=self.weights[bucket], minlength=len(words))
            number = np.bincount(word, minlength=len(words)).astype(np.float64)
            again = REPEAT_WEIGHT * sums_by_text(repeated(at, offsets), offsets)
            margin = (sums_by_text(total[at], offsets) + self.weights[REPEAT] * again) / np.maximum(1, sums_by_text(number[at], offsets) + again) + self.bias
            got.append(1 / (1 + np.exp(-np.clip(margin, -60, 60))))
        return np.concatenate(got)

    def score(self, spark: SparkSession, text: Column) -> Column:
        """The probability of label 1, for empty texts too; null counts as empty."""
        held = spark.sparkContext.broadcast((self.weights, self.bias))  # 2**BITS numbers

        @F.arrow_udf("double")
        def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = SubwordModel(*held.value)
            for texts in batches:
                yield pa.array(model.score_texts(texts), pa.float64())

        return scores(text)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: tuple[int, int] = (4, 2), sample: int = SAMPLE) -> SubwordModel:
    """Fits on `sample` labelled rows at most, the first by a hash of doc_id among those whose crc32 isn't held out.

    Null ids and labels are left out; of several labels of one id the largest counts, of several texts the least.
    """
    mod, out = held_out
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod("doc_id", mod) != out))
    chosen = known.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # `sample` rows at most
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    got = rows.select("doc_id", "label", feature_counts(F.col("text")).alias("f")).select("doc_id", "label", "f.*").toArrow().sort_by("doc_id")
    return SubwordModel.fit([(b.values.to_numpy(), c.values.to_numpy(), y.as_py()) for b, c, y in zip(got["buckets"], got["counts"], got["label"], strict=True)])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted (1 if score >= threshold). Only the text enters a score.

    Null and empty texts get the score of no features; texts of any length are read whole. Repeated rows give repeated
    results, an empty table an empty one; without labels all scores are 1. Other columns are ignored, whatever their names.
    """
    model = learn(docs, labels)
    rows = docs.select("doc_id", (crc32_mod("doc_id", 4) == 2).alias("held_out"), model.score(docs.sparkSession, whole_text()).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
