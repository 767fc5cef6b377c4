"""Language identification by a linear-chain conditional random field over words.

Each word has hashed affix, n-gram and lexicon features; learned transitions tie neighbours. Forward-backward gives each
word's language probabilities, also within code-switched text, and a document's language is that of the largest mean.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import crc32_mod, whole_text
from larkspan.llm.features import sums_by_text, word_features, words_of

SIZES, BITS = (2, 3, 4), 16
#: Most labelled rows of a language to learn from, and of all languages, which share them; each language has one at least.
SAMPLE, ROWS = 250, 16_000
#: Most words of a row to learn from, in pieces of PIECE words that lie evenly over its text, and characters of a word: ten
#: times as many in texts of a tenth of the words, as texts without spaces are. A row gives WORDS * LETTERS characters at most.
WORDS, PIECE, LETTERS = 400, 25, 40
#: Bytes of text that are labelled at once with up to four languages; with more of them less, so that the words' numbers take no more room.
CHUNK = 2_000_000
UNKNOWN = "und"


def letters(words: list[str]) -> list[str]:
    """Lower-case letters of each word; empty if it has none."""
    # isalpha() is Unicode's category L, of a character or of all characters of a word
    return [w.lower() if w.isalpha() else "".join(filter(str.isalpha, w)).lower() for w in words]


def chains(lens: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packs sequences, whole, into lanes of about one length: the lane and first step of each, and the lengths of the lanes."""
    lanes = max(1, min(lanes, len(lens)))
    heap, lane, first = [(0, k) for k in range(lanes)], np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
    for i in np.argsort(-lens, kind="stable").tolist():
        held, k = heap[0]
        lane[i], first[i] = k, held
        heapq.heapreplace(heap, (held + int(lens[i]), k))
    return lane, first, np.array([h for h, k in sorted(heap, key=lambda x: x[1])])


def close(begins: np.ndarray, held: np.ndarray) -> None:
    """Lets something begin after the last sequence of each lane, so that nothing flows back from the padding."""
    short = np.flatnonzero(held < len(begins))
    begins[held[short], short] = True


def forward_backward(emit: np.ndarray, begins: np.ndarray, start: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """emit: steps x lanes x labels, potentials. begins: steps x lanes, where a new sequence starts. Scaled forward and backward vectors, and the scales."""
    steps, lanes, k = emit.shape
    ahead, back = np.empty_like(emit), np.empty_like(emit)
    scale = np.empty((steps, lanes, 1))
    a = np.tile(start, (lanes, 1))
    for t in range(steps):
        p = a @ move if t else a
        b = begins[t]
        if t and b.any():
            p[b] = start
        a = p * emit[t]
        scale[t] = a.sum(1, keepdims=True)
        a /= scale[t]
        ahead[t] = a
    b = np.ones((lanes, k))
    for t in range(steps - 1, -1, -1):
        back[t] = b
        b = (b * emit[t]) @ move.T
        b /= b.sum(1, keepdims=True)
        if begins[t].any():
            b[begins[t]] = 1.0
    return ahead, back, scale


@dataclass
class ChainModel:
    """weights: buckets x languages; start, move: scores of a first language and of one after another. lexicon: sorted hashes of known words."""

    langs: list[str]
    weights: np.ndarray
    start: np.ndarray
    move: np.ndarray
    lexicon: np.ndarray

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Affixes and n-grams of each word, and the word itself if the lexicon has it."""
        word, bucket = word_features(words, SIZES, BITS)
        n = sum(1 for w in words if w)
        grams, whole = len(word) - n, bucket[len(word) - n :]
        known = np.isin(whole, self.lexicon)
        return np.concatenate([word[:grams], word[grams:][known]]), np.concatenate([bucket[:grams], whole[known]])

    def emissions(self, words: list[str]) -> np.ndarray:
        word, bucket = self.features(words)
        out = np.stack([np.bincount(word, weights=w, minlength=len(words)) for w in (self.weights[:, j][bucket] for j in range(self.weights.shape[1]))], 1)
        return np.exp(np.clip(out - out.max(1, keepdims=True), -30, 0))

    @classmethod
    def fit(cls, rows: list[tuple[str, str]], epochs: int = 2, batch: int = 64, rate: float = 0.3, seed: int = 7) -> ChainModel:
        """rows: (text, language). Pieces of texts are spliced into sequences, of several languages at times, so that the transitions see switches."""
        langs = sorted({lang for _, lang in rows})
        k = len(langs)
        model = cls(langs, np.zeros((1 << BITS, max(k, 1))), np.zeros(max(k, 1)), np.eye(max(k, 1)), np.zeros(0, np.int64))
        if k < 2:
            return model
        rng, of = np.random.default_rng(seed), {x: i for i, x in enumerate(langs)}
        raw, at, offsets = words_of(pa.array([t for t, _ in rows], pa.large_string()))
        clean = letters(raw)
        words = sorted({w for w in clean if w})
        index = {w: i for i, w in enumerate(words)}
        to = np.array([index.get(w, -1) for w in clean] or [-1])
        word, bucket = word_features(words, SIZES, BITS)
        times = np.bincount(to[at][to[at] >= 0], minlength=len(words))
        n = len(words)
        whole = bucket[len(bucket) - n :]
        model.lexicon = np.unique(whole[times >= 2])
        word, bucket = model.features(words)
        order = np.argsort(word, kind="stable")
        bucket, begin = bucket[order], np.searchsorted(word[order], np.arange(n + 1))
        pieces = []
        for (_, lang), a, b in zip(rows, offsets[:-1], offsets[1:], strict=True):
            own = to[at[a:b]]
            own = own[own >= 0]
            cut = 0
            while cut < len(own):
                step = int(rng.integers(8, 40))
                pieces.append((own[cut : cut + step], of[lang]))
                cut += step
        square_w, square_s, square_m = np.full_like(model.weights, 1e-3), np.full(k, 1e-3), np.full((k, k), 1e-3)
        for _ in range(epochs):
            mix = rng.permutation(len(pieces))
            groups = [mix[i : i + 2] for i in range(0, len(mix), 2)]
            for i in range(0, len(groups), batch):
                seqs = [(np.concatenate([pieces[j][0] for j in g]), np.concatenate([np.full(len(pieces[j][0]), pieces[j][1]) for j in g])) for g in groups[i : i + batch]]
                lens = np.array([len(s) for s, _ in seqs])
                lane, first, held = chains(lens, 16)
                steps, lanes = int(held.max()), len(held)
                grid, gold, begins = np.zeros((steps, lanes), np.int64), np.full((steps, lanes), -1), np.zeros((steps, lanes), bool)
                for (s, y), p, q in zip(seqs, lane, first, strict=True):
                    grid[q : q + len(s), p], gold[q : q + len(s), p], begins[q, p] = s, y, True
                close(begins, held)
                real = gold >= 0
                own, back = np.unique(grid, return_inverse=True)
                sizes = begin[own + 1] - begin[own]
                flat = np.repeat(begin[own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                feats, which = bucket[flat], np.repeat(np.arange(len(own)), sizes)
                scores = np.stack([np.bincount(which, weights=model.weights[feats, j], minlength=len(own)) for j in range(k)], 1)
                emit = np.exp(np.clip(scores - scores.max(1, keepdims=True), -30, 0))[back.reshape(grid.shape)]
                start, move = np.exp(model.start), np.exp(model.move)
                ahead, behind, _ = forward_backward(emit, begins, start, move)
                p = ahead * behind
                p /= p.sum(2, keepdims=True)
                truth = np.zeros_like(p)
                truth[real, gold[real]] = 1
                diff = (truth - p) * real[:, :, None]
                by_word = np.stack([np.bincount(back.ravel(), weights=diff[:, :, j].ravel(), minlength=len(own)) for j in range(k)], 1)
                grad = np.stack([np.bincount(feats, weights=by_word[which, j], minlength=1 << BITS) for j in range(k)], 1)
                inner = real[1:] & real[:-1] & ~begins[1:]
                joint = ahead[:-1, :, :, None] * move * (emit[1:] * behind[1:])[:, :, None, :]
                joint /= joint.sum((2, 3), keepdims=True)
                gm = np.zeros((k, k))
                np.add.at(gm, (gold[:-1][inner], gold[1:][inner]), 1.0)
                gm -= joint[inner].sum(0)
                gs = diff[begins].sum(0)
                touched = np.unique(feats)
                g = grad[touched] - 1e-4 * model.weights[touched]
                square_w[touched] += g * g
                model.weights[touched] += rate * g / np.sqrt(square_w[touched])
                square_m += gm * gm
                model.move += rate * gm / np.sqrt(square_m)
                square_s += gs * gs
                model.start += rate * gs / np.sqrt(square_s)
        return model

    @property
    def chunk(self) -> int:
        return CHUNK * 4 // max(4, len(self.langs))

    def marginals(self, texts: pa.Array, lanes: int = 128) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of each word that has letters, where each text's words begin, and which words these are of all."""
        raw, at, offsets = words_of(texts)
        clean = letters(raw)
        distinct = sorted(set(clean))
        index = {w: i for i, w in enumerate(distinct)}
        to = np.fromiter((index[w] for w in clean), np.int64, len(clean))
        has = np.fromiter(map(bool, clean), bool, len(clean))
        table = self.emissions(distinct) if distinct else np.ones((0, self.weights.shape[1]))
        kept = has[at] if len(at) else np.zeros(0, bool)
        seq, counts = to[at[kept]], sums_by_text(kept.astype(np.int64), offsets)
        starts = np.concatenate([[0], np.cumsum(counts)])
        full = np.flatnonzero(counts)
        if not len(full):
            return np.zeros((0, self.weights.shape[1])), starts, kept
        lane, first, held = chains(counts[full], lanes)
        steps, wide = int(held.max()), len(held)
        row = np.repeat(first - starts[full], counts[full]) + np.arange(len(seq))
        col = np.repeat(lane, counts[full])
        emit = np.ones((steps, wide, self.weights.shape[1]))
        emit[row, col] = table[seq]
        begins = np.zeros((steps, wide), bool)
        begins[first, lane] = True
        close(begins, held)
        ahead, behind, _ = forward_backward(emit, begins, np.exp(self.start), np.exp(self.move))
        p = ahead[row, col] * behind[row, col]
        return p / p.sum(1, keepdims=True), starts, kept

    def predict_texts(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        langs, scores = [], []
        for part in slices(plain(texts), self.chunk):
            p, starts, _ = self.marginals(part)
            counts = np.diff(starts)
            mean = np.stack([sums_by_text(p[:, j].copy(), starts) for j in range(p.shape[1])], 1) / np.maximum(1, counts)[:, None]
            best = mean.argmax(1)
            for n, j, m in zip(counts, best, mean, strict=True):
                langs.append(self.langs[j] if n and self.langs else UNKNOWN)
                scores.append(min(1.0, float(m[j])) if n and self.langs else 0.0)
        return langs, np.array(scores, float)

    def predict(self, spark: SparkSession, text: Column) -> Column:
        """struct(lang_pred, score); `und` and 0 if a text has no letter."""
        held = spark.sparkContext.broadcast(self)  # 2**BITS numbers a language

        @F.arrow_udf("struct<lang_pred: string, score: double>")
        def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                langs, scores = held.value.predict_texts(texts)
                yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

        return predicted(text)

    def label_words(self, spark: SparkSession, text: Column) -> Column:
        """Each word that has letters with its own language: array<struct<word, lang, score>>, for code-switched text."""
        held = spark.sparkContext.broadcast(self)

        @F.arrow_udf("array<struct<word: string, lang: string, score: double>>")
        def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                rows = []
                for part in slices(plain(texts), held.value.chunk):
                    p, starts, kept = held.value.marginals(part)
                    raw, at, _ = words_of(part)
                    own, best = at[kept], p.argmax(1) if len(p) else np.zeros(0, int)
                    rows += [[{"word": raw[own[i]], "lang": held.value.langs[best[i]], "score": float(p[i, best[i]])} for i in range(a, b)] if held.value.langs else [] for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.array(rows, pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("score", pa.float64())])))

        return labelled(text)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with `value` computed once: written out, it would be computed anew for each element that a lambda is called with."""
    return F.element_at(F.transform(F.array(value), use), 1)


def excerpt(text: str) -> Column:
    """The text, or pieces of it that are WORDS words together. The driver gets no more of any row."""
    n = WORDS // PIECE

    def shortened(split: Column) -> Column:
        most = F.when(F.size(split) <= WORDS // 10, 10 * LETTERS).otherwise(LETTERS)
        return F.transform(split, lambda w: F.substring(w, F.lit(1), most))

    def pieces(words: Column) -> Column:
        evenly = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.slice(words, (F.lit(1) + F.floor((F.size(words) - PIECE) * i / (n - 1))).cast("int"), PIECE))
        return F.array_join(F.when(F.size(words) <= WORDS, words).otherwise(F.flatten(evenly)), " ")

    return once(once(F.split(F.trim(F.col(text)), r"\s+"), shortened), pieces)


def learn(docs: DataFrame, held_out: tuple[int, int] = (3, 1), sample: int = SAMPLE) -> ChainModel:
    """Fits on `sample` rows of each language at most, or an equal share of ROWS, the first by a hash among those whose crc32 isn't held out. Null ids, texts and languages are left out."""
    mod, out = held_out
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (crc32_mod("doc_id", mod) != out)).select("doc_id", "lang", "text")
    share = min(sample, max(1, ROWS // max(1, known.select("lang").distinct().count())))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = known.select("doc_id", "lang").withColumn("rank", rank).where(F.col("rank") <= share).select("doc_id", "lang").distinct()
    # ROWS rows at most, or one of each language
    got = known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "lang", excerpt("text").alias("text")).toArrow().sort_by([("lang", "ascending"), ("doc_id", "ascending")])
    return ChainModel.fit(list(zip(got["text"].to_pylist(), got["lang"].to_pylist(), strict=True)))


def identify_documents(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, lang_pred, score. Only the text enters a prediction.

    Texts that are null, empty or without a letter are `und` with score 0, as are all without any labelled row; texts of
    any length are read whole. Repeated rows give repeated results, equal means the first language by name, an empty
    table an empty result; other columns are ignored, whatever their names.
    """
    model = learn(docs)
    return docs.select("doc_id", (crc32_mod("doc_id", 3) == 1).alias("held_out"), model.predict(docs.sparkSession, whole_text()).alias("p")).select("doc_id", "held_out", "p.*")
