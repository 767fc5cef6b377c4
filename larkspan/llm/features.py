"""Hashed word and character n-gram features of the distinct words of texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts without nulls: distinct white-space separated words, the index of each word in turn, and where each text's words begin (one more for the end)."""
    split = pc.utf8_split_whitespace(texts)
    offsets = split.offsets.to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), offsets - offsets[0]


def word_features(words: list[str], sizes: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word index, bucket) of each feature: the byte n-grams of <word> of each size, in which those at < or > are its affixes, then the whole word. The empty word has none."""
    coded = [f"<{w}>".encode("utf-8", "replace") for w in words]
    lens = np.fromiter(map(len, coded), np.int64, len(coded))
    buf = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    word = np.repeat(np.arange(len(coded)), lens)
    left = ends[word] - np.arange(n)
    where, bucket = [], []
    with np.errstate(over="ignore"):
        def put(which: np.ndarray, h: np.ndarray, salt: int) -> None:
            where.append(which)
            bucket.append(((h ^ np.uint64(salt * 0x51ED27)) * SPREAD >> np.uint64(64 - bits)).astype(np.int64))

        h = np.zeros(n, np.uint64)
        for size in range(1, min(max(sizes), n) + 1):
            h[: n - size + 1] = h[: n - size + 1] * BASE + buf[size - 1 :]
            if size in sizes:
                ok = left >= size
                if size == 2:
                    ok &= lens[word] > 2
                put(word[ok], h[ok], size)
        powers = np.cumprod(np.full(int(lens.max()), BASE, np.uint64))
        whole = np.add.reduceat((buf + np.uint64(1)) * powers[left - 1], ends - lens)
        full = np.flatnonzero(lens > 2)
        put(full, whole[full], 99)
    where, bucket = np.concatenate(where), np.concatenate(bucket)
    keep = lens[where] > 2
    return where[keep], bucket[keep]


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the values of each text; 0 for a text without."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out
