"""Whole texts to token ids by way of their distinct space-separated chunks.

A byte-level pre-tokenizer of the GPT-2 kind never joins a non-space character to the space after it, so a text can be
cut before each space and its chunks encoded apart, unless white space stands on both sides of the space (then a run of
it would be cut in two) or a special token ends a segment. Such texts, which are rare, are encoded whole. A line feed
between characters that aren't white space is a piece of its own: there a text is cut as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are encoded at once.
SLICE = 4_000_000
UNSAFE = r"[\t-\r\x{85}\p{Z}] (?:[\t-\r\x{85}\p{Z}]|\z)"
#: A line feed beside white space, or at an end of the text: such texts are cut at spaces alone.
LOOSE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]\n|\n[\t-\r\x1c-\x1f\x{85}\p{Z}]|\A\n|\n\z"


def gather(pool: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The runs pool[s : s + n], one after the other."""
    total = int(lens.sum())
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    before = np.cumsum(lens) - lens
    where = np.repeat((starts - before).astype(kind), lens)
    where += np.arange(total, dtype=kind)
    return pool[where]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[pa.Array]:
    """Runs of texts of about `most` bytes, at least one text each."""
    at, n = 0, len(texts)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    while at < n:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def plain(texts: pa.Array) -> pa.Array:
    """Without nulls, as large strings, whose offsets don't overflow."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts.cast(pa.large_string()), "")


class Known:
    """Words whose ids are kept from slice to slice: those that a slice had twice. Beyond `limit` the half that was used last stays."""

    def __init__(self, limit: int):
        self.limit, self.turn = limit, 0
        self.words, self.pool = pa.array([], pa.large_string()), np.zeros(0, "<u4")
        self.starts = self.lens = self.used = np.zeros(0, np.int64)

    def ids_of(self, words: pa.Array, counts: np.ndarray, encode: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each of these distinct words begin, how many they are, and the pool that holds them. counts: how often each occurs."""
        self.turn += 1
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        miss, hit = np.flatnonzero(at < 0), np.flatnonzero(at >= 0)
        new = encode(words.take(pa.array(miss)).to_pylist())
        own = np.fromiter(map(len, new), np.int64, len(new)) // 4
        pool = np.concatenate([self.pool, np.frombuffer(b"".join(new), "<u4")])
        starts, lens = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        starts[hit], lens[hit] = self.starts[at[hit]], self.lens[at[hit]]
        starts[miss], lens[miss] = len(self.pool) + np.cumsum(own) - own, own
        self.used[at[hit]] = self.turn
        self.keep(words, miss[counts[miss] > 1], starts, lens, pool)
        return starts, lens, pool

    def keep(self, words: pa.Array, which: np.ndarray, starts: np.ndarray, lens: np.ndarray, pool: np.ndarray) -> None:
        if not len(which):
            return
        held = np.cumsum(lens[which])
        self.words = pa.concat_arrays([self.words, words.take(pa.array(which))])
        self.starts = np.concatenate([self.starts, len(self.pool) + held - lens[which]])
        self.lens, self.used = np.concatenate([self.lens, lens[which]]), np.concatenate([self.used, np.full(len(which), self.turn)])
        self.pool = np.concatenate([self.pool, gather(pool, starts[which], lens[which])])
        if len(self.words) > self.limit:
            last = np.sort(np.argsort(-self.used, kind="stable")[: self.limit // 2])
            self.words, self.pool, self.lens, self.used = self.words.take(pa.array(last)), gather(self.pool, self.starts[last], self.lens[last]), self.lens[last], self.used[last]
            self.starts = np.cumsum(self.lens) - self.lens


class ChunkEncoder:
    """encode: gives the packed little-endian 32-bit ids of each string of a list. special: strings that end a segment. limit: words that are kept."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: tuple[str, ...] = (), limit: int = 300_000):
        self.encode, self.special = encode, special
        # a text's or line's first chunk has no space before it
        self.after_space, self.first = Known(limit), Known(limit)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text: their numbers, and all of them one after the other."""
        texts = plain(texts)
        odd = pc.match_substring_regex(texts, UNSAFE)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        lines = pc.invert(pc.or_(odd, pc.match_substring_regex(texts, LOOSE)))
        split = pc.split_pattern(pc.if_else(odd, "", pc.if_else(lines, pc.replace_substring(texts, "\n", " \n "), texts)), " ")
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        heads = offsets[:-1]
        coded = split.flatten().dictionary_encode()
        words, at = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        feed = pc.index(words, pa.scalar("\n", words.type)).as_py()
        feeds = np.flatnonzero((at == feed) & np.repeat(lines.to_numpy(zero_copy_only=False), np.diff(offsets)))
        bare = np.zeros(len(at), bool)  # chunks without a space before them
        bare[heads] = bare[feeds] = bare[feeds + 1] = True
        first, back = np.unique(at[bare], return_inverse=True)
        at[bare] = len(words) + back
        counts = np.bincount(at, minlength=len(words) + len(first))
        a = self.after_space.ids_of(words, counts[: len(words)], lambda missing: self.encode([" " + w for w in missing]))
        b = self.first.ids_of(words.take(pa.array(first)), counts[len(words) :], self.encode)
        starts, lens, pool = np.concatenate([a[0], len(a[2]) + b[0]]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
        ids = gather(pool, starts[at], lens[at])
        counts = np.add.reduceat(lens[at], heads) if len(heads) else np.zeros(0, np.int64)
        odd = odd.to_numpy(zero_copy_only=False)
        if odd.any():
            where = np.flatnonzero(odd)
            whole = [np.frombuffer(x, "<u4") for x in self.encode(texts.filter(pa.array(odd)).to_pylist())]
            ends = np.cumsum(counts)
            parts, last = [], 0
            for i, x in zip(where, whole, strict=True):
                parts += [ids[last : ends[i]], x]
                last = ends[i]
                counts[i] = len(x)
            ids = np.concatenate([*parts, ids[last:]])
        return counts, ids
