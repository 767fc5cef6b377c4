"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list."""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.chunks import ChunkEncoder, gather, plain, slices
from larkspan.llm.common import whole_text

# The pre-tokenizer's published pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Pre-tokens whose ids are kept, and their longest.
MEMO, MEMO_LENGTH = 50_000, 24


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class BytePairCoder:
    """Reads a tokenizers JSON file of a byte-level BPE without normalizer, prefix space or dropout."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only a plain byte-level BPE is read")
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        raw = {t: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t in model["vocab"]}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings = {i: raw[t] for t, i in model["vocab"].items()} | {i: t.encode() for t, i in self.special.items()}
        self.first = [model["vocab"][c] for c in letters]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        v = model["vocab"]
        #: (left id, right id) as one number -> (rank, merged id)
        self.merges = {v[a] << 32 | v[b]: (rank, v[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.splits = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.memo: dict[str, bytes] = {}
        # all vocabulary strings one after the other; an id without one has no bytes
        size = max(self.strings, default=-1) + 1
        coded = [self.strings.get(i, b"") for i in range(size)]
        self.lens = np.fromiter(map(len, coded), np.int64, size)
        self.starts, self.pool = np.cumsum(self.lens) - self.lens, np.frombuffer(b"".join(coded), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. The queue holds (rank, position, left id, right id); an entry whose symbols have changed since is stale and skipped."""
        sym = [self.first[b] for b in piece]
        n = len(sym)
        if n < 2:
            return sym
        merges = self.merges
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [(m[0], i, sym[i], sym[i + 1], m[1]) for i in range(n - 1) if (m := merges.get(sym[i] << 32 | sym[i + 1]))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            if sym[i] != left or (j := after[i]) < 0 or sym[j] != right:
                continue
            sym[i], sym[j] = made, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if m := merges.get(made << 32 | sym[k]):
                    heapq.heappush(queue, (m[0], i, made, sym[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get(sym[h] << 32 | made)):
                heapq.heappush(queue, (m[0], h, sym[h], made, m[1]))
        return [s for s in sym if s >= 0]

    def plain_bytes(self, text: str) -> bytes:
        """Packed ids of a text in which special tokens are ordinary text."""
        found, memo = [], self.memo
        for part in self.splits.findall(text):
            v = memo.get(part)
            if v is None:
                ids = self.merge(part.encode())
                v = struct.pack(f"<{len(ids)}I", *ids)
                if len(part) <= MEMO_LENGTH:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[part] = v
            found.append(v)
        return b"".join(found)

    def encode_bytes(self, text: str) -> bytes:
        """Packed ids of a text; the strings of special tokens become their ids."""
        if not self.specials or not self.specials.search(text):
            return self.plain_bytes(text)
        out, last = [], 0
        for m in self.specials.finditer(text):
            out += [self.plain_bytes(text[last : m.start()]), struct.pack("<I", self.special[m[0]])]
            last = m.end()
        return b"".join([*out, self.plain_bytes(text[last:])])

    def encode_many(self, texts: list[str]) -> list[bytes]:
        return [self.encode_bytes(t) for t in texts]

    def decode_many(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[str]:
        """The texts of runs of ids: concatenated vocabulary strings, in which bytes that aren't UTF-8 become replacement characters."""
        if len(ids) and int(ids.max()) >= len(self.lens):
            raise IndexError(int(ids.max()))
        lens = self.lens[ids]
        data, ends = gather(self.pool, self.starts[ids], lens).tobytes(), np.concatenate([[0], np.cumsum(lens)])
        last = 0
        for end in np.cumsum(counts).tolist():
            yield data[ends[last] : ends[end]].decode("utf-8", "replace")
            last = end

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        return next(self.decode_many(ids, np.array([len(ids)])))


@lru_cache(maxsize=2)
def coder(path: str) -> tuple[BytePairCoder, ChunkEncoder]:
    bpe = BytePairCoder(path)
    return bpe, ChunkEncoder(bpe.encode_many, tuple(bpe.special))


def encode_column(text: Column, path: str) -> Column:
    """Token ids of each text, an array<int>. A null is the empty text, whose array is empty."""

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, encode = coder(path)
        for texts in batches:
            got = [encode(part) for part in slices(plain(texts))]
            counts = np.concatenate([np.zeros(1, np.int64), *(c for c, _ in got)])
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(counts).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *(i.astype(np.int32) for _, i in got)])))

    return ids_of(text)


def decode_column(ids: Column, path: str) -> Column:
    """The text of each id array; null for null."""

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe, _ = coder(path)
        for arrays in batches:
            yield pa.array([None if x.as_py() is None else bpe.decode(x.values.to_numpy()) for x in arrays], pa.string())

    return text_of(ids)


def digest_column(text: Column, path: str) -> Column:
    """struct(n_tokens, ids_sha256, decoded_sha256): encodes each text, decodes its ids, and keeps digests of both."""

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe, encode = coder(path)
        for texts in batches:
            n, a, b = [], [], []
            for part in slices(plain(texts)):
                counts, ids = encode(part)
                last = 0
                for end, text in zip(np.cumsum(counts).tolist(), bpe.decode_many(ids, counts), strict=True):
                    n.append(end - last)
                    a.append(hashlib.sha256(ids[last:end].tobytes()).hexdigest())
                    b.append(hashlib.sha256(text.encode()).hexdigest())
                    last = end
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of `docs`, with a null text as the empty one: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Rows keep their number: repeated rows give repeated results, an empty table an empty one; other columns are ignored.
    """
    return docs.select("doc_id", digest_column(whole_text(), path).alias("d")).select("doc_id", "d.*")
