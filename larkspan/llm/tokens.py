"""Token ids in directly addressable codes (DACs).

Each id is split into chunks of a few bits. Level k holds the k-th chunks of the ids that have one; a bitmap says which
ids go on to the next level, and a rank directory with the ones before every 512 bits turns a position on one level
into that on the next. Any id is read from its own chunks alone, without decoding a block.

File format: Parquet files whose rows are segments in ascending (part, seg) order. `codes` is
    b"DAC1", u8 levels, 3 zero bytes, u64 ids, then for each level: u8 bits, 7 zero bytes, u64 entries, u64 bytes of
    chunks, bitmap and directory, then these three: chunks in bits/8 bytes each, the bitmap (least bit first; none on
    the last level), and u32 ones before each 512 bits.
All numbers are little-endian. `doc_ids` and `doc_lens` list the segment's documents, `before` the ids of earlier
segments of the part. A segment ends with a document. Nothing is compressed, and each segment is a row group of its own, so
that the file's footer says where the bytes of its codes lie: TokenFiles reads an id from the few that it needs.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspan.llm.chunks import ChunkEncoder, plain, slices
from larkspan.llm.common import scratch, whole_text

MAGIC, BLOCK = b"DAC1", 512
WIDTHS = (8, 8, 16)


def pack(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """Unsigned 32-bit ids to codes. widths: the bits of each level, 8, 16 or 32; together 32 at least."""
    rest = np.ascontiguousarray(ids, np.uint32)
    out, used = [], 0
    for k, bits in enumerate(widths):
        if k == len(widths) - 1 and int(rest.max(initial=0)) >> bits:
            raise ValueError("ids exceed the levels")
        chunks = rest.astype(f"<u{bits // 8}").tobytes()  # the low bits
        more = rest >> np.uint32(bits) if bits < 32 else np.zeros_like(rest)
        on = more != 0
        bitmap = np.packbits(on, bitorder="little").tobytes()
        ones = np.add.reduceat(on, np.arange(0, len(on), BLOCK), dtype=np.int64) if len(on) else np.zeros(0, np.int64)
        ranks = (np.cumsum(ones) - ones).astype("<u4").tobytes()
        out.append(struct.pack("<B7xQQQQ", bits, len(rest), len(chunks), len(bitmap), len(ranks)) + chunks + bitmap + ranks)
        used += 1
        rest = more[on]
        if not len(rest):
            break
    return struct.pack("<4sB3xQ", MAGIC, used, len(ids)) + b"".join(out)


class Codes:
    """Reads packed ids in place."""

    def __init__(self, data: bytes):
        magic, levels, self.n = struct.unpack_from("<4sB3xQ", data)
        if magic != MAGIC:
            raise ValueError("not DAC1")
        self.levels, at = [], 16
        for _ in range(levels):
            bits, n, a, b, c = struct.unpack_from("<B7xQQQQ", data, at)
            at += 40
            chunks = np.frombuffer(data, f"<u{bits // 8}", n, at)
            bitmap = np.frombuffer(data, np.uint8, b, at + a)
            ranks = np.frombuffer(data, np.uint8, c, at + a + b).view("<u4")
            self.levels.append((bits, chunks, bitmap, ranks))
            at += a + b + c

    def __len__(self) -> int:
        return self.n

    @staticmethod
    def rank(bitmap: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        if i // BLOCK >= len(ranks):
            if not len(ranks):
                return 0
            i = min(i, len(bitmap) * 8)
        block = min(i // BLOCK, len(ranks) - 1)
        own = bitmap[block * BLOCK // 8 : (i + 7) // 8]
        bits = np.unpackbits(own, bitorder="little", count=i - block * BLOCK)
        return int(ranks[block]) + int(bits.sum())

    def get(self, i: int) -> int:
        """The i-th id, from one chunk a level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for bits, chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self.rank(bitmap, ranks, i), shift + bits
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, exclusive: on each level they are a run, whose start the directory gives."""
        a, b = max(0, a), min(b, self.n)
        out, where, shift = np.zeros(max(0, b - a), np.uint32), None, 0
        for bits, chunks, bitmap, ranks in self.levels:
            if b <= a:
                break
            part = chunks[a:b].astype(np.uint32) << np.uint32(shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            on = np.unpackbits(bitmap[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            where = np.flatnonzero(on) if where is None else where[on]
            a = self.rank(bitmap, ranks, a)
            b, shift = a + len(where), shift + bits
        return out


@lru_cache(maxsize=2)
def library_encoder(path: str) -> ChunkEncoder:
    """The tokenizers library, asked once for each distinct chunk."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    special = tuple(t.content for t in tok.get_added_tokens_decoder().values())
    # ids of tokens that begin with a space: in words put together, each with a space before it, they begin the words
    spaced = np.zeros(tok.get_vocab_size(), bool)
    spaced[[i for t, i in tok.get_vocab().items() if t.startswith("\u0120")]] = True

    word = re.compile(r" \S(?:[^ ]*\S)?\Z").match

    def apart(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for i in range(0, len(texts), 500) for e in tok.encode_batch_fast(texts[i : i + 500], add_special_tokens=False)]

    def together(texts: list[str]) -> list[bytes]:
        ids = np.array(tok.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, "<u4")
        begins = np.flatnonzero(spaced[ids])
        if len(begins) != len(texts):
            return apart(texts)
        data, cuts = ids.tobytes(), [*begins.tolist(), len(ids)]
        return [data[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]

    def encode(texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        joined = "".join(texts)
        plain_word = [False] * len(texts) if any(s in joined for s in special) else [bool(word(t)) for t in texts]
        words = [i for i, ok in enumerate(plain_word) if ok]
        for a in range(0, len(words), 100):
            for i, x in zip(words[a : a + 100], together([texts[i] for i in words[a : a + 100]]), strict=True):
                out[i] = x
        rest = [i for i, ok in enumerate(plain_word) if not ok]
        for i, x in zip(rest, apart([texts[i] for i in rest]), strict=True):
            out[i] = x
        return out

    return ChunkEncoder(encode, special)


SEGMENTS = "part int, seg int, before bigint, n_tokens bigint, doc_ids array<bigint>, doc_lens array<bigint>, codes binary"


#: Plain bytes, and a row group for each row.
LAYOUT = {"compression": "none", "parquet.block.size": "1", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment_tokens: int = 1 << 20) -> None:
    """Encodes whole texts (null: empty), appends end_id to each, and writes segments in ascending doc_id order.

    Documents of one doc_id follow by a hash of their text; a null doc_id comes first. An empty table writes no segment.
    A document longer than segment_tokens has a segment of its own.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = library_encoder(tokenizer), TaskContext.get().partitionId()
        seg = before = held = 0
        doc_ids, lens, parts = [], [], []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seg": seg, "before": before, "n_tokens": held, "doc_ids": doc_ids, "doc_lens": lens, "codes": pack(np.concatenate(parts))}],
                pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_lens", pa.list_(pa.int64())), ("codes", pa.binary())]),
            )

        for batch in batches:
            own, at = batch.column(0).to_pylist(), 0
            for texts in slices(plain(batch.column(1))):
                counts, ids = encode(texts)
                last = 0
                for n in counts.tolist():
                    doc_ids.append(own[at])
                    lens.append(n + 1)
                    parts += [ids[last : last + n], np.array([end_id], np.uint32)]
                    held, last, at = held + n + 1, last + n, at + 1
                    if held >= segment_tokens:
                        yield row()
                        seg, before = seg + 1, before + held
                        held, doc_ids, lens, parts = 0, [], [], []
        if doc_ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).withColumn("tie", F.xxhash64("text"))
    coded = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text").mapInArrow(segments, SEGMENTS)
    coded.write.options(**LAYOUT).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Segments with `start`, the ids of all segments before them. The offsets take one row per part, not per document."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    bases = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("base"))
    # one row for each partition that was written: no more than there were tasks
    return files.join(F.broadcast(bases), "part").select("part", "seg", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "doc_ids", "doc_lens", "codes")


def token_rows(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, doc_ids, lens, data in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                codes, at, crcs, starts = Codes(data), 0, [], []
                step = 1 << 16
                held, base, end = codes.slice(0, step), 0, min(step, len(codes))
                for n in lens:
                    if at + n > end:
                        base, end = at, min(at + max(n, step), len(codes))
                        held = codes.slice(base, end)
                    crcs.append(zlib.crc32(held[at - base : at - base + n].astype("<u4").tobytes()))
                    starts.append(start + at)
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(lens, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_token_files(spark, path).select("start", "doc_ids", "doc_lens", "codes").mapInArrow(rows, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


class FarCodes:
    """Packed ids that are read where they lie. read: gives so many bytes from a place."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, levels, self.n = struct.unpack("<4sB3xQ", read(0, 16))
        if magic != MAGIC:
            raise ValueError("not DAC1")
        self.levels, at = [], 16
        for _ in range(levels):
            bits, n, a, b, c = struct.unpack("<B7xQQQQ", read(at, 40))
            self.levels.append((bits, n, at + 40, at + 40 + a, at + 40 + a + b))
            at += 40 + a + b + c

    def rank(self, level: tuple[int, ...], i: int) -> int:
        """Ones before bit i of a level: the directory's number and the bits of one block."""
        _, n, _, bitmap, ranks = level
        block = min(i, n - 1) // BLOCK
        (known,) = struct.unpack("<I", self.read(ranks + 4 * block, 4))
        own = np.frombuffer(self.read(bitmap + block * BLOCK // 8, (i + 7) // 8 - block * BLOCK // 8), np.uint8)
        return known + int(np.unpackbits(own, bitorder="little", count=i - block * BLOCK).sum())

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, exclusive."""
        a, b = max(0, a), min(b, self.n)
        out, where, shift = np.zeros(max(0, b - a), np.uint32), np.arange(max(0, b - a)), 0
        for k, level in enumerate(self.levels):
            if b <= a:
                break
            bits, _, chunks, bitmap, _ = level
            size = bits // 8
            out[where] |= np.frombuffer(self.read(chunks + a * size, (b - a) * size), f"<u{size}").astype(np.uint32) << np.uint32(shift)
            if k == len(self.levels) - 1:
                break
            own = np.frombuffer(self.read(bitmap + a // 8, (b + 7) // 8 - a // 8), np.uint8)
            where = where[np.unpackbits(own, bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)]
            if not len(where):
                break
            a = self.rank(level, a)
            b, shift = a + len(where), shift + bits
        return out


class StoredFile(io.RawIOBase):
    """A file of any store that Spark reads, by positions. `count`: bytes read so far."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        self.jvm, self.size, self.stream = jvm, system.getFileStatus(place).getLen(), system.open(place)
        self.at = self.count = 0

    def take(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        self.stream.seek(at)
        self.count += n
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n)) if n else b""

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, at: int, whence: int = 0) -> int:
        self.at = at + (0, self.at, self.size)[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, buffer: bytearray) -> int:
        data = self.take(self.at, len(buffer))
        buffer[: len(data)] = data
        self.at += len(data)
        return len(data)


class TokenFiles:
    """Any token of written files, by its place among all or in its document, without reading a segment.

    Of each part one row comes to the driver; of a file that is asked for, its footer.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        rows = spark.read.schema(SEGMENTS).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min(F.col("_metadata.file_path")).alias("file"))
        self.parts, self.total = [], 0
        for r in sorted(rows.collect(), key=lambda r: r["part"]):
            self.parts.append((self.total, r["part"], r["file"]))
            self.total += r["n"]
        self.files: dict[str, tuple[StoredFile, list[tuple[int, int, int]]]] = {}

    def segments(self, file: str) -> tuple[StoredFile, list[tuple[int, int, int]]]:
        """The file, and for each segment its first id in the part, its ids and where the pages of its codes begin."""
        if file not in self.files:
            stored, out = StoredFile(self.spark, file), []
            footer = pq.read_metadata(pa.PythonFile(stored, "r"))
            for i in range(footer.num_row_groups):
                columns = {(c := footer.row_group(i).column(j)).path_in_schema: c for j in range(footer.num_columns)}
                if footer.row_group(i).num_rows != 1:
                    raise ValueError("a row group of several segments")
                out.append((columns["before"].statistics.min, columns["n_tokens"].statistics.min, columns["codes"].data_page_offset))
            self.files[file] = stored, out
        return self.files[file]

    @property
    def count(self) -> int:
        """Bytes read of all files so far."""
        return sum(stored.count for stored, _ in self.files.values())

    def tokens(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b, exclusive, of all."""
        out = [np.zeros(0, np.uint32)]
        for at, (base, _, file) in enumerate(self.parts):
            end = self.parts[at + 1][0] if at + 1 < len(self.parts) else self.total
            if base >= b or end <= a:
                continue
            stored, segments = self.segments(file)
            for before, n, page in segments:
                first = base + before
                if first < b and first + n > a:
                    # a page's header ends where the value's length stands, just before the magic
                    head = stored.take(page, 256)
                    begin = page + head.index(MAGIC)
                    out.append(FarCodes(lambda place, size, begin=begin, stored=stored: stored.take(begin + place, size)).slice(a - first, b - first))
        return np.concatenate(out)

    def token_at(self, place: int) -> int:
        if not 0 <= place < self.total:
            raise IndexError(place)
        return int(self.tokens(place, place + 1)[0])

    def tokens_of(self, doc_id: int, a: int = 0, b: int | None = None) -> list[np.ndarray]:
        """The ids a to b, exclusive, of each document of this id; its codes aside, only the lists of documents are read for it."""
        bases = {part: base for base, part, _ in self.parts}
        files = self.spark.read.schema(SEGMENTS).parquet(self.path).select("part", "before", "doc_ids", "doc_lens")
        out = []
        for r in sorted(files.where(F.array_contains("doc_ids", F.lit(doc_id).cast("bigint"))).collect(), key=lambda r: (r["part"], r["before"])):
            start = bases[r["part"]] + r["before"]
            for own, n in zip(r["doc_ids"], r["doc_lens"], strict=True):
                if own == doc_id:
                    out.append(self.tokens(start + max(0, a), start + (n if b is None else min(b, n))))
                start += n
        return out


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Writes the files to a new path in the shared folder and reads them back: doc_id, start, n_tokens, ids_crc32 of each row.

    Nulls, ties and empty tables as write_token_files() says; texts of any length are encoded whole, in slices with others
    or alone. Columns besides doc_id and text are ignored, whatever their names.
    """
    path = scratch(docs.sparkSession, "tokens")
    write_token_files(docs, path, tokenizer, end_id)
    return token_rows(docs.sparkSession, path)
