"""Tables of blocks: a source and sink of its own, with filters that skip blocks, commits, and a stream of what is committed.

A table is a folder. `data` holds Arrow files, whose record batches are the blocks. Each commit adds a manifest, numbered
from 1, that names its files and, for each block, its rows and each plain column's least and greatest value and nulls.
Only what a manifest names exists for readers: a task that fails, or a job that is given up, leaves nothing to see, and
its files are deleted, but for one of a task that is killed while it writes. One job writes at a time.

    spark.dataSource.register(BlocksSource)
    df.write.format("blocks").option("path", p).option("block_rows", 10000).mode("append").save()
    spark.read.format("blocks").option("path", p).load().where("page_id < 100")
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def manifests(path: str) -> list[tuple[int, str]]:
    """The numbers and files of all commits, in order."""
    system, root = place(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    return sorted((int(f.base_name.removesuffix(".json")), f.path) for f in found if f.base_name.endswith(".json"))


def load(path: str, after: int = 0, until: int | None = None) -> list[dict]:
    system, _ = place(path)
    out = []
    for n, name in manifests(path):
        if n > after and (until is None or n <= until):
            with system.open_input_stream(name) as f:
                out.append({"version": n, **json.loads(f.read())})
    return out


def current(path: str) -> list[dict]:
    """The commits that make the table now: the last that replaces it, and those after."""
    known = load(path)
    first = max([i for i, m in enumerate(known) if m["replace"]], default=0)
    return known[first:]


@dataclass
class Blocks(InputPartition):
    """Some blocks of one file."""

    file: str
    blocks: list[int]


@dataclass
class Written(WriterCommitMessage):
    file: str
    blocks: list[dict]


def nullable(schema: object) -> object:
    """A schema's JSON in which all is nullable: a later commit may have nulls where an earlier one has none."""
    if isinstance(schema, list):
        return [nullable(x) for x in schema]
    if isinstance(schema, dict):
        return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else nullable(v) for k, v in schema.items()}
    return schema


def plain_value(x: object) -> bool:
    return isinstance(x, bool | int | float | str) and x == x


def describe(batch: pa.RecordBatch) -> dict:
    """rows, and for each column of numbers or strings low, high and nulls."""
    columns = {}
    for name, column in zip(batch.schema.names, batch.columns, strict=True):
        own = {"nulls": column.null_count}
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type) or pa.types.is_string(column.type):
            ends = pc.min_max(column).as_py()
            if plain_value(ends["min"]) and plain_value(ends["max"]) and not (pa.types.is_floating(column.type) and pc.any(pc.is_nan(column)).as_py()):
                own |= {"low": ends["min"], "high": ends["max"]}
        columns[name] = own
    return {"rows": len(batch), "columns": columns}


def may_hold(block: dict, condition: Filter) -> bool:
    """Whether a block can hold a row for which the condition is true."""
    name = condition.attribute
    own = block["columns"].get(name[0]) if len(name) == 1 else None
    if own is None:
        return True
    if isinstance(condition, IsNull):
        return own["nulls"] > 0
    if own["nulls"] == block["rows"]:
        return False
    if isinstance(condition, IsNotNull) or "low" not in own:
        return True
    values = condition.value if isinstance(condition, In) else (condition.value,)
    if not all(plain_value(v) and isinstance(v, str) == isinstance(own["low"], str) for v in values):
        return True
    low, high = own["low"], own["high"]
    if isinstance(condition, EqualTo | In):
        return any(low <= v <= high for v in values)
    (v,) = values
    return {GreaterThan: high > v, GreaterThanOrEqual: high >= v, LessThan: low < v, LessThanOrEqual: low <= v}[type(condition)]


def read_blocks(path: str, part: Blocks) -> Iterator[pa.RecordBatch]:
    system, root = place(path)
    with system.open_input_file(f"{root}/data/{part.file}") as f:
        reader = pa.ipc.open_file(f)
        for i in part.blocks:
            yield reader.get_batch(i)


def parts_of(commits: list[dict], conditions: list[Filter], most: int) -> list[Blocks]:
    """The blocks that may hold rows, in runs of about `most` rows of one file."""
    out = []
    for file in (f for m in commits for f in m["files"]):
        held, rows = [], 0
        for i, block in enumerate(file["blocks"]):
            if all(may_hold(block, c) for c in conditions):
                held, rows = [*held, i], rows + block["rows"]
                if rows >= most:
                    out.append(Blocks(file["file"], held))
                    held, rows = [], 0
        if held:
            out.append(Blocks(file["file"], held))
    return out


class BlocksReader(DataSourceReader):
    def __init__(self, path: str, most: int):
        self.path, self.most, self.conditions = path, most, []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Blocks without a row that fits are not read. Spark filters the rows of the others, so all filters go back to it."""
        self.conditions = [f for f in filters if isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual | IsNotNull | IsNull)]
        return iter(filters)

    def partitions(self) -> list[Blocks]:
        return parts_of(current(self.path), self.conditions, self.most) or [Blocks("", [])]

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        return read_blocks(self.path, partition) if partition.blocks else iter(())


class BlocksStreamReader(DataSourceStreamReader):
    """Offsets are the numbers of commits; what a commit adds comes once."""

    def __init__(self, path: str, most: int):
        self.path, self.most = path, most

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max((n for n, _ in manifests(self.path)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Blocks]:
        return parts_of(load(self.path, start["version"], end["version"]), [], self.most)

    def read(self, partition: Blocks) -> Iterator[pa.RecordBatch]:
        return read_blocks(self.path, partition)

    def commit(self, end: dict) -> None:
        pass


class _Writer:
    """What batch and stream writers share. Each job has a name that its files begin with."""

    def __init__(self, path: str, schema: StructType, rows: int, replace: bool):
        self.path, self.schema, self.rows, self.replace, self.job = path, nullable(json.loads(schema.json())), rows, replace, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = place(self.path)
        task = TaskContext.get()
        name = f"{self.job}-{task.partitionId():06}-{task.taskAttemptId()}.arrow"
        system.create_dir(f"{root}/data")
        try:
            with system.open_output_stream(f"{root}/data/{name}") as out:
                blocks = self.put(iterator, out)
        except BaseException:
            system.delete_file(f"{root}/data/{name}")
            raise
        if not blocks:
            system.delete_file(f"{root}/data/{name}")
        return Written(name, blocks)

    def put(self, iterator: Iterator[pa.RecordBatch], out: object) -> list[dict]:
        """Writes the rows in blocks, and describes these."""
        blocks, held, size, writer = [], [], 0, None
        for batch in iterator:
            at = 0
            while at < len(batch):
                own = batch.slice(at, self.rows - size)
                held, size, at = [*held, own], size + len(own), at + len(own)
                if size >= self.rows:
                    writer = self.add(held, writer, out, blocks)
                    held, size = [], 0
        if held:
            writer = self.add(held, writer, out, blocks)
        if writer:
            writer.close()
        return blocks

    @staticmethod
    def add(held: list[pa.RecordBatch], writer: object, out: object, blocks: list[dict]) -> object:
        block = pa.concat_batches(held)
        writer = writer or pa.ipc.new_file(out, block.schema)
        writer.write_batch(block)
        blocks.append(describe(block))
        return writer

    def record(self, messages: list[Written | None], mark: str | None = None) -> None:
        """A new manifest appears at once, by a rename. mark: a batch of a stream, which is recorded once."""
        system, root = place(self.path)
        if mark and any(m.get("mark") == mark for m in load(self.path)):
            self.forget()
            return
        system.create_dir(f"{root}/commits")
        version = max((n for n, _ in manifests(self.path)), default=0) + 1
        files = [{"file": m.file, "blocks": m.blocks} for m in messages if m and m.blocks]
        with system.open_output_stream(f"{root}/commits/{self.job}.tmp") as f:
            f.write(json.dumps({"schema": self.schema, "replace": self.replace, "mark": mark, "files": files}).encode())
        system.move(f"{root}/commits/{self.job}.tmp", f"{root}/commits/{version:08}.json")
        kept = {f["file"] for f in files}
        self.forget(kept)

    def forget(self, kept: frozenset | set = frozenset()) -> None:
        """Deletes the job's files, also those of failed attempts, but for the ones kept."""
        system, root = place(self.path)
        for f in system.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)):
            if f.base_name.startswith(self.job) and f.base_name not in kept:
                system.delete_file(f.path)


class BlocksWriter(_Writer, DataSourceArrowWriter):
    def commit(self, messages: list[Written | None]) -> None:
        self.record(messages)

    def abort(self, messages: list[Written | None]) -> None:
        self.forget()


class BlocksStreamWriter(_Writer, DataSourceStreamArrowWriter):
    def __init__(self, path: str, schema: StructType, rows: int, query: str):
        super().__init__(path, schema, rows, False)
        self.query = query

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.record(messages, f"{self.query}/{batchId}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.forget()


class BlocksSource(DataSource):
    """Options: path; block_rows (rows of a block, 10,000) and query (a name that tells a stream's batches from others') for writers; split_rows (rows of a task, 100,000) for readers."""

    @classmethod
    def name(cls) -> str:
        return "blocks"

    def schema(self) -> StructType:
        known = load(self.options["path"])
        if not known:
            raise ValueError(f"no table of blocks at {self.options['path']}")
        return StructType.fromJson(known[-1]["schema"])

    def reader(self, schema: StructType) -> BlocksReader:
        return BlocksReader(self.options["path"], int(self.options.get("split_rows", 100_000)))

    def streamReader(self, schema: StructType) -> BlocksStreamReader:
        return BlocksStreamReader(self.options["path"], int(self.options.get("split_rows", 100_000)))

    def writer(self, schema: StructType, overwrite: bool) -> BlocksWriter:
        return BlocksWriter(self.options["path"], schema, int(self.options.get("block_rows", 10_000)), overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> BlocksStreamWriter:
        return BlocksStreamWriter(self.options["path"], schema, int(self.options.get("block_rows", 10_000)), self.options.get("query", "stream"))


def register_blocks(spark: SparkSession) -> None:
    """Makes the format known, and lets Spark push filters to sources in Python."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(BlocksSource)
