"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of a batch that goes to a Python worker, so that a worker's memory doesn't grow with the texts.
BATCH = "4m"


def bounded(spark: SparkSession) -> SparkSession:
    """`spark` with Arrow batches of BATCH, unless the session sets its own size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, BATCH)
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def whole_text(name: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session without it gets a folder of its own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not path:
        held = sc._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="larkspan-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/larkspan/{kind}-{uuid.uuid4().hex}"


def cut(df: DataFrame, kind: str) -> DataFrame:
    """`df` written to the shared folder and read again: its lineage ends there and survives lost executors."""
    path = scratch(df.sparkSession, kind)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._larkspan_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of cut() tables of which nothing will be read any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._larkspan_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def crc32_mod(name: str, n: int) -> Column:
    """crc32 of the column as text, modulo n; 0 for a null."""
    return F.coalesce(F.crc32(F.col(name).cast("string")), F.lit(0)) % n
