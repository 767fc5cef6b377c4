"""Names and written tables that operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from larkspan.streaming.run import checkpoint_folder


def fresh(*bases: str, beside: tuple[DataFrame, ...], names: Iterable[str] = ()) -> list[str]:
    """A column name for each of `bases` that none of the tables has, nor `names`."""
    taken, out = {c.lower() for own in (names, *(df.columns for df in beside)) for c in own}, []
    for base in bases:
        while base.lower() in taken:
            base = f"_{base}"
        taken.add(base.lower())
        out.append(base)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` in files of the shared folder: its lineage ends there, and a retried task finds the same rows."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._larkspan_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes the files of written() tables of which nothing will be read any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._larkspan_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
