"""MERGE, history and change sets for tables without a row-level catalog: each gives the new table as a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspan.operators.shared import discard, fresh, written


def merge(target: DataFrame, changes: DataFrame, on: Sequence[str], delete: Column | None = None) -> DataFrame:
    """`target` after MERGE with `changes` (of its columns): matched rows take the change, new rows are added.

    delete: a condition over the changes' columns; rows that match such a change go, and it adds none. A key that occurs
    twice among the changes is an error in SQL; here the caller makes keys unique, see latest(). Null keys match nothing.
    """
    gone = F.lit(False) if delete is None else F.coalesce(delete, F.lit(False))
    new = changes.select(*target.columns, gone.alias("__gone"))
    untouched = target.join(new.select(*on), list(on), "left_anti")
    return untouched.unionByName(new.where("NOT __gone").drop("__gone"))


def merge_partitions(path: str, changes: DataFrame, on: Sequence[str], partition: str, delete: Column | None = None) -> DataFrame:
    """MERGE into the Parquet table at `path`, which has a folder for each value of `partition`, rewriting only the folders that the changes touch; gives the new table.

    Touched are the folders that hold a changed key and those that changed rows go to, as a change may move a row. Their
    new rows are written aside first and then put in their place by a dynamic overwrite; a folder that ends empty is
    deleted. All other files stay as they are. Keys, nulls and `delete` count as in merge(); a key that occurs twice in
    the table has both rows replaced. Without changes nothing is written.
    """
    spark = changes.sparkSession
    target = spark.read.parquet(path)
    changed = written(changes.select(*target.columns, *[] if delete is None else [F.coalesce(delete, F.lit(False)).alias(fresh("gone", beside=(changes,))[0])]), "changes")
    gone = F.lit(False) if delete is None else F.col(changed.columns[-1])
    touched = target.join(changed.select(*on).distinct(), list(on), "left_semi").select(partition).union(changed.where(~gone).select(partition)).distinct()
    touched = written(touched, "touched")  # a row for each folder at most
    inside = F.col("t").eqNullSafe(F.col(partition))
    rows = target.join(touched.select(F.col(partition).alias("t")), inside, "left_semi")
    new = written(merge(rows, changed.select(*target.columns, gone.alias("gone_now")), on, F.col("gone_now")), "merged")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    empty = touched.join(new.select(F.col(partition).alias("t")).distinct(), inside, "left_anti")
    for name in [f"{partition}={r[0] if r[0] is not None else '__HIVE_DEFAULT_PARTITION__'}" for r in empty.select(F.col(partition).cast("string")).collect()]:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    discard(changed, touched, new)
    spark.catalog.refreshByPath(path)
    return spark.read.schema(target.schema).parquet(path)


def latest(changes: DataFrame, on: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order: a group limit, not a sort of all."""
    w = Window.partitionBy(*on).orderBy(*order)
    return changes.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def history(changes: DataFrame, on: Sequence[str], time: str, tracked: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """A slowly changing dimension (type 2): one row for each run of equal `tracked` values, with valid_from, valid_to and is_current.

    Changes of one time come by `tie`, then by the hash of all columns, so that each run gives the same rows.
    """
    w = Window.partitionBy(*on).orderBy(time, *tie, F.xxhash64(*changes.columns))
    value = F.struct(*tracked)
    turns = changes.withColumn("__same", F.coalesce(value.eqNullSafe(F.lag(value).over(w)), F.lit(False))).where("NOT __same")
    until = F.lead(time).over(w)
    return turns.select(*on, *tracked, F.col(time).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current"))


def difference(old: DataFrame, new: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys that differ, with change: insert, delete or update. One shuffle by key. A null key equals a null key, a null value only a null value."""
    rest = [c for c in new.columns if c not in on]
    a = old.select(*(F.col(c).alias(f"__a{i}") for i, c in enumerate(on)), F.struct(F.lit(1).alias("__in"), *rest).alias("__a"))
    b = new.select(*(F.col(c).alias(f"__b{i}") for i, c in enumerate(on)), F.struct(F.lit(1).alias("__in"), *rest).alias("__b"))
    same = reduce(Column.__and__, (F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}")) for i in range(len(on))))
    kind = F.when(F.col("__a").isNull(), "insert").when(F.col("__b").isNull(), "delete").when(~F.col("__a").eqNullSafe(F.col("__b")), "update")
    return a.join(b, same, "full").select(*(F.coalesce(f"__a{i}", f"__b{i}").alias(c) for i, c in enumerate(on)), kind.alias("change")).where("change IS NOT NULL")
