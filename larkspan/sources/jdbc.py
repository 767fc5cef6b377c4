"""Databases by JDBC: reads split by the bounds of a column, with filters that the database evaluates."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from larkspan.streaming.run import checkpoint_folder

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def write_table(df: DataFrame, url: str, table: str, driver: str = DERBY, mode: str = "overwrite", batch: int = 5000) -> None:
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("driver", driver).option("batchsize", batch).mode(mode).save()


def read_table(spark: SparkSession, url: str, table: str, column: str, parts: int = 8, driver: str = DERBY) -> DataFrame:
    """The table in `parts` reads of equal spans of a number column, from its least to its greatest value; rows outside or null go to the first and last."""
    plain = spark.read.format("jdbc").option("url", url).option("driver", driver)
    low, high = plain.option("query", f'SELECT min("{column}") AS "a", max("{column}") AS "b" FROM {table}').load().first()
    whole = spark.read.format("jdbc").option("url", url).option("driver", driver).option("dbtable", table)
    if low is None:
        return whole.load()
    # a quoted name: the database would fold a plain one to capitals
    return whole.option("partitionColumn", f'"{column}"').option("lowerBound", low).option("upperBound", high + 1).option("numPartitions", parts).load()


def embedded(rows: DataFrame, table: str, column: str, parts: int = 8) -> DataFrame:
    """`rows` (of numbers) through databases that Derby keeps in the memory of the JVM that reads them, `parts` of them by spans of `column`.

    A database of one JVM is unknown to the others, so none can hold the table for all executors. Here the driver makes one
    with the empty table and saves it in the shared folder; the rows go there as files, and a task that reads a part starts
    a copy of that database, which loads the part's file and evaluates the filters. A task that runs again loads anew. The
    databases last as long as their JVM. The shared folder must be one that Derby can open: a file system's.
    """
    spark = rows.sparkSession
    folder = checkpoint_folder(spark)
    rows.repartitionByRange(parts, column).write.csv(f"{folder}/rows")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/rows")
    files = [f.getPath().toUri().getPath() for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path) if f.getPath().getName().startswith("part-")]
    name = f"larkspan{uuid.uuid4().hex}"
    # without rows there are no tasks: only the driver's database is made
    write_table(rows.where("false"), f"jdbc:derby:memory:{name};create=true", table)
    held = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/empty").toUri().getPath()
    connection = spark._jvm.java.sql.DriverManager.getConnection(f"jdbc:derby:memory:{name}")
    try:
        connection.prepareCall(f"CALL SYSCS_UTIL.SYSCS_BACKUP_DATABASE('{held}')").execute()
    finally:
        connection.close()
    out = []
    for i, file in enumerate(sorted(files)):
        plain = spark.read.format("jdbc").option("url", f"jdbc:derby:memory:{name}-{i};createFrom={held}/{name}").option("driver", DERBY).option("dbtable", table)
        # 1: in place of what the table holds
        out.append(plain.option("sessionInitStatement", f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(null, '{table.upper()}', '{file}', null, null, 'UTF-8', 1)").load())
    return reduce(DataFrame.union, out)
