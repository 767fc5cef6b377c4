"""Sessions, and the package's code on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What the engine expects of a session. Sizes of partitions are left to adaptive execution.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with SETTINGS; keywords with __ for each dot override them."""
    builder = SparkSession.builder.appName("larkspan")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each Spark context, so that Python functions can import it there."""
    sc = spark.sparkContext
    if getattr(sc, "_larkspan_shipped", False):
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="larkspan-"), "larkspan.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(path)
    sc._larkspan_shipped = True
