"""Tables written between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where that is unset, one in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


#: Row groups of tables with long rows: a reader holds a whole group at once.
SMALL_GROUPS = {"parquet.block.size": str(8 << 20), "parquet.page.size.row.check.min": "4"}


def stored(df: DataFrame, name: str, long_rows: bool = False) -> DataFrame:
    """The rows, written once as Parquet and read again: the plan behind them is cut, lost executors cost nothing."""
    spark = df.sparkSession
    prepare(spark)
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**(SMALL_GROUPS if long_rows else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of text in a bucket; a bucket is read by one task.
BUCKET = 32 << 20


def stored_by(df: DataFrame, key: str, name: str, size: int) -> DataFrame:
    """The rows, `size` bytes of text, written once in buckets of a key: later joins on it move only the other side."""
    spark = df.sparkSession
    prepare(spark)
    mark = f"{name}_{uuid.uuid4().hex[:12]}"
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{mark}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(mark)
    return spark.table(mark)


#: Bytes of rows that go to a Python worker at once; one longer row goes alone.
BATCH = "4m"
#: Settings of Python workers: memory that a step no longer needs goes back to the system.
WORKERS = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "8388608", "MALLOC_TRIM_THRESHOLD_": "8388608", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def prepare(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, and let them get rows in batches of bounded size.

    A session may have a limit of its own for batches. Every function of this package that makes workers calls this first:
    what they are to import is fixed when their step is made.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64m", "64MB", "67108864", "67108864b"):
        spark.conf.set(key, BATCH)
    context = spark.sparkContext
    for name, value in WORKERS.items():
        context.environment.setdefault(name, value)
    if getattr(context, "_ledgerlake_sent", None) != context.applicationId:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.TemporaryDirectory(prefix="ledgerlake-")
        packed = os.path.join(folder.name, "ledgerlake_workers.zip")
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(packed)
        context._ledgerlake_sent = context.applicationId
        context._ledgerlake_package = folder  # the driver sends the file from here as long as the context lives
