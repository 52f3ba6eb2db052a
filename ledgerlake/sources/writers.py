"""Writers and table merges. Full refreshes overwrite, so a rerun gives the same table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.keys import latest_per_key
from ledgerlake.operators.quality import Expectation, QualityError
from ledgerlake.session import stored

# The layers of the warehouse.
LAYERS = ("bronze", "silver", "gold", "dq", "staging")


def create_layers(spark: SparkSession, prefix: str = "", layers: Sequence[str] = LAYERS) -> list[str]:
    names = [f"{prefix}{layer}" for layer in layers]
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return names


# Rows that a task sorts for a partitioned table: a bound in rows, as the session's advisory size bounds bytes before they are unpacked.
SORTED_ROWS = 1 << 20


def laid_out(df: DataFrame, partition_by: Sequence[str], rows: int | None = None, split_by: Sequence[str] = ()) -> DataFrame:
    """Rows dealt for a table partitioned by these columns; what is computed from the result is not moved for it.

    One task per partition value would make a hot month a bottleneck, and a task per row group would write many small
    files. Rebalancing lets adaptive execution split big partition values and merge small ones. With `rows`, at least as
    many as there are, a table with enough for every core is dealt by ranges of about `SORTED_ROWS` instead, so that the
    sort of a task fits in little memory; `split_by` parts the rows of one value.
    """
    tasks = -(-(rows or 0) // SORTED_ROWS)
    if tasks > df.sparkSession.sparkContext.defaultParallelism:
        return df.repartitionByRange(tasks, *partition_by, *split_by)
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), placed: bool = False) -> DataFrame:
    """Replace a table, schema included, and hand back the written copy. `placed` rows were dealt by `laid_out` already."""
    dealt = laid_out(df, partition_by) if partition_by and not placed else df
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # The schema is known, so no job has to read it back from the files.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table, schema included; with a path its files lie there, not in the warehouse."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def append(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def compact(spark: SparkSession, source: str, target: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite a table of small files, in the same layout; adaptive execution picks the number of files."""
    df = spark.read.parquet(source)
    return overwrite(df if partition_by else df.hint("rebalance"), target, partition_by)


def write_snapshot(df: DataFrame, folder: str, day: dt.date | str) -> None:
    df.write.mode("overwrite").parquet(f"{folder}/snapshot={day}")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish_files(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A persistent view over written files. Readers of its name go over to the new files at once."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
    return spark.table(view)


def write_gated(df: DataFrame, folder: str, view: str, expectations: Sequence[Expectation]) -> list[dict]:
    """Write into a folder of its own, count rows and failures on the way, and publish only what passed.

    The rows are read once: the counts are observed while they are written. Returns a line for each expectation; where a fatal
    one failed, raises `QualityError`, whose `report` holds them, and the view still shows what was published before.
    """
    path, seen = f"{folder}/{uuid.uuid4().hex}", Observation()
    failed = [F.count_if(~F.coalesce(F.expr(e.condition), F.lit(False))).alias(f"e{i}") for i, e in enumerate(expectations)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *failed).write.parquet(path)
    counts = seen.get
    report = [{"expectativa": e.name, "fatal": e.fatal, "falhas": counts[f"e{i}"], "linhas": counts["rows"]} for i, e in enumerate(expectations)]
    broken = [r for r in report if r["fatal"] and r["falhas"]]
    if broken:
        error = QualityError("; ".join(f"{r['expectativa']}: {r['falhas']} of {r['linhas']} rows" for r in broken))
        error.report = report
        raise error
    publish_files(df.sparkSession, path, view)
    return report


def in_partitions_of(table: DataFrame, rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The table's rows in the partitions that `rows` have a row in; the others are not read."""
    touched = rows.select(*partition_by).distinct()
    values = touched.collect()
    for i, column in enumerate(partition_by):
        table = table.where(F.col(column).isin([r[i] for r in values]))
    return table if len(partition_by) == 1 else table.join(F.broadcast(touched), list(partition_by), "left_semi")


def merge_partitions(path: str, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str], update: Sequence[str]) -> None:
    """Upsert into a partitioned table, reading and rewriting only the partitions that `new` touches.

    The partition columns are part of the key, so no row ever moves to another partition. The values of the touched
    partitions (a row for each, as many as are rewritten) are collected first and prune the scan; the merged rows are written
    aside, then replace those partitions alone. With nothing to update, known keys stay as they are and the others are added.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("the partition columns must be part of the key")
    spark = new.sparkSession
    new = stored(new, "merge_new")
    without = new.where(" OR ".join(f"{c} IS NULL" for c in partition_by)).limit(1).count()
    if without:
        raise QualityError(f"rows to merge have no value in {', '.join(partition_by)}")
    held = in_partitions_of(spark.read.parquet(path), new, partition_by)
    merged = stored(upsert(held, new, keys, update), "merged")
    (
        merged.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    )


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table in buckets of a key: tables with equal buckets are joined and grouped by it without an exchange."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


# Bytes of a bucket, which one task reads.
BUCKET_BYTES = 128 << 20


def buckets_for(rows: int, bytes_a_row: int, least: int = 1) -> int:
    """As many buckets as keep each at about BUCKET_BYTES."""
    return max(least, -(-rows * bytes_a_row // BUCKET_BYTES))


def insert_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target, and the new rows whose key it does not hold yet. Missing columns are NULL.

    Of several new rows with one key the greatest is kept.
    """
    fresh = latest_per_key(new, list(keys), []).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert(
    target: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Existing keys take the new values of `update`; unknown keys are added whole.

    Of several rows of `new` with one key the greatest counts. NULL in `new` overwrites,
    as an update would.
    """
    new = latest_per_key(new, list(keys), [])
    marked = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in new.columns if c not in keys],
                        F.lit(True).alias("_in_new"))
    joined = target.withColumn("_in_old", F.lit(True)).join(marked, list(keys), "full")
    known, given = F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()

    def value(column: str):
        if column in keys or column not in new.columns:
            return F.col(column)
        if column in update:
            return F.when(given, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)
        return F.when(known, F.col(column)).otherwise(F.col(f"_new_{column}")).alias(column)

    return joined.select(*[value(c) for c in target.columns])
