"""Keys, de-duplication and lookups that hold up when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ledgerlake.session import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the greatest by `order_by`, ties settled by all other columns.

    Ranks are limited to the first before the shuffle, so each map task reduces a
    hot key to one row. Ties go column by column: a struct of them would travel as a second copy of each row.
    """
    given = {*keys, *[c for c in order_by if isinstance(c, str)]}
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ties = [F.desc(c) for c in df.columns if c not in given]
    first = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order], *ties, *([] if order or ties else list(keys)))
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str) -> DataFrame:
    """Gap-free numbers 1..n in the given order, without a one-task window.

    The rows are range-partitioned and written once, each with its partition and
    its place there. One small count per partition then gives the offset that the
    partition's own numbering starts from. Runs one job for the written table.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = stored(placed.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_id", _ROW_BITS)
    # One row per shuffle partition, whatever the table's size.
    sizes = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.select((F.col("_offset") + row + 1).alias(name), *df.columns)


def surrogate_key(df: DataFrame, natural_key: str | Sequence[str], name: str) -> DataFrame:
    """Surrogate key in natural-key order, at any size."""
    return number_rows(df, [natural_key] if isinstance(natural_key, str) else natural_key, name)


def small_surrogate_key(df: DataFrame, natural_key: str, name: str) -> DataFrame:
    """The same for tables whose row count is bounded by a rule list, such as channels."""
    return df.select(F.row_number().over(Window.orderBy(natural_key)).cast("long").alias(name), "*")


def current_rows(dim: DataFrame, flag: str = "eh_registro_atual") -> DataFrame:
    return dim.where(F.col(flag))


# Rows of one key that a task takes; the rows of a key with more are spread over as many parts as that asks for.
PART_ROWS = 1 << 20


def _counted_keys(fact: DataFrame, key: str, part_rows: int) -> tuple[DataFrame, int]:
    """The hot keys, and the rows of all keys, seen while those are counted."""
    seen = Observation()
    counts = fact.groupBy(key).agg(F.count("*").alias("_n")).observe(seen, F.sum("_n").alias("rows"))
    hot = counts.where(F.col("_n") > part_rows).select(key, F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts"))
    return stored(hot, "hot_keys"), seen.get["rows"] or 0


def hot_keys(fact: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Keys with more than `part_rows` rows, NULL among them, and the parts to spread them over.

    There are fewer of them than tasks of that many rows, so they fit everywhere. They are counted in a scan of that column
    alone and written once.
    """
    return _counted_keys(fact, key, part_rows)[0]


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df`, one side of a join on `keys` over `rows` rows, in tasks of about `PART_ROWS` of them.

    Left to Spark where the session shuffles into enough tasks for that; else a task would take a share of the table, and
    its sort would spill the more, the larger the table.
    """
    parts = -(-rows // PART_ROWS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    part_rows: int | None = None,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join a fact to a dimension that has one row per key.

    Rows without a key match nothing; in a left join they are spread by the hash of `spread_by` (all columns by default)
    over as many parts as the session shuffles into, so that they do not go to one task. With `part_rows` keys are counted
    first: a key with more rows, or all rows without one, are spread over parts of that size, and the one dimension row
    of a spread key is repeated for each of its parts. The rows themselves are read and shuffled once, into tasks of
    about `PART_ROWS`. Nothing is salted at random, so a retried task sees the same rows.
    """
    mark = F.xxhash64(*(spread_by or fact.columns))
    if part_rows is None:
        if how == "inner":
            return fact.join(dim, key)
        parts = F.lit(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        rows = fact.withColumn("_part", F.when(F.col(key).isNull(), F.pmod(mark, parts)).otherwise(0).cast("int"))
        return rows.join(dim.withColumn("_part", F.lit(0)), [key, "_part"], how).drop("_part")
    counted, total = _counted_keys(fact, key, part_rows)
    hot = F.broadcast(counted.withColumnRenamed(key, "_hot"))
    marked = fact.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left")
    rows = marked.withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod(mark, F.col("_parts"))).otherwise(0).cast("int"))
    every = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    sides = dim.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_part", F.explode(every)).drop("_hot", "_parts")
    both = [dealt(side, total, key, "_part") for side in (rows.drop("_hot", "_parts"), sides)]
    return both[0].join(both[1], [key, "_part"], how).drop("_part")
