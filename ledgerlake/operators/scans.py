"""Running and trailing aggregates over a whole table in order, without a window that sees it all in one task.

The rows are range-partitioned and written once. One total per partition gives each partition what stands before it; the
last few rows of a partition are handed on to those that follow. Windows then run within partitions only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import stored

PART, PLACE, HANDED = "_part", "_place", "_handed"


@dataclass(frozen=True)
class Fold:
    """An aggregate whose results over neighbouring stretches can be joined."""

    over: Callable[[Column], Column]
    joined: Callable[[Column, Column], Column]
    nothing: Column | int | float


SUM = Fold(F.sum, lambda a, b: a + b, 0)
PRODUCT = Fold(F.product, lambda a, b: a * b, 1.0)


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows in range partitions, written, with the number of their partition."""
    return stored(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()), "ranges")


def _before(ranges: DataFrame, values: dict[str, tuple[Fold, Column]]) -> DataFrame:
    """Of each partition, what all partitions before it come to: a row for each partition."""
    totals = ranges.groupBy(PART).agg(*[fold.over(value).alias(name) for name, (fold, value) in values.items()])
    ahead = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(PART, *[F.coalesce(fold.over(F.col(name)).over(ahead), F.lit(fold.nothing)).alias(name) for name, (fold, _) in values.items()])


def running(df: DataFrame, order: Sequence[str], values: dict[str, tuple[Fold, Column]]) -> DataFrame:
    """Each named value folded from the first row to the row itself. The order should tell all rows apart."""
    ranges = in_ranges(df, order)
    before = _before(ranges, {f"_before_{name}": v for name, v in values.items()})
    inside = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranges.join(F.broadcast(before), PART)
    folded = {name: fold.joined(F.col(f"_before_{name}"), F.coalesce(fold.over(value).over(inside), F.lit(fold.nothing))) for name, (fold, value) in values.items()}
    return rows.select(*df.columns, *[column.alias(name) for name, column in folded.items()])


def trailing(df: DataFrame, order: Sequence[str], values: dict[str, tuple[Fold, Column]], rows: int) -> DataFrame:
    """Each named value folded over the last `rows` rows up to the row itself.

    A partition may be shorter than that, so a row is handed on to every partition that begins within the next `rows` - 1 places.
    """
    ranges = in_ranges(df, order)
    starts = _before(ranges, {"_start": (SUM, F.lit(1))})
    last = Window.partitionBy(PART).orderBy(*[F.col(c).desc() for c in order])
    ends = ranges.withColumn("_from_end", F.row_number().over(last)).where(F.col("_from_end") < rows)  # limited before it is sorted
    sizes = ranges.groupBy(PART).agg(F.count("*").alias("_n"))
    placed = ends.join(F.broadcast(sizes.join(starts, PART)), PART).withColumn(PLACE, F.col("_start") + F.col("_n") - F.col("_from_end"))
    handed = placed.withColumn("_start", F.explode(F.sequence(F.col(PLACE) + 1, F.col(PLACE) + rows - 1))).drop(PART, "_n", "_from_end", PLACE)
    halo = handed.join(F.broadcast(starts), "_start").select(*df.columns, PART, F.lit(True).alias(HANDED)) if rows > 1 else None
    whole = ranges.select(*df.columns, PART, F.lit(False).alias(HANDED))
    whole = whole if halo is None else whole.unionByName(halo)
    frame = Window.partitionBy(PART).orderBy(*order).rowsBetween(-(rows - 1), 0)
    folded = [fold.over(value).over(frame).alias(name) for name, (fold, value) in values.items()]
    return whole.select(*df.columns, HANDED, *folded).where(~F.col(HANDED)).drop(HANDED)
