"""Joins of values to tables of ranges, as joins on coarse buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import stored

# Buckets for each range: more of them tell neighbours apart better, fewer repeat long ranges less.
BUCKETS_A_RANGE = 2


def with_band(df: DataFrame, value: str, bands: DataFrame, low: str, high: str, how: str = "left", closed: bool = False) -> DataFrame:
    """The rows with all columns of the range that holds the value: low <= value < high, or <= high where ranges are `closed`.

    A range without a lower or an upper edge is open there. The span of all edges is cut into equal buckets, twice as many as there are
    ranges; a range stands in every bucket that it touches, a value in one, and what lies outside the span in the first or last. So the
    join is one on a small number, whose exact condition is tested afterwards. A value in several ranges gives several rows.
    """
    shape = bands.select(F.col(low).cast("double").alias("l"), F.col(high).cast("double").alias("h"))
    edges = stored(
        shape.agg(
            F.least(F.min("l"), F.min("h")).alias("first"), F.greatest(F.max("l"), F.max("h")).alias("last"), F.count("*").alias("n")
        ).select("first", (F.col("last") - F.col("first")).alias("span"), (F.col("n") * BUCKETS_A_RANGE).alias("n")),
        "edges",
    )
    first, span, n = (edges.select(c).scalar() for c in ("first", "span", "n"))

    def bucket(column: Column, missing: Column) -> Column:
        at = F.floor((column.cast("double") - first) / F.nullif(span, F.lit(0.0)) * n)
        inside = F.greatest(F.lit(0).cast("long"), F.least(n - 1, F.coalesce(at, F.lit(0).cast("long"))))
        return F.when(column.isNull(), missing).otherwise(inside)

    touched = F.sequence(bucket(F.col(low), F.lit(0).cast("long")), F.greatest(bucket(F.col(low), F.lit(0).cast("long")), bucket(F.col(high), n - 1)))
    spread = bands.withColumn("_bucket", F.explode(touched)).alias("b")
    rows = df.withColumn("_bucket", bucket(F.col(value), F.lit(None).cast("long"))).alias("r")
    v, l, h = F.col(f"r.{value}"), F.col(f"b.{low}"), F.col(f"b.{high}")
    inside = (l.isNull() | (v >= l)) & (h.isNull() | ((v <= h) if closed else (v < h)))
    joined = rows.join(spread, (F.col("r._bucket") == F.col("b._bucket")) & inside, how)
    return joined.select(*[F.col(f"r.{c}").alias(c) for c in df.columns], *[F.col(f"b.{c}").alias(c) for c in bands.columns])
