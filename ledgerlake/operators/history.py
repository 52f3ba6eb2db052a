"""Client history: type-2 merges of dated loads, and lookups of facts in validity intervals.

A version is a row with the first and the last day it holds; the open one ends on `OPEN_END` and is the current one. A load
opens a new version only where a digest of the tracked columns has changed; other columns are those of the version's newest load.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.dates import OPEN_END, day, month_start
from ledgerlake.operators.keys import latest_per_key, number_rows
from ledgerlake.session import stored

START, END, CURRENT = "data_inicio_vigencia", "data_fim_vigencia", "eh_registro_atual"
DIGEST = "_digest"


def digest(columns: Sequence[str]) -> Column:
    """Equal exactly for rows that agree on the columns, NULL being a value of its own."""
    texts = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.sha2(F.concat_ws("|", *parts), 256)


def _opened(rows: DataFrame, start: Column) -> DataFrame:
    return rows.withColumns({START: start, END: F.lit(OPEN_END), CURRENT: F.lit(True)})


def first_versions(load: DataFrame, keys: Sequence[str], tracked: Sequence[str], on: dt.date | str) -> DataFrame:
    """A history of one load: every row current from that day on. Rows without a key are left out."""
    rows = latest_per_key(load, list(keys), []).where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    return _opened(rows.withColumn(DIGEST, digest(tracked)), day(on))


def merge_load(history: DataFrame, load: DataFrame, keys: Sequence[str], tracked: Sequence[str], on: dt.date | str) -> DataFrame:
    """The history after a load of that day.

    Closed versions pass through: only current ones are joined. A key that the load does not hold stays as it is. A changed
    version is closed on the day before and a new one opened; one that was opened on that very day is replaced. A load older
    than a key's current version changes nothing for that key. Of several rows of a key the greatest counts.
    """
    keys = list(keys)
    columns = [c for c in history.columns if c not in (START, END, CURRENT, DIGEST)]
    rest = [c for c in columns if c not in keys]
    new = latest_per_key(load.select(*columns), keys, []).where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    new = new.select(*keys, F.struct(*rest).alias("_new"), digest(tracked).alias("_new_digest"))
    open_rows = history.where(F.col(CURRENT)).select(*keys, F.struct(*rest).alias("_old"), F.col(DIGEST).alias("_old_digest"), F.col(START).alias("_start"))
    both = open_rows.join(new, keys, "full")
    held, given = F.col("_start").isNotNull(), F.col("_new_digest").isNotNull()
    late = held & (F.col("_start") > day(on))
    changed = held & given & ~late & (F.col("_old_digest") != F.col("_new_digest"))
    same_day = changed & (F.col("_start") == day(on))

    def version(row: Column, mark: Column, start: Column, end: Column, current: bool) -> Column:
        return F.struct(row.alias("row"), mark.alias(DIGEST), start.alias(START), end.alias(END), F.lit(current).alias(CURRENT))

    last_day, always = day(on), F.lit(OPEN_END)
    old = version(F.col("_old"), F.col("_old_digest"), F.col("_start"), always, True)
    closed = version(F.col("_old"), F.col("_old_digest"), F.col("_start"), F.date_sub(last_day, 1), False)
    opened = version(F.col("_new"), F.col("_new_digest"), last_day, always, True)
    refreshed = version(F.col("_new"), F.col("_old_digest"), F.col("_start"), always, True)
    versions = (
        F.when(~held, F.array(opened))
        .when(~given | late, F.array(old))
        .when(~changed, F.array(refreshed))
        .when(same_day, F.array(opened))
        .otherwise(F.array(closed, opened))
    )
    touched = both.select(*keys, F.explode(versions).alias("v")).select(*keys, *[F.col(f"v.row.{c}").alias(c) for c in rest], f"v.{DIGEST}", f"v.{START}", f"v.{END}", f"v.{CURRENT}")
    return history.where(~F.col(CURRENT)).unionByName(touched.select(*history.columns))


def history_of(loads: DataFrame, keys: Sequence[str], tracked: Sequence[str], on: str) -> DataFrame:
    """The history of all loads at once, whatever order they come in; `on` is the column with a load's day.

    One row a key and day is left before the window, so a key holds as many rows there as there are days at most.
    """
    keys = list(keys)
    rows = latest_per_key(loads, [*keys, on], []).where(" AND ".join(f"{k} IS NOT NULL" for k in [*keys, on]))
    rows = rows.withColumn(DIGEST, digest(tracked))
    order = Window.partitionBy(*keys).orderBy(on)
    rows = rows.withColumn("_new", F.coalesce(F.lag(DIGEST).over(order) != F.col(DIGEST), F.lit(True)))
    rows = rows.withColumn("_version", F.sum(F.col("_new").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rest = [c for c in loads.columns if c not in (*keys, on)]
    merged = rows.groupBy(*keys, "_version").agg(
        F.min(on).alias(START), F.max(F.struct(F.col(on).alias("_d"), *[F.col(c) for c in rest])).alias("_last"), F.first(DIGEST).alias(DIGEST)
    )
    following = F.lead(START).over(Window.partitionBy(*keys).orderBy(START))
    ended = merged.withColumn(END, F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END)))
    return ended.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest], DIGEST, START, END, (F.col(END) == F.lit(OPEN_END)).alias(CURRENT))


def with_version_keys(history: DataFrame, keys: Sequence[str], name: str, known: DataFrame | None = None) -> DataFrame:
    """Surrogate keys of versions. Versions of `known` (keys, start, name) keep theirs; new ones are numbered after them, in order of key and start."""
    keys = list(keys)
    if known is None:
        return number_rows(history, [*keys, START], name)
    held = known.select(*keys, START, name)
    fresh = history.join(held, [*keys, START], "left_anti")
    most = held.agg(F.coalesce(F.max(name), F.lit(0)).alias("n")).select("n").scalar()
    numbered = number_rows(fresh, [*keys, START], name).withColumn(name, F.col(name) + most)
    return history.join(held, [*keys, START]).unionByName(numbered)


def valid_on(history: DataFrame, when: dt.date | str) -> DataFrame:
    """The versions that hold on a day."""
    return history.where(day(when).between(F.col(START), F.col(END)))


def lookup_at(fact: DataFrame, history: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """The fact with `columns` of the version that held on day `at`.

    Versions are laid out by the months they touch, so that the join is one on key and month, and a hot key is spread over
    months. Open ends are cut to the fact's own first and last day, two values that the plan reads as scalar subqueries.
    With `how` "left", rows without a key, a day or a version keep NULL.
    """
    keys = list(keys)
    bounds = stored(fact.agg(F.min(at).cast("date").alias("first"), F.max(at).cast("date").alias("last")), "fact_days")
    first, last = bounds.select("first").scalar(), bounds.select("last").scalar()
    begin, end = F.greatest(F.col(START), first), F.least(F.col(END), last)
    months = F.sequence(month_start(begin), month_start(end), F.expr("interval 1 month"))
    # Before the explode the interval is tested within the expression, so that no sequence ever runs backwards.
    spread = history.select(*keys, F.col(START).alias("_start"), F.col(END).alias("_end"), *columns, F.explode(F.when(begin <= end, months)).alias("_month"))
    rows = fact.withColumn("_month", month_start(F.col(at).cast("date"))).withColumn("_day", F.col(at).cast("date"))
    rows, spread = rows.alias("f"), spread.alias("v")
    same = [F.col(f"f.{k}") == F.col(f"v.{k}") for k in [*keys, "_month"]]
    inside = F.col("f._day").between(F.col("v._start"), F.col("v._end"))
    condition = inside
    for s in same:
        condition = s & condition
    joined = rows.join(spread, condition, how)
    return joined.select(*[F.col(f"f.{c}").alias(c) for c in fact.columns], *[F.col(f"v.{c}").alias(c) for c in columns])
