"""Many data rules in one pass: each table is read once, whatever the number of rules that look at it.

Every row is laid out as the entries it has in the rules: rule, key, day, and whether it stands there as a child or as a parent.
One aggregate then serves all rules alike: a repeated key is one with several children, an orphan one without a parent, a row too
early one with a child's day before its parent's, a gap a step between the days of a series. No rule needs a join. Rows are counted by
rule, key and day before they move, so a hot key is a row for each of its days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import stored

# What a rule counts: rows it hits; rows beyond the first of a key; keys with several rows; rows, or distinct keys, without a
# parent; rows dated before their parent; months a series lacks; steps of a series over a number of days.
ROWS, EXTRA, REPEATED, ORPHAN_ROWS, ORPHAN_KEYS, BEFORE, MONTHS, GAPS = "rows", "extra", "repeated", "orphan rows", "orphan keys", "before", "months", "gaps"


@dataclass(frozen=True)
class Probe:
    """What a rule looks at. `key` tells rows apart (and is its sample), `when` which rows have an entry at all."""

    mode: str
    table: str
    key: Column | None = None
    when: Column | None = None
    day: Column | None = None
    parent: str | None = None
    parent_key: Column | None = None
    parent_day: Column | None = None
    first: dt.date | None = None
    last: dt.date | None = None
    days: int = 0


def _entry(rule: int, key: Column | None, day: Column | None, child: bool, when: Column | None) -> Column:
    entry = F.struct(
        F.lit(rule).alias("rule"),
        (F.lit(None) if key is None else key).cast("string").alias("key"),
        (F.lit(None) if day is None else day).cast("date").alias("day"),
        F.lit(int(child)).cast("long").alias("child"),
        F.lit(int(not child)).cast("long").alias("parent"),
    )
    return entry if when is None else F.when(when, entry)


def stacked(tables: Mapping[str, DataFrame], probes: Sequence[Probe]) -> DataFrame:
    """rule, key, day, child, parent: the entries of all rows of all tables, each table read once."""
    entries: dict[str, list[Column]] = {}
    for i, p in enumerate(probes):
        when = p.when
        if p.mode in (EXTRA, REPEATED):
            when = p.key.isNotNull() if when is None else when & p.key.isNotNull()
        entries.setdefault(p.table, []).append(_entry(i, p.key, p.day, True, when))
        if p.parent is not None:
            entries.setdefault(p.parent, []).append(_entry(i, p.parent_key, p.parent_day, False, p.parent_key.isNotNull()))
    parts = [tables[name].select(F.inline(F.array(*own))).where("rule IS NOT NULL") for name, own in entries.items()]
    # A series without a single row lacks all its months: its rule has an entry without a day in any case.
    series = [i for i, p in enumerate(probes) if p.mode == MONTHS]
    if series:
        spark = next(iter(tables.values())).sparkSession
        empty = F.array(*[_entry(i, None, None, True, None) for i in series])
        parts.append(spark.range(1).select(F.inline(empty)).withColumn("child", F.lit(0).cast("long")))
    return reduce(DataFrame.unionByName, parts)


def _missing(probe: Probe, days: Column) -> Column:
    months = F.sequence(F.lit(probe.first), F.lit(probe.last), F.expr("interval 1 month"))
    return F.size(F.array_except(months, F.transform(days, lambda d: F.trunc(d, "month"))))


def _steps(probe: Probe, days: Column) -> Column:
    later = F.slice(days, F.lit(2), F.greatest(F.size(days) - 1, F.lit(0)))
    earlier = F.slice(days, F.lit(1), F.greatest(F.size(days) - 1, F.lit(0)))
    return F.size(F.filter(F.zip_with(later, earlier, F.datediff), lambda n: n > probe.days))


def findings(tables: Mapping[str, DataFrame], probes: Sequence[Probe]) -> DataFrame:
    """rule, key, n: what each rule counts, by key, where it is not zero."""
    per_day = stacked(tables, probes).groupBy("rule", "key", "day").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    dated = F.when(F.col("day").isNotNull(), F.struct("day", "child", "parent"))
    per_key = per_day.groupBy("rule", "key").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"), F.collect_list(dated).alias("days"))

    child, lost, known = F.col("child"), F.col("parent") == 0, F.col("key").isNotNull()
    own_days = F.array_sort(F.transform(F.col("days"), lambda d: d["day"]))
    early = F.aggregate(
        F.filter("days", lambda d: d["parent"] > 0),
        F.lit(0).cast("long"),
        lambda total, opened: total + opened["parent"] * F.aggregate(F.filter("days", lambda d: d["day"] < opened["day"]), F.lit(0).cast("long"), lambda n, d: n + d["child"]),
    )
    counted = {
        ROWS: lambda p: child,
        EXTRA: lambda p: child - 1,
        REPEATED: lambda p: F.when(child > 1, 1).otherwise(0),
        ORPHAN_ROWS: lambda p: F.when(lost, child).otherwise(0),
        ORPHAN_KEYS: lambda p: F.when(lost & known, 1).otherwise(0),
        BEFORE: lambda p: early,
        MONTHS: lambda p: _missing(p, own_days),
        GAPS: lambda p: _steps(p, own_days),
    }
    n = F.lit(0)
    for mode, count in counted.items():
        own = [i for i, p in enumerate(probes) if p.mode == mode]
        if mode in (MONTHS, GAPS):
            for i in own:
                n = F.when(F.col("rule") == i, count(probes[i])).otherwise(n)
        elif own:
            n = F.when(F.col("rule").isin(own), count(None)).otherwise(n)
    return per_key.select("rule", "key", n.cast("long").alias("n")).where("n > 0")


def counts(tables: Mapping[str, DataFrame], probes: Sequence[Probe], sampled: Mapping[int, bool], few: int, glue: str) -> DataFrame:
    """rule, n, sample. `sampled`: rules with a sample, and whether a key is listed as often as it was found.

    What was found is written once, by key: the sums and the samples are taken from there.
    """
    found = stored(findings(tables, probes), "findings")
    sums = found.groupBy("rule").agg(F.sum("n").alias("n"))
    if not sampled:
        return sums.withColumn("sample", F.lit(None).cast("string"))
    order = Window.partitionBy("rule").orderBy("key")
    first = found.where(F.col("rule").isin(list(sampled)) & F.col("key").isNotNull()).withColumn("place", F.row_number().over(order)).where(F.col("place") <= few)
    often = [rule for rule, repeated in sampled.items() if repeated]
    times = F.when(F.col("rule").isin(often), F.least("n", F.lit(few))).otherwise(1).cast("int") if often else F.lit(1)
    listed = first.groupBy("rule").agg(F.sort_array(F.collect_list(F.struct("key", times.alias("times")))).alias("keys"))
    texts = F.flatten(F.transform("keys", lambda k: F.array_repeat(k["key"], k["times"])))
    samples = listed.select("rule", F.array_join(F.slice(texts, 1, few), glue).alias("sample"))
    return sums.join(F.broadcast(samples), "rule", "left")  # a row for each rule
