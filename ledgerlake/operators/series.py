"""Monthly and daily series: compounding, chained indices and projections.

One row a period counts, so a window over one series of many is bounded by the calendar. A series that is the whole
table is scanned in range partitions (`scans`), and no window sees all of it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions.rules import region_of
from ledgerlake.operators import scans
from ledgerlake.operators.keys import latest_per_key

# Annual targets (percent) and the spread of the interbank rate below the policy rate.
RATE_TARGETS = {2025: 14.75, 2026: 12.50}
INFLATION_TARGETS = {2026: 4.5}
INTERBANK_SPREAD = 0.10
RATE_FLOOR = 0.0001

# Seasonal weights of monthly inflation, January first.
SEASON = [0.55, 0.65, 0.72, 0.43, 0.38, 0.20, 0.30, 0.35, 0.44, 0.52, 0.39, 0.52]

# Yearly growth of product and population by region.
GDP_GROWTH = {"Norte": 0.065, "Nordeste": 0.055, "Centro-Oeste": 0.080, "Sudeste": 0.048, "Sul": 0.058}
POPULATION_GROWTH = {"Norte": 0.010, "Nordeste": 0.004, "Centro-Oeste": 0.012, "Sudeste": 0.005, "Sul": 0.006}

# Fixed value: the price index before the first month of the series.
INDEX_BASE = 3040.22


def compound(
    df: DataFrame, value: str, order: str, name: str, partition: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Compounded percentage over the trailing `rows` rows, or from the start of the partition."""
    df = latest_per_key(df, [*partition, order], [])  # one row a period reaches the window
    factor = 1 + F.col(value).cast("double") / 100
    if partition:
        first = Window.unboundedPreceding if rows is None else -(rows - 1)
        grown = df.withColumn(name, F.product(factor).over(Window.partitionBy(*partition).orderBy(order).rowsBetween(first, 0)))
    else:
        values = {name: (scans.PRODUCT, factor)}
        grown = scans.running(df, [order], values) if rows is None else scans.trailing(df, [order], values, rows)
    return grown.withColumn(name, F.round((F.col(name) - 1) * 100, 2))


def trailing_sum(
    df: DataFrame, value: str, order: str, name: str, rows: int = 3, partition: Sequence[str] = ()
) -> DataFrame:
    df = latest_per_key(df, [*partition, order], [])
    if partition:
        summed = df.withColumn(name, F.sum(value).over(Window.partitionBy(*partition).orderBy(order).rowsBetween(-(rows - 1), 0)))
    else:
        summed = scans.trailing(df, [order], {name: (scans.SUM, F.col(value))}, rows)
    return summed.withColumn(name, F.round(name, 2))


def running_sum(df: DataFrame, value: str, order: str, name: str) -> DataFrame:
    """The sum from the first row on; of several rows of a period the greatest counts."""
    return scans.running(latest_per_key(df, [order], []), [order], {name: (scans.SUM, F.col(value))})


# Steps of a fold that are copied together.
FOLD_BLOCK = 128


def fold_index(changes: Column, base: Column, scale: int = 2) -> Column:
    """Index after each change of an ordered array, rounded at every step.

    The rounding makes each step depend on the one before, which no window frame
    expresses; a fold over the series' own array does. A fold copies what it has
    so far at every step, so it runs over blocks, and within each over its steps.
    """

    def step(last: Column, change: Column) -> Column:
        return F.round(last * (1 + F.coalesce(change.cast("double"), F.lit(0.0)) / 100), scale)

    def block(last: Column, some: Column) -> Column:
        return F.aggregate(some, F.array(last), lambda done, change: F.concat(done, F.array(step(F.element_at(done, -1), change))))

    count = F.ceil(F.size(changes) / FOLD_BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda b: F.slice(changes, b * FOLD_BLOCK + 1, F.lit(FOLD_BLOCK)))
    begin = F.array(F.array(F.round(base.cast("double"), scale)))
    # Each block's path begins with the last value of the one before.
    paths = F.aggregate(blocks, begin, lambda done, some: F.concat(done, F.array(block(F.element_at(F.element_at(done, -1), -1), some))))
    return F.flatten(F.transform(F.slice(paths, F.lit(2), F.size(paths) - 1), lambda p: F.slice(p, F.lit(2), F.size(p) - 1)))


def chained_index(
    df: DataFrame, value: str, order: str, base: float | Column, name: str = "indice", partition: Sequence[str] = ()
) -> DataFrame:
    """Chain monthly changes into an index. Of several rows of a month the greatest counts, so a series stays short."""
    df = latest_per_key(df, [*partition, order], [])
    base = base if isinstance(base, Column) else F.lit(base)
    rest = [c for c in df.columns if c not in partition]
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_k"), F.struct(*rest).alias("_row"))))
    series = df.groupBy(*partition).agg(ordered.alias("_s"))
    path = fold_index(F.transform("_s", lambda s: s["_row"][value]), base)
    return series.select(
        *partition, F.explode(F.arrays_zip(F.col("_s"), path.alias("_i"))).alias("_z")
    ).select(*partition, "_z._s._row.*", F.col("_z._i").alias(name))


def tag_series(real: DataFrame, projected: DataFrame) -> DataFrame:
    """Real rows tagged REAL over projected rows tagged PROJECAO."""
    return real.withColumn("tipo", F.lit("REAL")).unionByName(
        projected.withColumn("tipo", F.lit("PROJECAO")), allowMissingColumns=True
    )


def project_seasonal(
    monthly: DataFrame, year: int, target: float, season: Sequence[float] = SEASON
) -> DataFrame:
    """Twelve months whose changes follow the season and add up to the year's target.

    `monthly` holds the real series (data, variacao_mensal, indice). The index
    goes on from its last value, and the trailing columns reach back into it.
    """
    scale = target / sum(season)
    last_index = monthly.agg(F.max_by("indice", "data").cast("double").alias("_base"))
    changes = F.array(*[F.round(F.lit(w) * scale, 2) for w in season])
    running = F.array(
        *[F.round(F.lit(sum(season[: i + 1]) * scale), 2) for i in range(len(season))]
    )
    months = F.array(*[F.lit(dt.date(year, m, 1)) for m in range(1, 13)])
    rows = last_index.select(
        F.explode(
            F.arrays_zip(
                months.alias("data"),
                changes.alias("variacao_mensal"),
                fold_index(changes, F.col("_base")).alias("indice"),
                running.alias("acumulado_ano"),
            )
        ).alias("r")
    ).select("r.*", F.lit("PROJECAO").alias("tipo"))
    sums = trailing_sum(rows, "variacao_mensal", "data", "acumulado_3m")
    history = monthly.select(
        "data", F.col("variacao_mensal").cast("double").alias("variacao_mensal"), F.lit("REAL").alias("tipo")
    )
    joined = history.unionByName(sums, allowMissingColumns=True)
    return compound(joined, "variacao_mensal", "data", "acumulado_12m", rows=12).where(
        "tipo = 'PROJECAO'"
    )


def project_rate(
    daily: DataFrame, value: str, targets: dict[int, float] = RATE_TARGETS, spread: float = 0.0
) -> DataFrame:
    """Weekdays after the last real day, moving evenly from one year's target to the next.

    The first year starts from the last real rate.
    """
    last = daily.agg(F.max("data").alias("_last"), F.max_by(value, "data").cast("double").alias("_rate"))
    years, previous = [], F.col("_rate")
    for year, target in sorted(targets.items()):
        goal = F.lit((target - spread) / 100 / 252)
        years.append(F.struct(F.lit(dt.date(year, 1, 1)).alias("start"), F.lit(dt.date(year, 12, 31)).alias("end"),
                              previous.alias("from"), goal.alias("to")))
        previous = goal
    legs = last.select("_last", F.explode(F.array(*years)).alias("y"))
    d = F.col("data")
    rate = F.col("y.from") + (F.col("y.to") - F.col("y.from")) * (F.datediff(d, F.col("y.start")) / F.lit(365.0))
    return (
        legs.select("_last", "y", F.explode(F.sequence(F.col("y.start"), F.col("y.end"))).alias("data"))
        .where((d > F.col("_last")) & ~dates.is_weekend(d))
        .select("data", F.round(F.greatest(F.lit(RATE_FLOOR), rate), 6).alias(value), F.lit("PROJECAO").alias("tipo"))
    )


def project_interbank(daily: DataFrame, value: str, targets: dict[int, float] = RATE_TARGETS) -> DataFrame:
    return project_rate(daily, value, targets, INTERBANK_SPREAD)


def _by_region(rates: dict[str, float], region: Column) -> Column:
    expression = F
    for name, rate in rates.items():
        expression = expression.when(region == name, F.lit(rate))
    return expression.otherwise(F.lit(None).cast("double"))


def project_growth(
    base: DataFrame,
    grown: dict[str, tuple[dict[str, float], dict[str, float] | None, int]],
    first: int,
    last: int,
    state: str = "uf",
    year: str = "ano",
) -> DataFrame:
    """Future years of each row, growing at its region's yearly rate.

    `grown` maps a column to (rates, rates to subtract or None, decimals).
    """
    region = region_of(state)
    years = base.withColumnRenamed(year, "_base_year").withColumn(
        year, F.explode(F.sequence(F.lit(first), F.lit(last)))
    )
    n = (F.col(year) - F.col("_base_year")).cast("double")
    values = {}
    for name, (rates, less, places) in grown.items():
        rate = 1 + _by_region(rates, region)
        if less:
            rate = rate - _by_region(less, region)
        values[name] = F.bround(F.col(name).cast("double") * F.pow(rate, n), places)
    return years.withColumns(values).withColumn("tipo", F.lit("PROJECAO")).drop("_base_year")


def project_population(base: DataFrame, first: int = 2023, last: int = 2026) -> DataFrame:
    return project_growth(base, {"populacao": (POPULATION_GROWTH, None, 0)}, first, last)


def project_gdp(base: DataFrame, first: int = 2022, last: int = 2026) -> DataFrame:
    return project_growth(
        base,
        {"pib_total": (GDP_GROWTH, None, 0), "pib_per_capita": (GDP_GROWTH, POPULATION_GROWTH, 2)},
        first,
        last,
    )
