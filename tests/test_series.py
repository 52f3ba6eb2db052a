import datetime as dt
import re

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import series

CHANGES = [0.42, 0.83, None, -0.08, 0.45, 0.2, 0.33, 0.01, 0.44, 0.56, 0.39, 0.52, 0.16, 1.31]


@pytest.fixture
def monthly(frame):
    days = [dt.date(2024 + i // 12, i % 12 + 1, 1) for i in range(len(CHANGES))]
    return frame("data date, variacao_mensal double", list(zip(days, CHANGES)))


def test_trailing_and_yearly_compounds(monthly):
    df = series.compound(monthly.withColumn("ano", F.year("data")), "variacao_mensal", "data", "a12", rows=12)
    df = series.trailing_sum(series.compound(df, "variacao_mensal", "data", "ano_ac", ["ano"]), "variacao_mensal", "data", "a3")
    rows = df.orderBy("data").collect()

    def by_hand(window):
        factor = 1.0
        for v in window:
            factor *= 1 + (v or 0) / 100
        return round((factor - 1) * 100, 2)

    for i, row in enumerate(rows):
        assert row.a12 == by_hand(CHANGES[max(0, i - 11): i + 1])
        assert row.ano_ac == by_hand(CHANGES[12 if i >= 12 else 0: i + 1])
        assert row.a3 == round(sum(v or 0 for v in CHANGES[max(0, i - 2): i + 1]), 2)


def test_chained_index_rounds_at_every_step(monthly):
    got = [r.indice for r in series.chained_index(monthly, "variacao_mensal", "data", 3040.22).orderBy("data").collect()]
    index, expected = 3040.22, []
    for v in CHANGES:
        index = round(index * (1 + (v or 0) / 100), 2)
        expected.append(index)
    assert got == expected


def test_chained_index_per_series(frame):
    df = frame("s string, data int, v double", [("a", 2, 10.0), ("a", 1, 100.0), ("b", 1, 50.0)])
    got = series.chained_index(df, "v", "data", 10.0, "i", ["s"])
    assert values(got, "s", "data", "i") == [("a", 1, 20.0), ("a", 2, 22.0), ("b", 1, 15.0)]


def test_seasonal_projection_reaches_its_target(monthly):
    real = series.chained_index(monthly, "variacao_mensal", "data", 3040.22)
    rows = series.project_seasonal(real, 2026, 4.5).orderBy("data").collect()
    assert len(rows) == 12 and {r.tipo for r in rows} == {"PROJECAO"}
    scale = 4.5 / sum(series.SEASON)
    index = real.orderBy(F.desc("data")).first().indice
    for i, row in enumerate(rows):
        change = round(series.SEASON[i] * scale, 2)
        index = round(index * (1 + change / 100), 2)
        assert (row.variacao_mensal, row.indice) == (change, index)
        assert row.acumulado_ano == round(sum(series.SEASON[: i + 1]) * scale, 2)
    assert rows[-1].acumulado_ano == 4.5


def test_rates_move_evenly_over_weekdays(frame):
    daily = frame("data date, taxa double", [(dt.date(2024, 12, 30), 0.0004), (dt.date(2025, 1, 10), 0.0005)])
    rows = series.project_rate(daily, "taxa").orderBy("data").collect()
    assert rows[0].data == dt.date(2025, 1, 13) and all(r.data.weekday() < 5 for r in rows)
    assert rows[-1].data == dt.date(2026, 12, 31)
    goal, later = 14.75 / 100 / 252, 12.5 / 100 / 252
    for r in rows:
        start, a, b = (dt.date(2025, 1, 1), 0.0005, goal) if r.data.year == 2025 else (dt.date(2026, 1, 1), goal, later)
        assert r.taxa == pytest.approx(round(a + (b - a) * (r.data - start).days / 365, 6), abs=1.01e-6)
    assert series.project_interbank(daily, "taxa").orderBy(F.desc("data")).first().taxa == pytest.approx(12.4 / 100 / 252, abs=2e-6)


def test_growth_by_region(frame):
    base = frame("codigo_ibge string, uf string, ano int, populacao long", [("1", "AM", 2022, 1000), ("2", "SP", 2022, 999)])
    got = series.project_population(base)
    expected = [(c, y, float(round(n * (1 + g) ** (y - 2022)))) for c, n, g in (("1", 1000, 0.010), ("2", 999, 0.005)) for y in range(2023, 2027)]
    assert values(got, "codigo_ibge", "ano", "populacao") == sorted(expected, key=repr)
    gdp = frame("uf string, ano int, pib_total long, pib_per_capita double", [("RS", 2021, 500, 10.0)])
    last = series.project_gdp(gdp).where("ano = 2026").first()
    assert (last.pib_total, last.pib_per_capita) == (round(500 * 1.058**5), round(10 * (1.058 - 0.006) ** 5, 2))


def test_tags(monthly):
    tagged = series.tag_series(monthly, monthly.limit(2))
    assert values(tagged.groupBy("tipo").count()) == [("PROJECAO", 2), ("REAL", 14)]


def test_scans_over_many_partitions(spark):
    """Running and trailing values equal those of one window, however the rows are cut, partitions shorter than the frame included."""
    from pyspark.sql import Window

    from ledgerlake.operators import scans

    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(60).select(F.col("id").alias("k"), (F.pmod(F.xxhash64("id"), F.lit(100))).alias("v"), F.when(F.col("id") % 7 == 3, None).otherwise(F.col("id") / 1000).alias("f"))
    try:
        for parts in ("1", "3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            values_of = {"s": (scans.SUM, F.col("v")), "p": (scans.PRODUCT, 1 + F.col("f"))}
            for n in (None, 1, 2, 12):
                got = scans.running(rows, ["k"], values_of) if n is None else scans.trailing(rows, ["k"], values_of, n)
                frame_of = Window.orderBy("k").rowsBetween(Window.unboundedPreceding if n is None else 1 - n, 0)
                want = rows.select("k", F.sum("v").over(frame_of).alias("s"), F.product(1 + F.col("f")).over(frame_of).alias("p"))
                both = {r.k: (r.s, r.p) for r in got.collect()}, {r.k: (r.s, r.p) for r in want.collect()}
                assert len(both[0]) == 60 and all(both[0][k][0] == s and (both[0][k][1] or 1.0) == pytest.approx(p or 1.0) for k, (s, p) in both[1].items())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_no_window_sees_the_whole_series(frame):
    df = frame("d date, v double", [(dt.date(2024, 1, 1), 1.0)])
    for made in (series.compound(df, "v", "d", "c", rows=12), series.compound(df, "v", "d", "c"), series.trailing_sum(df, "v", "d", "c")):
        plan = made._jdf.queryExecution().executedPlan().toString()
        by_day = [line for line in plan.splitlines() if " Window [" in line and re.search(r", \[d#\d+ ASC", line)]
        assert by_day and all(re.search(r"\], \[_part#\d+\], \[d#", line) for line in by_day)


def test_long_folds_equal_short_steps(frame):
    import random

    rng = random.Random(1)
    changes = [rng.choice([None, 0.5, -0.3, 1.25]) for _ in range(300)]
    level, want = 100.0, []
    df = frame("d int, v double", list(enumerate(changes)))
    got = [r.indice for r in series.chained_index(df, "v", "d", 100.0).orderBy("d").collect()]
    for change in changes:
        level = float(str(round(level * (1 + (change or 0.0) / 100), 2)))
        want.append(level)
    assert all(abs(a - b) < 0.05 for a, b in zip(got, want, strict=True)) and len(got) == 300
    assert series.chained_index(frame("d int, v double", []), "v", "d", 100.0).count() == 0
