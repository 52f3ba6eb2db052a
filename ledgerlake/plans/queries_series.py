"""Series operators over the monthly and daily series of the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions import text as t
from ledgerlake.operators import series
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import GDP_GROWTH, POPULATION_GROWTH, region

_CHANGES = "(select data, cast(no_mes as decimal(6,2)) as v from raw_ipca)"
_FACTOR = "product(1 + v::double / 100)"


def _changes(bank):
    return bank.raw["ipca"].select(
        t.to_day("data").alias("data"), t.to_decimal("no_mes", 6).alias("variacao_mensal")
    )


@query("compounded_changes", f"""
    select data, v::double as variacao_mensal,
           round(({_FACTOR} over (order by data rows between 11 preceding and current row) - 1) * 100, 2) as acumulado_12m,
           round(({_FACTOR} over (partition by data[1:4] order by data) - 1) * 100, 2) as acumulado_ano,
           round((sum(v) over (order by data rows between 2 preceding and current row))::double, 2) as acumulado_3m
    from {_CHANGES}""")
def compounded_changes(bank):
    df = _changes(bank).withColumn("ano", F.year("data"))
    df = series.compound(df, "variacao_mensal", "data", "acumulado_12m", rows=12)
    df = series.compound(df, "variacao_mensal", "data", "acumulado_ano", ["ano"])
    return series.trailing_sum(df, "variacao_mensal", "data", "acumulado_3m").drop("ano")


_DAILY = """(select o_orderdate::date as data, sum(cast(o_totalprice as decimal(14,2))) as valor, cast((count(*) % 9 - 4) / 100.0 as decimal(6,2)) as v
             from orders group by 1)"""


@query("daily_running_series", f"""
    select data::varchar as data, valor::double as valor, (sum(valor) over (order by data))::double as valor_acumulado,
           (sum(valor) over (order by data rows between 6 preceding and current row))::double as valor_7d,
           round(({_FACTOR} over (order by data) - 1) * 100, 2) as acumulado,
           round(({_FACTOR} over (order by data rows between 11 preceding and current row) - 1) * 100, 2) as acumulado_12
    from {_DAILY}""")
def daily_running_series(bank):
    """Every day of orders as one series: running and trailing sums and compounded changes, none in one task."""
    daily = bank.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("data")).agg(
        F.sum(t.to_decimal(F.col("o_totalprice"))).alias("valor"), ((F.count("*") % 9 - 4) / 100).cast("decimal(6,2)").alias("v")
    )
    df = series.running_sum(daily, "valor", "data", "valor_acumulado")
    df = series.trailing_sum(df, "valor", "data", "valor_7d", rows=7)
    df = series.compound(df, "v", "data", "acumulado")
    return series.compound(df, "v", "data", "acumulado_12", rows=12).drop("v")


_CHAIN = """
    (with recursive seq as (select row_number() over (order by data) as i, data, cast(no_mes as double) as v from raw_ipca),
     walk as (select 0::bigint as i, null::varchar as data, null::double as v, 3040.22::double as indice
              union all
              select s.i, s.data, s.v, round(w.indice * (1 + s.v / 100), 2) from walk w join seq s on s.i = w.i + 1)
     select data, v, indice from walk where i > 0)"""


@query("chained_index", f"select data, v as variacao_mensal, indice from {_CHAIN}")
def chained_index(bank):
    return series.chained_index(_changes(bank), "variacao_mensal", "data", series.INDEX_BASE)


@query("index_projected_by_season", f"""
    with recursive real as (select data, cast(no_mes as double) as v from raw_ipca),
    pesos as (select unnest([0.55, 0.65, 0.72, 0.43, 0.38, 0.20, 0.30, 0.35, 0.44, 0.52, 0.39, 0.52])::double as w, generate_subscripts([1,2,3,4,5,6,7,8,9,10,11,12], 1) as m),
    meses as (select m, '2026-' || lpad(m::varchar, 2, '0') || '-01' as data, round(w * 4.5 / (select sum(w) from pesos), 2) as v,
                     round((sum(w) over (order by m)) * 4.5 / (select sum(w) from pesos), 2) as acumulado_ano from pesos),
    walk as (select 0::bigint as m, (select arg_max(indice, data) from {_CHAIN}) as indice
             union all select s.m, round(w.indice * (1 + s.v / 100), 2) from walk w join meses s on s.m = w.m + 1),
    todos as (select data, v from real union all select data, v from meses)
    select x.data, x.v as variacao_mensal, walk.indice, x.acumulado_ano,
           round(sum(x.v) over (order by x.m rows between 2 preceding and current row), 2) as acumulado_3m,
           y.a12 as acumulado_12m, 'PROJECAO' as tipo
    from meses x join walk on walk.m = x.m
    join (select data, round((product(1 + v / 100) over (order by data rows between 11 preceding and current row) - 1) * 100, 2) as a12 from todos) y
      on y.data = x.data""")
def index_projected_by_season(bank):
    real = series.chained_index(_changes(bank), "variacao_mensal", "data", series.INDEX_BASE)
    return series.project_seasonal(real, 2026, series.INFLATION_TARGETS[2026]).select(
        "data", "variacao_mensal", "indice", "acumulado_ano", "acumulado_3m", "acumulado_12m", "tipo"
    )


def _rate_answer(spread: str, column: str) -> str:
    return f"""
    select d::varchar as data, round(greatest(0.0001, de + (ate - de) * (date_diff('day', inicio, d) / 365.0::double)), 6) as {column}, 'PROJECAO' as tipo
    from (select unnest(generate_series(inicio, fim, interval 1 day))::date as d, * from (
            select date '2025-01-01' as inicio, date '2025-12-31' as fim, ultima as de, (14.75 - {spread})::double / 100 / 252 as ate, dia from ult
            union all
            select date '2026-01-01', date '2026-12-31', (14.75 - {spread})::double / 100 / 252, (12.50 - {spread})::double / 100 / 252, dia from ult))
    where d > dia and dayofweek(d) not in (0, 6)"""


_LAST_RATE = "(select max(data)::date as dia, arg_max(try_cast(taxa_selic as double), data) filter (where taxa_selic <> '-') as ultima from raw_selic)"


def _rates(bank, name):
    return bank.raw["selic"].select(
        t.to_day("data").alias("data"), t.to_decimal("taxa_selic", 10, 6).alias(name)
    )


@query("rate_projected", f"with ult as {_LAST_RATE} {_rate_answer('0', 'taxa_selic')}")
def rate_projected(bank):
    return series.project_rate(_rates(bank, "taxa_selic").where("taxa_selic IS NOT NULL"), "taxa_selic")


@query("interbank_rate_projected", f"with ult as {_LAST_RATE} {_rate_answer('0.10', 'taxa_cdi')}")
def interbank_rate_projected(bank):
    return series.project_interbank(_rates(bank, "taxa_cdi").where("taxa_cdi IS NOT NULL"), "taxa_cdi")


def _rate_by_region(rates: dict[str, float]) -> str:
    cases = " ".join(f"when '{name}' then {rate}" for name, rate in rates.items())
    return f"(case regiao {cases} end)::double"


_POP, _GDP = _rate_by_region(POPULATION_GROWTH), _rate_by_region(GDP_GROWTH)


@query("population_projected", f"""
    select codigo_ibge, y::int as ano, round_even(n * pow(1 + {_POP}, (y - base)::double), 0) as populacao, 'PROJECAO' as tipo
    from (select p.codigo_ibge, p.populacao::double as n, p.ano::int as base, {region('m.uf')} as regiao, unnest([2023, 2024, 2025, 2026]) as y
          from raw_populacao p join raw_municipios m using (codigo_ibge))""")
def population_projected(bank):
    people = bank.raw["populacao"].select(
        "codigo_ibge", F.col("ano").cast("int").alias("ano"), F.col("populacao").cast("long").alias("populacao")
    )
    places = bank.raw["municipios"].select("codigo_ibge", "uf")
    return series.project_population(people.join(places, "codigo_ibge")).select("codigo_ibge", "ano", "populacao", "tipo")


@query("gdp_projected", f"""
    select codigo_ibge, y::int as ano, round_even(n * pow(1 + {_GDP}, (y - base)::double), 0) as pib_total,
           round_even(c * pow(1 + {_GDP} - {_POP}, (y - base)::double), 2) as pib_per_capita, 'PROJECAO' as tipo
    from (select p.codigo_ibge, p.pib_total::double as n, p.pib_per_capita::double as c, p.ano::int as base, {region('m.uf')} as regiao,
                 unnest([2022, 2023, 2024, 2025, 2026]) as y
          from raw_pib_municipal p join raw_municipios m using (codigo_ibge))""")
def gdp_projected(bank):
    gdp = bank.raw["pib_municipal"].select(
        "codigo_ibge", F.col("ano").cast("int").alias("ano"), F.col("pib_total").cast("long").alias("pib_total"),
        t.to_decimal("pib_per_capita").alias("pib_per_capita"),
    )
    places = bank.raw["municipios"].select("codigo_ibge", "uf")
    return series.project_gdp(gdp.join(places, "codigo_ibge")).select(
        "codigo_ibge", "ano", "pib_total", "pib_per_capita", "tipo"
    )


@query("real_and_projected", """
    select tipo, count(*) as linhas, min(data) as primeira, max(data) as ultima
    from (select data, 'REAL' as tipo from raw_ipca
          union all select '2026-' || lpad(m::varchar, 2, '0') || '-01', 'PROJECAO' from (select unnest(generate_series(1, 12)) as m))
    group by 1""")
def real_and_projected(bank):
    real = series.chained_index(_changes(bank), "variacao_mensal", "data", series.INDEX_BASE)
    projected = series.project_seasonal(real, 2026, series.INFLATION_TARGETS[2026])
    return series.tag_series(real, projected.drop("tipo")).groupBy("tipo").agg(
        F.count("*").alias("linhas"), F.min("data").alias("primeira"), F.max("data").alias("ultima")
    )


@query("weekdays_per_month", """
    select mes::varchar as mes, (select count(*) from (select unnest(generate_series(mes, last_day(mes), interval 1 day)) as d) where dayofweek(d) not in (0, 6))::int as dias
    from (select distinct date_trunc('month', o_orderdate)::date as mes from orders)""")
def weekdays_per_month(bank):
    months = bank.table("orders").select(dates.month_start("o_orderdate").alias("mes")).distinct()
    return months.withColumn("dias", dates.weekdays_in_month("mes"))


