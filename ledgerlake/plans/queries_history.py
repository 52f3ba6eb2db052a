"""Client history: yearly loads of what clients spend, merged into versions, and orders looked up in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import text as t
from ledgerlake.operators import history, marts
from ledgerlake.operators.history import CURRENT, END, START
from ledgerlake.plans.catalog import query
from ledgerlake.session import stored

# The yearly spending from which on a client belongs to a band.
BANDS = [(1000000, "D"), (500000, "C"), (250000, "B")]
KEYS, TRACKED = ["cod_cliente"], ["faixa"]

_BAND = "case " + " ".join(f"when gasto >= {least} then '{name}'" for least, name in BANDS) + " else 'A' end"
_VERSIONS = f"""
    (with cargas as (select *, {_BAND} as faixa from (
        select o_custkey as cod_cliente, make_date(year(o_orderdate) + 1, 1, 1) as dia, sum(cast(o_totalprice as decimal(14,2))) as gasto
        from orders where o_custkey is not null group by 1, 2)),
     marcas as (select *, lag(faixa) over (partition by cod_cliente order by dia) is distinct from faixa as nova from cargas),
     versoes as (select *, sum(nova::int) over (partition by cod_cliente order by dia) as v from marcas),
     juntas as (select cod_cliente, v, min(dia) as inicio, any_value(faixa) as faixa, arg_max(gasto, dia) as gasto from versoes group by 1, 2)
     select cod_cliente, faixa, gasto, inicio, coalesce(lead(inicio) over (partition by cod_cliente order by inicio) - 1, date '9999-12-31') as fim from juntas)"""
_PUBLISHED = f"select cod_cliente, faixa, gasto::double as gasto, inicio::varchar as inicio, fim::varchar as fim, fim = date '9999-12-31' as atual from {_VERSIONS}"


def _loads(bank):
    """On each first of January, the clients with orders in the year before, with what they spent and its band."""
    spent = bank.table("orders").where("o_custkey IS NOT NULL").groupBy(
        F.col("o_custkey").alias("cod_cliente"), F.make_date(F.year("o_orderdate") + 1, F.lit(1), F.lit(1)).alias("dia")
    ).agg(F.sum(t.to_decimal(F.col("o_totalprice"))).alias("gasto"))
    band = F.lit("A")
    for least, name in reversed(BANDS):
        band = F.when(F.col("gasto") >= least, name).otherwise(band)
    return spent.withColumn("faixa", band)


def _versions(bank):
    return history.history_of(_loads(bank), KEYS, TRACKED, "dia")


def _published(versions):
    return versions.select("cod_cliente", "faixa", "gasto", F.col(START).alias("inicio"), F.col(END).alias("fim"), F.col(CURRENT).alias("atual"))


@query("client_history", _PUBLISHED)
def client_history(bank):
    """All loads at once: a version for each stretch of years in one band."""
    return _published(_versions(bank))


@query("client_history_merged", _PUBLISHED)
def client_history_merged(bank):
    """The same, load after load: each closes the versions that it changes and opens new ones."""
    loads = stored(_loads(bank), "loads")
    days = [r.dia for r in loads.select("dia").distinct().orderBy("dia").collect()]  # a day for each load
    merged = history.first_versions(loads.where(F.col("dia") == days[0]).drop("dia"), KEYS, TRACKED, days[0])
    for day in days[1:]:
        load = loads.where(F.col("dia") == day).drop("dia")
        merged = stored(history.merge_load(merged, load, KEYS, TRACKED, day), "history")
    return _published(merged)


@query("client_version_keys", f"""
    select cod_cliente, inicio::varchar as inicio, row_number() over (order by inicio >= date '1999-01-01', cod_cliente, inicio) as sk_cliente from {_VERSIONS}""")
def client_version_keys(bank):
    """Versions known before 1999 keep their keys; later ones are numbered after them."""
    versions = stored(_versions(bank), "versions")
    known = history.with_version_keys(versions.where(F.col(START) < "1999-01-01"), KEYS, "sk_cliente")
    numbered = history.with_version_keys(versions, KEYS, "sk_cliente", known)
    return numbered.select("cod_cliente", F.col(START).alias("inicio"), "sk_cliente")


@query("orders_by_band_of_their_day", f"""
    select coalesce(faixa, 'sem historico') as faixa, count(*) as pedidos, sum(cast(o_totalprice as decimal(14,2)))::double as valor
    from orders left join {_VERSIONS} h on cod_cliente = o_custkey and o_orderdate::date between inicio and fim group by 1""")
def orders_by_band_of_their_day(bank):
    """Each order under the band that its client had on the day of the order."""
    orders = bank.table("orders").select(F.col("o_custkey").alias("cod_cliente"), "o_orderdate", t.to_decimal(F.col("o_totalprice")).alias("valor"))
    found = history.lookup_at(orders, _versions(bank), KEYS, "o_orderdate", ["faixa"], "left")
    return found.groupBy(F.coalesce("faixa", F.lit("sem historico")).alias("faixa")).agg(F.count("*").alias("pedidos"), marts.money("valor").alias("valor"))


@query("clients_by_band_on_a_day", f"""
    select faixa, count(*) as clientes from {_VERSIONS} where date '1998-07-01' between inicio and fim group by 1""")
def clients_by_band_on_a_day(bank):
    return history.valid_on(_versions(bank), "1998-07-01").groupBy("faixa").agg(F.count("*").alias("clientes"))
