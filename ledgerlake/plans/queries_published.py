"""Writes that are merged, gated, published or refused: partitions, views, functions and tables of the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import rules
from ledgerlake.functions import sql as functions
from ledgerlake.functions import text as t
from ledgerlake.operators import cleaning, dimensions, marts, quality
from ledgerlake.operators.quality import Expectation, QualityError
from ledgerlake.operators.ranges import with_band
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import CHANNEL_WORDS, age, age_band, words
from ledgerlake.sources import readers, writers

# The day from which on orders come with the second load, and that from which on it corrects the first.
SECOND_LOAD, CORRECTED = "2000-06-01", "2000-03-01"


def _orders(bank):
    return bank.table("orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("mes"), "o_orderkey", F.col("o_orderdate").cast("date").alias("dia"), t.to_decimal(F.col("o_totalprice")).alias("valor")
    )


@query("orders_merged_by_month", """
    select strftime(o_orderdate, '%Y-%m') as mes, count(*) as pedidos, sum(cast(o_totalprice as decimal(14,2)))::double as valor from orders group by 1""")
def orders_merged_by_month(bank):
    """A table by month; the second load corrects three months and adds those that follow. Earlier months are not touched."""
    path, orders = bank.scratch("pedidos_por_mes"), _orders(bank)
    early = orders.where(F.col("dia") < SECOND_LOAD).withColumn("valor", F.when(F.col("dia") >= CORRECTED, F.col("valor") * 0).otherwise(F.col("valor")).cast("decimal(14,2)"))
    writers.overwrite(early, path, ["mes"])
    writers.merge_partitions(path, orders.where(F.col("dia") >= CORRECTED), ["mes", "o_orderkey"], ["mes"], ["dia", "valor"])
    merged = bank.spark.read.schema(orders.schema).parquet(path)
    return merged.groupBy("mes").agg(F.count("*").alias("pedidos"), marts.money("valor").alias("valor"))


@query("gated_writes", """
    select 'primeira' as tentativa, 'publicada' as situacao, 'saldo nao negativo' as expectativa, count(*) filter (where not coalesce(saldo_total >= 0, false)) as falhas,
           count(*) as linhas, (select count(*) from s_contas) as visiveis from s_contas
    union all select 'primeira', 'publicada', 'conta informada', 0, count(*), (select count(*) from s_contas) from s_contas
    union all select 'segunda', 'recusada', 'saldo nao negativo', count(*) filter (where not coalesce(saldo_total >= 0, false)), count(*), (select count(*) from s_contas) from s_contas""")
def gated_writes(bank):
    """Accounts written through a gate that lets them pass, then through one that does not; the view keeps the first."""
    accounts, view = bank.silver["contas"], f"{bank.schema('dq')}.contas"
    bank.spark.sql(f"CREATE DATABASE IF NOT EXISTS {bank.schema('dq')}")
    given, positive = Expectation("conta informada", "num_conta IS NOT NULL", fatal=True), "saldo_total >= 0"
    lines = []
    for attempt, rules_of in (("primeira", [given, Expectation("saldo nao negativo", positive)]), ("segunda", [Expectation("saldo nao negativo", positive, fatal=True)])):
        try:
            report, outcome = writers.write_gated(accounts, bank.scratch("contas_publicadas"), view, rules_of), "publicada"
        except QualityError as error:
            report, outcome = error.report, "recusada"
        lines += [(attempt, outcome, r["expectativa"], r["falhas"], r["linhas"]) for r in report]
    seen = bank.spark.table(view).agg(F.count("*").alias("visiveis"))
    return dimensions.constant_rows(bank.spark, ["tentativa", "situacao", "expectativa", "falhas", "linhas"], lines).select(
        "tentativa", "situacao", "expectativa", F.col("falhas").cast("bigint").alias("falhas"), F.col("linhas").cast("bigint").alias("linhas"), seen.scalar().alias("visiveis")
    )


@query("refused_inputs", """
    select 'arquivo ausente' as caso, 'clientes.csv' as nome union all select 'fonte vazia', 'transacoes' union all select 'total divergente', 'kpi4.qtd_propostas'""")
def refused_inputs(bank):
    """The gates that stop a run: an absent file, a source without rows, a total that does not agree."""
    lines = []
    try:
        readers.require_inputs(bank.spark, [f"{bank.folder}/orders.parquet", f"{bank.scratch('nada')}/clientes.csv"])
    except FileNotFoundError as error:
        lines.append(("arquivo ausente", str(error).rsplit("/", 1)[-1]))
    try:
        quality.require_rows(bank.raw["transacoes"].where("false"), "transacoes")
    except QualityError as error:
        lines.append(("fonte vazia", str(error).split()[0]))
    actual = quality.totals(bank.mart("kpi4"), "kpi4", {"qtd_propostas": F.sum("qtd_propostas")})
    try:
        quality.require_passed(quality.reconcile(actual, actual.withColumn("valor", F.col("valor") + 1)))
    except QualityError as error:
        lines.append(("total divergente", str(error).split("example ")[1].split(":")[0]))
    return dimensions.constant_rows(bank.spark, ["caso", "nome"], lines)


@query("items_by_price_band", """
    select n_name as faixa, n_nationkey::int as ordem, count(*) as itens, sum(cast(l_extendedprice as decimal(14,2)))::double as valor
    from lineitem left join nation on l_extendedprice >= n_nationkey * 4000.5 and (n_nationkey = 24 or l_extendedprice < (n_nationkey + 1) * 4000.5)
    group by 1, 2""")
def items_by_price_band(bank):
    """Prices with decimals banded by a table of edges, the last of them open."""
    key = F.col("n_nationkey")
    edges = bank.table("nation").select(
        F.col("n_name").alias("faixa"), key.cast("int").alias("ordem"), (key * 4000.5).alias("de"), F.when(key < 24, (key + 1) * 4000.5).alias("ate")
    )
    items = bank.table("lineitem").select("l_extendedprice", t.to_decimal(F.col("l_extendedprice")).alias("valor"))
    found = with_band(items, "l_extendedprice", edges, "de", "ate")
    return found.groupBy("faixa", "ordem").agg(F.count("*").alias("itens"), marts.money("valor").alias("valor"))


@query("functions_in_sql", f"""
    select regexp_full_match(regexp_replace(cep, '[^0-9]', '', 'g'), '[0-9]{{8}}') as cep_valido,
           {age_band(age("try_cast(data_nascimento as date)"), "Menor de idade")} as faixa, count(*) as clientes
    from raw_clientes group by 1, 2""")
def functions_in_sql(bank):
    """The rules as functions of a schema, called from plain SQL."""
    schema = bank.schema("dq")
    functions.register_functions(bank.spark, schema)
    writers.publish_view(bank.raw["clientes"], "clientes_brutos")
    return bank.spark.sql(f"""
        SELECT {schema}.valida_cep(cep) AS cep_valido, {schema}.faixa_etaria(TRY_CAST(data_nascimento AS DATE)) AS faixa, count(*) AS clientes
        FROM clientes_brutos GROUP BY 1, 2""")


@query("marts_in_sql", """
    select 'kpi4' as mart, status_proposta as grupo, count(*) as qtd, sum(valor_proposta)::double as valor from f_propostas group by 2
    union all
    select 'kpi7', null, count(*), null from g_cliente""")
def marts_in_sql(bank):
    """Marts written, published as persistent views of a created schema, and read by name."""
    prefix = bank.schema("")
    writers.create_layers(bank.spark, prefix, ("gold",))
    for name in ("kpi4", "kpi7"):
        path = bank.scratch(f"mart_{name}")
        writers.overwrite(bank.mart(name), path)
        writers.publish_files(bank.spark, path, f"{prefix}gold.{name}")
    return bank.spark.sql(f"""
        SELECT 'kpi4' AS mart, status_proposta AS grupo, qtd_propostas AS qtd, CAST(valor_total_proposto AS DOUBLE) AS valor FROM {prefix}gold.kpi4
        UNION ALL
        SELECT 'kpi7', NULL, sum(qtd_clientes), NULL FROM {prefix}gold.kpi7""")


@query("tables_of_layers", """
    select 'bronze' as camada, 'clientes' as tabela, count(*) as linhas from raw_clientes
    union all select 'silver', 'contas', count(*) from s_contas""")
def tables_of_layers(bank):
    """Schemas for the layers, tables saved in them twice over, and what the catalog then holds."""
    prefix = bank.schema("")
    writers.create_layers(bank.spark, prefix)
    held = {("bronze", "clientes"): bank.raw["clientes"], ("silver", "contas"): bank.silver["contas"]}
    for (layer, name), df in held.items():
        for rows in (df.limit(1), df):
            writers.save_table(rows, f"{prefix}{layer}.{name}", bank.scratch(f"{layer}_{name}"))
    counts = [
        bank.spark.table(f"{prefix}{layer}.{name}").agg(F.count("*").alias("linhas")).select(F.lit(layer).alias("camada"), F.lit(name).alias("tabela"), "linhas")
        for layer, name in held
    ]
    return counts[0].unionByName(counts[1])


@query("broken_csv_loaded", """
    with linhas as (select c_custkey, c_acctbal, case when c_custkey % 11 = 3 then 'faltam campos' when c_custkey % 13 = 5 then 'sobram campos' end as motivo from customer)
    select motivo, count(*) as registros, sum(case when motivo is null then cast(c_acctbal as decimal(14,2)) end)::double as saldo,
           count(case when motivo is null then 1 end) as com_quebra
    from linhas group by 1""")
def broken_csv_loaded(bank):
    """Customers as text with line breaks in quotes, and with records that lack a field or have one too many."""
    path, key = bank.scratch("clientes_quebrados"), F.col("c_custkey").cast("string")
    name = F.concat(F.lit('"Cliente ""'), key, F.lit('"",\nfilial"'))
    amount = F.col("c_acctbal").cast("decimal(14,2)").cast("string")
    fields = F.when(F.col("c_custkey") % 11 == 3, F.concat_ws(",", key, name)).when(F.col("c_custkey") % 13 == 5, F.concat_ws(",", key, name, amount, amount))
    lines = bank.table("customer").select(F.coalesce(fields, F.concat_ws(",", key, name, amount)).alias("value"))
    lines.write.mode("overwrite").text(path)
    loaded, rejected = readers.read_with_rejects(bank.spark, path, ["cod", "nome", "saldo"], header=False, line_breaks=True)
    good = loaded.agg(F.count("*").alias("registros"), marts.money(t.to_decimal("saldo")).alias("saldo"), F.count_if(F.col("nome").contains("\n")).alias("com_quebra"))
    bad = rejected.groupBy("motivo").agg(F.count("*").alias("registros"), F.lit(None).cast("decimal(24,2)").alias("saldo"), F.lit(0).cast("bigint").alias("com_quebra"))
    return good.withColumn("motivo", F.lit(None).cast("string")).unionByName(bad)


@query("channels_under_folding", f"""
    select {words("strip_accents(nome_transacao)", CHANNEL_WORDS)} as canal_sem_acentos, {words("nome_transacao", CHANNEL_WORDS)} as canal, count(*) as qtd
    from raw_transacoes group by 1, 2""")
def channels_under_folding(bank):
    """Channels by words whose accents do not count, beside the literal rule."""
    return bank.raw["transacoes"].groupBy(rules.folded_channel_of("nome_transacao").alias("canal_sem_acentos"), rules.channel_of("nome_transacao").alias("canal")).agg(F.count("*").alias("qtd"))


@query("cities_under_folding", """
    select n_name as municipio, count(*) as clientes from customer join nation on n_nationkey = c_nationkey group by 1""")
def cities_under_folding(bank):
    """Customers whose city is typed with other accents and another case than in the list of places."""
    accents = F.translate(F.lower("n_name"), "aeiou", "áéíõü")
    places = bank.table("nation").select(F.col("n_name").alias("municipio"), F.lit("SP").alias("uf"), F.col("n_nationkey").alias("sk_municipio"))
    typed = bank.table("customer").join(bank.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", accents.alias("cidade"), F.lit("sp").alias("uf"))
    linked = dimensions.link_municipality(typed, places, folded=True)
    return linked.join(places.select("sk_municipio", "municipio"), "sk_municipio").groupBy("municipio").agg(F.count("*").alias("clientes"))


@query("places_as_variants", """
    select n_nationkey::bigint as codigo_ibge, n_name as municipio, 'U' || n_nationkey as uf, 'Estado ' || n_nationkey as uf_nome,
           case n_regionkey when 0 then 'Norte' when 1 then 'Nordeste' when 2 then 'Sudeste' when 3 then 'Sul' else 'R4' end as regiao,
           case n_regionkey when 0 then 'N' when 1 then 'NE' when 2 then 'SE' when 3 then 'S' else 'R4' end as regiao_sigla
    from nation""")
def places_as_variants(bank):
    """Two layouts of one answer, without a declared schema."""
    code = F.expr("element_at(array('N', 'NE', 'SE', 'S', 'R4'), n_regionkey + 1)")
    state = F.struct(
        F.concat(F.lit("U"), "n_nationkey").alias("sigla"), F.concat(F.lit("Estado "), "n_nationkey").alias("nome"), F.struct(code.alias("sigla")).alias("regiao")
    )
    first = F.col("n_nationkey") % 2 == 0
    place = F.struct(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("nome"),
        F.when(first, F.struct(F.struct(state.alias("UF")).alias("mesorregiao"))).alias("microrregiao"),
        F.when(~first, F.struct(F.struct(state.alias("UF")).alias("regiao-intermediaria"))).alias("regiao-imediata"),
    )
    return cleaning.variant_places(bank.table("nation").select(F.to_json(place).alias("value")))


@query("series_as_variants", """
    select c_nationkey::varchar as codigo_ibge, c_mktsegment as periodo, count(*)::varchar as valor from customer group by 1, 2""")
def series_as_variants(bank):
    """One answer a place, with as many periods as it happens to have."""
    counts = bank.table("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").cast("string").alias("n"))
    cells = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("serie"))
    series = F.struct(F.struct(F.col("c_nationkey").cast("string").alias("id"), F.lit("x").alias("nome")).alias("localidade"), "serie")
    answer = F.array(F.struct(F.array(F.struct(F.array(series).alias("series"))).alias("resultados")))
    return cleaning.variant_series(cells.select(F.to_json(answer).alias("value"))).drop("municipio")


@query("account_totals_in_buckets", """
    select cod_agencia, count(*) as transacoes, sum(valor_transacao)::double as valor from s_transacoes join s_contas using (num_conta) group by 1""", optional=("cod_agencia",))
def account_totals_in_buckets(bank):
    """Transactions and accounts in equal buckets of the account: their join moves neither."""
    prefix = bank.schema("")
    writers.create_layers(bank.spark, prefix, ("gold",))
    moves = bank.silver["transacoes"].select("num_conta", "valor_transacao")
    buckets = writers.buckets_for(moves.count(), 24, least=8)
    sides = {"transacoes_por_conta": moves, "contas_por_conta": bank.silver["contas"].select("num_conta", "cod_agencia")}
    moves, accounts = (writers.save_bucketed(df, f"{prefix}gold.{name}", bank.scratch(name), "num_conta", buckets) for name, df in sides.items())
    return moves.join(accounts, "num_conta").groupBy("cod_agencia").agg(F.count("*").alias("transacoes"), marts.money("valor_transacao").alias("valor"))
