"""Sources and sinks: files written to the shared folder and read back, merges and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import text as t
from ledgerlake.operators import cleaning, marts, quality
from ledgerlake.plans.bank_view import TABLES
from ledgerlake.plans.catalog import query
from ledgerlake.sources import readers, writers
from ledgerlake.sources.tables import bank_specs, layout


@query("row_counts", "\nunion all\n".join(f"select '{name}' as tabela, count(*) as linhas from {name}" for name in TABLES))
def row_counts(bank):
    return readers.row_counts({name: bank.table(name) for name in TABLES})


@query("csv_proposals_loaded", """
    select status_proposta, count(*) as qtd, sum(valor_proposta)::double as total
    from s_propostas where cod_proposta < 1000000000 group by 1""")
def csv_proposals_loaded(bank):
    """Raw proposals written as CSV with two surplus columns, loaded by layout, then cleaned."""
    path = bank.scratch("propostas_csv")
    wide = bank.raw["propostas_credito"].select("*", F.lit("a,b").alias("extra"), F.lit('"q"').alias("nota"))
    wide.write.mode("overwrite").options(header="true", quote='"', escape='"', emptyValue="").csv(path)
    loaded = readers.read_text_csv(bank.spark, path, layout("propostas_credito"))
    clean = cleaning.clean_proposals(loaded)
    return clean.groupBy("status_proposta").agg(F.count("*").alias("qtd"), marts.money("valor_proposta").alias("total"))


@query("lineage_of_sources", """
    select 'original' as _fonte, count(*) as linhas, count(*) as com_carga from raw_clientes
    union all select 'sintetico', count(*), count(*) from raw_clientes_sinteticos""")
def lineage_of_sources(bank):
    both = readers.with_lineage(bank.raw["clientes"], "original").unionByName(
        readers.with_lineage(bank.raw["clientes_sinteticos"], "sintetico"), allowMissingColumns=True
    )
    return both.groupBy("_fonte").agg(F.count("*").alias("linhas"), F.count("_carga_ts").alias("com_carga"))


@query("balances_as_of_snapshot", """
    select c_nationkey, count(*) as contas, sum(cast(c_acctbal as decimal(14,2)))::double as saldo from customer group by 1""")
def balances_as_of_snapshot(bank):
    """Two dated copies of the accounts; the table is read as of a day between them."""
    folder = bank.scratch("contas_historico")
    accounts = bank.table("customer").select("c_nationkey", F.col("c_acctbal").cast("decimal(14,2)").alias("saldo"))
    writers.write_snapshot(accounts, folder, "2001-07-31")
    writers.write_snapshot(accounts.withColumn("saldo", F.col("saldo") * 2), folder, "2001-08-31")
    then = readers.read_snapshot(bank.spark, folder, "2001-08-15")
    return then.groupBy("c_nationkey").agg(F.count("*").alias("contas"), marts.money("saldo").alias("saldo"))


@query("events_appended_and_compacted", """
    select event_type, count(*) as qtd, sum(cast(value as decimal(14,2)))::double as total from events group by 1""")
def events_appended_and_compacted(bank):
    """Events appended one type at a time, rewritten without small files."""
    folder, target = bank.scratch("eventos"), bank.scratch("eventos_compactos")
    events = bank.table("events").select("event_type", F.col("value").cast("decimal(14,2)").alias("value"))
    clicks = F.col("event_type") == "click"
    writers.overwrite(events.where(clicks), folder)
    writers.append(events.where(~clicks), folder)
    return writers.compact(bank.spark, folder, target).groupBy("event_type").agg(
        F.count("*").alias("qtd"), marts.money("value").alias("total")
    )


@query("answers_as_json", """
    select status_proposta, count(*) as qtd_propostas, sum(valor_proposta)::double as valor_total_proposto from f_propostas group by 1""")
def answers_as_json(bank):
    path = bank.scratch("kpi4_json")
    writers.write_json(bank.mart("kpi4").select("status_proposta", "qtd_propostas", "valor_total_proposto"), path)
    return bank.spark.read.schema("status_proposta string, qtd_propostas bigint, valor_total_proposto decimal(38,2)").json(path)


@query("non_empty_sources", "select count(*) as linhas from raw_transacoes")
def non_empty_sources(bank):
    """The gate that stops a run on an empty source, then the count of what it let through."""
    return quality.require_rows(bank.raw["transacoes"], "transacoes").agg(F.count("*").alias("linhas"))


@query("typed_csv_read", """
    select o_orderstatus, count(*) as qtd, max(o_orderdate)::date::varchar as ultimo, sum(cast(o_totalprice as decimal(14,2)))::double as total
    from orders group by 1""")
def typed_csv_read(bank):
    """Orders as semicolon-separated text, read with a declared schema instead of inference."""
    path = bank.scratch("pedidos_csv")
    orders = bank.table("orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("dia"),
        t.to_decimal(F.col("o_totalprice")).alias("valor"),
    )
    orders.write.mode("overwrite").options(header="true", sep=";").csv(path)
    typed = readers.read_typed_csv(
        bank.spark, path, "o_orderkey bigint, o_orderstatus string, dia date, valor decimal(14,2)", ";"
    )
    return typed.groupBy("o_orderstatus").agg(
        F.count("*").alias("qtd"), F.max("dia").alias("ultimo"), marts.money("valor").alias("total")
    )


@query("sources_loaded_by_group", """
    select 'agencias' as tabela, count(*) as linhas from raw_agencias
    union all select 'clientes', count(*) from raw_clientes
    union all select 'contas', count(*) from raw_contas
    union all select 'colaboradores', count(*) from raw_colaboradores
    union all select 'colaborador_agencia', count(*) from raw_colaboradores_expandidos
    union all select 'propostas_credito', count(*) from raw_propostas_credito
    union all select 'transacoes', count(*) from raw_transacoes""")
def sources_loaded_by_group(bank):
    """The seven files of the original group, laid out as the registry expects."""
    root = bank.scratch("arquivos")
    specs = bank_specs("original")
    held = {spec.table: bank.raw[spec.table] for spec in specs if spec.table != "colaborador_agencia"}
    held["colaborador_agencia"] = bank.raw["colaboradores_expandidos"]
    for spec in specs:
        text = held[spec.table].select(*spec.columns)
        text.write.mode("overwrite").options(header="true", quote='"', escape='"').csv(f"{root}/{spec.file}")
    loaded, _ = readers.load_group(bank.spark, root, specs)
    return readers.row_counts(loaded)


@query("raw_transactions_by_name", """
    select (['Pix - Realizado', 'TED - Recebido', 'DOC enviado', 'Compra Credito', 'Compra Crédito', 'compra DEBITO', 'Saque ATM',
             'Deposito em especie', 'Pagamento boleto', 'Estorno', 'Debito automatico TED', 'Tarifa agencia'])[(l_linenumber + l_suppkey) % 12 + 1] as nome,
           count(*) as linhas, count(distinct l_orderkey * 10 + l_linenumber) as codigos,
           count(distinct case when o_custkey % 43 = 5 then 900000000 when o_custkey % 50 = 3 then 3000100000 else 100000 end + o_custkey) as contas,
           count(*) filter (where l_quantity = 50 and not (l_discount = 0 and l_tax = 0)) as sem_numero
    from lineitem, orders where l_orderkey = o_orderkey group by 1""")
def raw_transactions_by_name(bank):
    """The raw view of transactions against the supplied tables, its rules written out a second time."""
    return bank.raw["transacoes"].groupBy(F.trim("nome_transacao").alias("nome")).agg(
        F.count("*").alias("linhas"), F.count_distinct("cod_transacao").alias("codigos"), F.count_distinct("num_conta").alias("contas"),
        F.count_if(F.col("valor_transacao") == "n/d").alias("sem_numero"),
    )


@query("raw_accounts_by_branch", """
    select c_nationkey::varchar as cod_agencia, count(*) as contas, count(*) filter (where c_custkey % 29 = 0) as sem_colaborador,
           sum(case when c_custkey % 97 in (5, 6) then null when c_custkey % 97 = 7 then 12 else c_acctbal::decimal(14,2) end)::double as saldo,
           max(date '2001-08-01' - (c_custkey * 13 % 400)::int) filter (where c_custkey % 50 <> 7)::varchar as ultimo
    from customer group by 1""")
def raw_accounts_by_branch(bank):
    """The raw view of accounts, likewise."""
    return bank.raw["contas"].groupBy("cod_agencia").agg(
        F.count("*").alias("contas"), F.count_if(F.col("cod_colaborador").isNull()).alias("sem_colaborador"),
        marts.money(F.when(F.col("saldo_total").rlike(t.SIGNED_NUMBER), t.to_decimal("saldo_total"))).alias("saldo"), F.max("data_ultimo_lancamento").alias("ultimo"),
    )
