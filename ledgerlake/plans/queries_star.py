"""Dimensions, keys, lookups and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import rules
from ledgerlake.operators import dimensions, facts, keys, marts
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import cents, family, ratio
from ledgerlake.sources.writers import insert_absent, upsert


@query("dim_calendar", """
    select sk_tempo, data::varchar as data, ano, case when mes <= 6 then 1 else 2 end as semestre, quarter(data)::int as trimestre,
           mes, mes_nome, upper(mes_nome[1:3]) as mes_abrev, strftime(data, '%Y-%m') as ano_mes, weekofyear(data)::int as semana_ano,
           day(data)::int as dia_mes, dia_semana, dayname(data) as dia_semana_nome, upper(dayname(data)[1:3]) as dia_semana_abrev,
           dia_semana in (0, 6) as eh_fim_semana
    from g_dias""")
def dim_calendar(bank):
    return bank.calendar.drop("eh_feriado", "eh_dia_util")


@query("dim_calendar_enriched", """
    select sk_tempo, data::varchar as data, taxa_selic::double as taxa_selic, taxa_cdi::double as taxa_cdi,
           cotacao_dolar::double as cotacao_dolar, cotacao_euro::double as cotacao_euro, indice_ipca::double as indice_ipca,
           ipca_mes::double as ipca_mes, eh_feriado, nome_feriado, eh_dia_util from g_tempo""")
def dim_calendar_enriched(bank):
    return bank.gold["dim_tempo"].select(
        "sk_tempo", "data", "taxa_selic", "taxa_cdi", "cotacao_dolar", "cotacao_euro", "indice_ipca", "ipca_mes",
        "eh_feriado", "nome_feriado", "eh_dia_util",
    )


@query("dim_client", """
    select sk_cliente, cod_cliente, primeiro_nome || ' ' || ultimo_nome as nome_completo, email, tipo_pessoa,
           data_inclusao::varchar as data_inclusao, idade, faixa_etaria, cidade, uf, sk_municipio,
           renda_mensal::double as renda_mensal, score_credito, data_inclusao::varchar as data_inicio_vigencia,
           '9999-12-31' as data_fim_vigencia, true as eh_registro_atual
    from g_cliente""", ("idade", "score_credito", "sk_municipio"))
def dim_client(bank):
    return bank.gold["dim_cliente"].select(
        "sk_cliente", "cod_cliente", "nome_completo", "email", "tipo_pessoa", "data_inclusao", "idade", "faixa_etaria",
        "cidade", "uf", "sk_municipio", "renda_mensal", "score_credito", "data_inicio_vigencia", "data_fim_vigencia",
        "eh_registro_atual",
    )


@query("clients_last_loaded", """
    select cod_cliente, email, idade, faixa_etaria from s_sinteticos
    union all
    select cod_cliente, email, idade, faixa_etaria from s_clientes where cod_cliente not in (select cod_cliente from s_sinteticos)""", ("idade",))
def clients_last_loaded(bank):
    return dimensions.last_loaded_clients(bank.silver["clientes"], bank.silver["clientes_sinteticos"]).select(
        "cod_cliente", "email", "idade", "faixa_etaria"
    )


@query("dim_branch", """
    select sk_agencia, cod_agencia, nome, tipo_agencia, cidade, uf, regiao, data_abertura::varchar as data_abertura,
           meta_comercial_mensal::double as meta_comercial_mensal, latitude::double as latitude, longitude::double as longitude,
           sk_municipio from g_agencia""", ("sk_municipio",))
def dim_branch(bank):
    return bank.gold["dim_agencia"].drop("eh_ativa", "_carga_ts")


@query("dim_staff", """
    select sk_colaborador, cod_colaborador, primeiro_nome || ' ' || ultimo_nome as nome_completo, cargo, salario_base::double as salario_base,
           sk_agencia_principal, eh_ativo from g_colaborador""", ("sk_agencia_principal",))
def dim_staff(bank):
    return bank.gold["dim_colaborador"].select(
        "sk_colaborador", "cod_colaborador", "nome_completo", "cargo", "salario_base", "sk_agencia_principal", "eh_ativo"
    )


@query("dim_channel", "select sk_canal, nome_canal, tipo_canal from g_canal")
def dim_channel(bank):
    return dimensions.dim_channel(bank.silver["transacoes"])


@query("dim_municipality", """
    select sk_municipio, codigo_ibge, municipio, uf, populacao, pib_total, pib_per_capita::double as pib_per_capita from g_municipio""", ("populacao", "pib_total"))
def dim_municipality(bank):
    return bank.gold["dim_municipio"].select(
        "sk_municipio", "codigo_ibge", "municipio", "uf", "populacao", "pib_total", "pib_per_capita"
    )


@query("surrogate_keys_in_order", """
    select row_number() over (order by o_orderdate, o_orderkey) as sk, o_orderkey, o_orderdate::date::varchar as dia from orders""")
def surrogate_keys_in_order(bank):
    orders = bank.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("dia"))
    return keys.number_rows(orders, ["dia", "o_orderkey"], "sk")


@query("latest_order_per_client", """
    select o_custkey, o_orderkey, o_orderdate::date::varchar as dia, o_totalprice
    from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""")
def latest_order_per_client(bank):
    orders = bank.table("orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("dia"), "o_totalprice"
    )
    return keys.latest_per_key(orders, ["o_custkey"], ["dia", "o_orderkey"])


@query("hot_key_lookup", """
    select n_name, count(*) as qtd, sum(value::decimal(14,2))::double as total
    from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey group by 1""")
def hot_key_lookup(bank):
    """Events to their client by a join that spreads the rows of busy users over parts of 64."""
    clients = bank.table("customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    events = bank.table("events").select("user_id", F.col("value").cast("decimal(14,2)").alias("value"))
    owned = keys.lookup(events, clients, "user_id", "inner", part_rows=64)
    per_nation = owned.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("qtd"), marts.money("value").alias("total")
    )
    return per_nation.join(bank.table("nation"), "n_nationkey").select("n_name", "qtd", "total")


@query("clients_with_orders", "select c_custkey from customer where c_custkey in (select o_custkey from orders)")
def clients_with_orders(bank):
    ordered = bank.table("orders").select(F.col("o_custkey").alias("c_custkey"))
    return bank.table("customer").select("c_custkey").join(ordered, "c_custkey", "left_semi")


@query("fact_transactions", """
    select sk_tempo, sk_canal, sk_cliente, sk_agencia, cod_transacao, num_conta, nome_transacao,
           valor_transacao::double as valor_transacao, valor_absoluto::double as valor_absoluto, flag_credito from f_transacoes""", ("sk_canal",))
def fact_transactions(bank):
    gold = bank.gold
    return facts.fact_transactions(
        bank.silver["transacoes"], gold["dim_tempo"], bank.silver["contas"], gold["dim_cliente"],
        gold["dim_agencia"], gold["dim_canal"],
    )


@query("fact_transactions_unmatched", """
    select count(*) as linhas, count(t.sk_tempo) as com_tempo, count(k.sk_cliente) as com_cliente, sum(x.valor_absoluto)::double as volume
    from s_transacoes x
    left join g_dias t on t.data = x.data_transacao::date
    left join (select c.num_conta, k.sk_cliente from s_contas c join g_cliente k using (cod_cliente)
               join g_agencia a on a.cod_agencia = c.cod_agencia) k on k.num_conta = x.num_conta""")
def fact_transactions_unmatched(bank):
    gold = bank.gold
    fact = facts.fact_transactions(
        bank.silver["transacoes"], gold["dim_tempo"], bank.silver["contas"], gold["dim_cliente"],
        gold["dim_agencia"], gold["dim_canal"], keep_unmatched=True,
    )
    return fact.agg(
        F.count("*").alias("linhas"), F.count("sk_tempo").alias("com_tempo"), F.count("sk_cliente").alias("com_cliente"),
        marts.money("valor_absoluto").alias("volume"),
    )


@query("fact_accounts", """
    select sk_tempo, sk_cliente, sk_agencia, sk_colaborador, num_conta, saldo_total::double as saldo_total,
           saldo_disponivel::double as saldo_disponivel, computed_flag as eh_conta_ativa from f_contas""", ("sk_colaborador",))
def fact_accounts(bank):
    return bank.gold["fato_contas"].drop("_carga_ts")


@query("fact_proposals", """
    select sk_tempo_entrada, sk_cliente, sk_colaborador, cod_proposta, status_proposta, valor_proposta::double as valor_proposta,
           taxa_juros_mensal::double as taxa_juros_mensal from f_propostas""", ("sk_colaborador",))
def fact_proposals(bank):
    return bank.gold["fato_propostas_credito"].select(
        "sk_tempo_entrada", "sk_cliente", "sk_colaborador", "cod_proposta", "status_proposta", "valor_proposta",
        "taxa_juros_mensal",
    )


def _products(bank):
    return keys.small_surrogate_key(dimensions.dim_product(bank.spark), "cod_produto", "sk_produto")


_PRODUCT_KEYS = "(select row_number() over (order by c) as sk_produto, c as cod_produto from (values {}) v(c))".format(
    ", ".join(f"('{code}')" for code, *_ in dimensions.PRODUCTS)
)
_TIME = "join g_dias t on t.data = {}"
_CLIENT = "join g_cliente k on k.cod_cliente = e.cod_cliente"
_PRODUCT = f"{{}} join {_PRODUCT_KEYS} p on p.cod_produto = e.cod_produto"


@query("fact_investments", f"""
    select t.sk_tempo, k.sk_cliente, p.sk_produto, e.id_investimento, e.data_aplicacao::varchar as data_aplicacao,
           e.data_vencimento::varchar as data_vencimento, e.valor_aplicado::double as valor_aplicado,
           {ratio(f"{cents('valor_aplicado')} * (10000 + (rentabilidade * 10000)::hugeint)", "10000")} / 100 as valor_atual,
           case when e.data_vencimento <= date '2001-08-01' then 'Vencido' else 'Ativo' end as status
    from e_investimentos e {_TIME.format('e.data_aplicacao')} {_CLIENT} {_PRODUCT.format('')}""")
def fact_investments(bank):
    return facts.fact_investments(
        bank.event("investimentos"), bank.gold["dim_tempo"], bank.gold["dim_cliente"], _products(bank), "2001-08-01"
    )


@query("fact_cards", f"""
    select t.sk_tempo, k.sk_cliente, p.sk_produto, e.id_fatura, e.limite_total::double as limite_total, e.gasto_mes::double as gasto_mes,
           (e.limite_total - e.gasto_mes)::double as limite_disponivel,
           case when limite_total > 0 then {ratio(f"{cents('gasto_mes')} * 100", cents('limite_total'), 2)} else 0 end as pct_utilizacao
    from e_cartoes e {_TIME.format('e.mes_referencia')} {_CLIENT} {_PRODUCT.format('')}""")
def fact_cards(bank):
    return facts.fact_cards(bank.event("cartoes"), bank.gold["dim_tempo"], bank.gold["dim_cliente"], _products(bank))


@query("fact_insurance", f"""
    select t.sk_tempo, k.sk_cliente, p.sk_produto, e.num_apolice, e.data_inicio::varchar as data_inicio, e.data_fim::varchar as data_fim,
           e.valor_segurado::double as valor_segurado, e.premio_mensal::double as premio_mensal, e.status_apolice
    from e_seguros e {_TIME.format('e.data_inicio')} {_CLIENT} {_PRODUCT.format('')}""")
def fact_insurance(bank):
    return facts.fact_insurance(bank.event("seguros"), bank.gold["dim_tempo"], bank.gold["dim_cliente"], _products(bank))


@query("fact_arrears", f"""
    select t.sk_tempo, k.sk_cliente, e.cod_contrato, e.valor_aberto::double as valor_aberto, e.dias_atraso,
           case when dias_atraso <= 30 then '0-30' when dias_atraso <= 60 then '31-60' when dias_atraso <= 90 then '61-90' else '90+' end as bucket,
           case when dias_atraso > 180 then 'Crítico' when dias_atraso > 90 then 'Alto' when dias_atraso > 30 then 'Médio' else 'Baixo' end as faixa_risco
    from e_inadimplencia e {_TIME.format('e.data_referencia')} {_CLIENT}""")
def fact_arrears(bank):
    return facts.fact_arrears(bank.event("inadimplencia"), bank.gold["dim_tempo"], bank.gold["dim_cliente"])


@query("fact_frauds", """
    select (e.data_ocorrencia::date - (select min(ts)::date from events) + 1)::int as sk_tempo, k.sk_cliente, n.sk_canal, e.id_fraude,
           strftime(e.data_ocorrencia, '%H:%M:%S') as hora_ocorrencia, e.valor_fraude::double as valor_fraude, e.flag_confirmada,
           e.valor_recuperado::double as valor_recuperado
    from e_fraudes e join g_cliente k on k.cod_cliente = e.cod_cliente left join g_canal n on n.nome_canal = e.canal""", ("sk_canal",))
def fact_frauds(bank):
    cal = dimensions.calendar_of(bank.table("events"), "ts")
    return facts.fact_frauds(bank.event("fraudes"), cal, bank.gold["dim_cliente"], bank.gold["dim_canal"])


@query("fact_revenue", f"""
    select a.sk_agencia, p.sk_produto, e.tipo_receita, count(*) as linhas, sum(e.valor_receita)::double as receita,
           sum(e.valor_receita - coalesce(e.valor_custo, 0))::double as margem
    from e_receitas e {_TIME.format('e.data')} join g_agencia a on a.cod_agencia = e.cod_agencia {_PRODUCT.format('left')}
    group by all""", ("sk_produto",))
def fact_revenue(bank):
    fact = facts.fact_revenue(bank.event("receitas"), bank.gold["dim_tempo"], bank.gold["dim_agencia"], _products(bank))
    return fact.groupBy("sk_agencia", "sk_produto", "tipo_receita").agg(
        F.count("*").alias("linhas"), marts.money("valor_receita").alias("receita"), marts.money("margem").alias("margem")
    )


@query("products_inserted_if_absent", """
    select cod_produto, categoria from (
      select distinct p_type || '-' || p_brand as cod_produto, p_type as categoria from part
      union all select v.c, v.g from (values {}) v(c, g))""".format(
    ", ".join(f"('{code}', '{group}')" for code, _, group, *_ in dimensions.PRODUCTS)
))
def products_inserted_if_absent(bank):
    """The constant products, and those of the part table that are not among them."""
    part = bank.table("part").select(
        F.concat_ws("-", "p_type", "p_brand").alias("cod_produto"), F.col("p_type").alias("categoria")
    )
    return insert_absent(dimensions.dim_product(bank.spark), part, ["cod_produto"]).select("cod_produto", "categoria")


@query("products_sold", """
    select categoria, risco, garantia_fgc, count(*) as qtd from e_investimentos e
    join (values ('CDB_PRE', 'Investimento', 'Baixo', true), ('CDB_CDI', 'Investimento', 'Baixo', true),
                 ('TESOURO_S', 'Investimento', 'Baixo', false)) p(cod_produto, categoria, risco, garantia_fgc)
      on p.cod_produto = e.cod_produto group by all""")
def products_sold(bank):
    """Positions by the attributes of the constant product dimension."""
    products = dimensions.dim_product(bank.spark)
    return (
        bank.event("investimentos").groupBy("cod_produto").agg(F.count("*").alias("n"))
        .join(products, "cod_produto")
        .groupBy("categoria", "risco", "garantia_fgc").agg(F.sum("n").alias("qtd"))
    )


@query("channel_seed_used", """
    select canal as nome_canal, case when canal = 'Saque' then 'Presencial' else 'Digital' end as tipo_canal,
           canal <> 'Saque' as eh_digital, count(*) as qtd
    from s_transacoes where canal in ('Pix', 'TED', 'DOC', 'Pagamento Boleto', 'Saque') group by 1""")
def channel_seed_used(bank):
    """Transactions whose channel the seeded channel dimension knows."""
    used = marts.counts_by(bank.silver["transacoes"].withColumnRenamed("canal", "nome_canal"), "nome_canal")
    return used.join(dimensions.dim_channel_seed(bank.spark), "nome_canal").select(
        "nome_canal", "tipo_canal", "eh_digital", "qtd"
    )


@query("municipalities_upserted", """
    select coalesce(a.codigo_ibge, b.codigo_ibge) as codigo_ibge,
           case when b.codigo_ibge is not null then b.populacao else a.populacao end as populacao,
           coalesce(a.ano, b.ano) as ano
    from (select codigo_ibge, populacao::int as populacao, ano from raw_populacao where ano = '2020') a
    full join (select codigo_ibge, populacao::int as populacao, ano from raw_populacao where ano = '2022') b using (codigo_ibge)""")
def municipalities_upserted(bank):
    """The 2022 census over the 2020 one: known places take the new count, new places come in whole."""
    counts = bank.raw["populacao"].select("codigo_ibge", F.col("populacao").cast("int").alias("populacao"), "ano")
    return upsert(counts.where("ano = '2020'"), counts.where("ano = '2022'"), ["codigo_ibge"], ["populacao"])


@query("branch_regions", f"""
    select {family('a.regiao', {'N': ('Norte', 'Nordeste')}, 'S')} as bloco, count(*) as qtd, count(l.sk_municipio) as com_municipio
    from g_agencia a left join (select distinct sk_municipio from g_municipio) l using (sk_municipio) group by 1""")
def branch_regions(bank):
    block = rules.family_of("regiao", {"N": ("Norte", "Nordeste")}, "S").alias("bloco")
    return bank.gold["dim_agencia"].groupBy(block).agg(
        F.count("*").alias("qtd"), F.count("sk_municipio").alias("com_municipio")
    )


def _fact_sql(table: str, day: str, columns: str, product: bool = False, branch: bool = False, channel: bool = False) -> str:
    """A product source's raw text, typed and joined to the dimensions."""
    keys_of = ["t.sk_tempo", "k.sk_cliente"] + ["p.sk_produto"] * product + ["a.sk_agencia"] * branch + ["n.sk_canal"] * channel
    return f"""
    select {', '.join(keys_of)}, {columns}
    from raw_{table} r join g_dias t on t.data = try_cast(trim(r.{day}) as date)
    join g_cliente k on k.cod_cliente = try_cast(trim(r.cod_cliente) as bigint)
    {f'join {_PRODUCT_KEYS} p on p.cod_produto = trim(r.cod_produto)' if product else ''}
    {'left join g_agencia a on a.cod_agencia = try_cast(trim(r.cod_agencia) as bigint)' if branch else ''}
    {'left join g_canal n on n.nome_canal = trim(r.canal)' if channel else ''}"""


def _money_of(*names: str) -> str:
    return ", ".join(f"try_cast(nullif(trim({n}), '') as decimal(14,2))::double as {n}" for n in names)


@query("gold_investments", _fact_sql("investimentos", "data_aplicacao", f"""
    id_investimento::bigint as id_investimento, try_cast(nullif(data_vencimento, '') as date)::varchar as data_vencimento,
    {_money_of('valor_aplicado', 'valor_atual')}, rentabilidade_pct::decimal(8,4)::double as rentabilidade_pct, trim(status) as status""",
    product=True, branch=True), ("sk_agencia",))
def gold_investments(bank):
    return bank.gold["fato_investimentos"].select(
        "sk_tempo", "sk_cliente", "sk_produto", "sk_agencia", "id_investimento", "data_vencimento", "valor_aplicado", "valor_atual",
        "rentabilidade_pct", "status")


@query("gold_cards", _fact_sql("cartoes", "mes_referencia", f"""
    try_cast(id_fatura as bigint) as id_fatura, {_money_of('limite_total', 'gasto_mes', 'valor_fatura', 'valor_pago')},
    dias_atraso::int as dias_atraso, taxa_rotativo_mes::decimal(6,4)::double as taxa_rotativo_mes""", product=True, branch=True)
    + " where try_cast(id_fatura as bigint) is not null", ("sk_agencia",))
def gold_cards(bank):
    return bank.gold["fato_cartoes"].select(
        "sk_tempo", "sk_cliente", "sk_produto", "sk_agencia", "id_fatura", "limite_total", "gasto_mes", "valor_fatura", "valor_pago",
        "dias_atraso", "taxa_rotativo_mes")


@query("gold_insurance", _fact_sql("seguros", "data_inicio", f"""
    num_apolice, data_fim::date::varchar as data_fim, {_money_of('valor_segurado', 'premio_mensal', 'valor_sinistro')}, trim(status_apolice) as status_apolice,
    case when foi_cross_sell <> '' then lower(foi_cross_sell) in ('true', '1', 't') end as foi_cross_sell""", product=True, branch=True),
    ("sk_agencia",))
def gold_insurance(bank):
    return bank.gold["fato_seguros"].select(
        "sk_tempo", "sk_cliente", "sk_produto", "sk_agencia", "num_apolice", "data_fim", "valor_segurado", "premio_mensal", "valor_sinistro",
        "status_apolice", "foi_cross_sell")


@query("gold_arrears", _fact_sql("inadimplencia", "data_referencia", f"""
    cod_contrato, tipo_contrato, {_money_of('valor_total_contrato', 'valor_aberto', 'valor_recuperado')}, dias_atraso::int as dias_atraso, bucket,
    lower(flag_write_off) in ('true', '1', 't') as flag_write_off"""))
def gold_arrears(bank):
    return bank.gold["fato_inadimplencia"].select(
        "sk_tempo", "sk_cliente", "cod_contrato", "tipo_contrato", "valor_total_contrato", "valor_aberto", "valor_recuperado", "dias_atraso",
        "bucket", "flag_write_off")


@query("gold_frauds", _fact_sql("fraudes", "data_ocorrencia", f"""
    id_fraude::bigint as id_fraude, hora_ocorrencia, tipo_fraude, dispositivo, {_money_of('valor_fraude', 'valor_recuperado')},
    lower(flag_confirmada) in ('true', '1', 't') as flag_confirmada, data_deteccao""", branch=True, channel=True), ("sk_agencia", "sk_canal"))
def gold_frauds(bank):
    return bank.gold["fato_fraudes"].select(
        "sk_tempo", "sk_cliente", "sk_agencia", "sk_canal", "id_fraude", "hora_ocorrencia", "tipo_fraude", "dispositivo", "valor_fraude",
        "valor_recuperado", "flag_confirmada", "data_deteccao")
