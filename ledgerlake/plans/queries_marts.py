"""Business marts over the stored star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.functions import finance
from ledgerlake.functions import text as t
from ledgerlake.functions.rules import AGE_BANDS
from ledgerlake.operators import dimensions, facts, marts
from ledgerlake.plans import warehouse
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import avg_money, cents, money, pct, ratio

_BALANCES = f"""
    select a.cod_agencia, a.nome, a.tipo_agencia, a.cidade, a.uf, count(distinct c.num_conta) as qtd_contas,
           sum(c.saldo_total) as saldo_total, sum(c.saldo_disponivel) as saldo_disponivel,
           {avg_money('sum(c.saldo_total)', 'count(c.saldo_total)')} as saldo_medio
    from f_contas c join g_agencia a using (sk_agencia) where c.computed_flag group by all"""
_PLAIN_BALANCES = f"""
    select * replace (saldo_total::double as saldo_total, saldo_disponivel::double as saldo_disponivel) from ({_BALANCES})"""
_VOLUMES = """
    select a.cod_agencia, sum(x.valor_absoluto) as volume_total from f_transacoes x join g_agencia a using (sk_agencia) group by 1"""
_MONTHLY = """
    select t.ano, t.mes, t.mes_nome, x.nome_transacao, count(*) as qtd_transacoes, sum(x.valor_absoluto) as volume_total
    from f_transacoes x join g_dias t using (sk_tempo) group by all"""


@query("kpi1_balance_by_branch", _PLAIN_BALANCES)
def kpi1(bank):
    return bank.mart("kpi1")


@query("kpi2_3_volume_and_mix_by_month", f"""
    select * replace (volume_total::double as volume_total),
           {pct('qtd_transacoes', 'sum(qtd_transacoes) over (partition by ano, mes)')} as pct_mix,
           ano || '-' || lpad(mes::varchar, 2, '0') as ano_mes
    from ({_MONTHLY})""")
def kpi2_3(bank):
    return marts.with_month_label(bank.mart("kpi2_3"))


@query("kpi3_mix_by_value", f"""
    select ano, mes, nome_transacao, volume_total::double as volume_total,
           {pct(cents('volume_total'), cents('sum(volume_total) over (partition by ano, mes)'))} as pct_mix
    from ({_MONTHLY})""")
def kpi3_by_value(bank):
    gold = bank.gold
    return marts.mix_by_month(gold["fato_transacoes"], gold["dim_tempo"], weight="value").select(
        "ano", "mes", "nome_transacao", "volume_total", "pct_mix"
    )


@query("kpi4_proposals_by_status", f"""
    select status_proposta, count(*) as qtd_propostas, {money('valor_proposta')} as valor_total_proposto,
           {money('valor_financiamento')} as valor_total_financiado,
           {avg_money('sum(valor_proposta)', 'count(valor_proposta)')} as valor_medio,
           {ratio("sum(taxa_juros_mensal) * 1000000 * 100", "count(taxa_juros_mensal) * 1000000", 4)} as taxa_media_pct,
           {pct('count(*)', 'sum(count(*)) over ()')} as pct_status
    from f_propostas group by 1""")
def kpi4(bank):
    return bank.mart("kpi4")


@query("kpi5_branch_ranking", f"""
    select k.* replace (saldo_total::double as saldo_total, saldo_disponivel::double as saldo_disponivel),
           coalesce(v.volume_total, 0)::double as volume_total,
           row_number() over (order by k.saldo_total desc, coalesce(v.volume_total, 0) desc, k.cod_agencia) as ranking
    from ({_BALANCES}) k left join ({_VOLUMES}) v using (cod_agencia)""")
def kpi5(bank):
    return bank.mart("kpi5")


@query("kpi5_ranking_with_ties", f"""
    select k.cod_agencia, rank() over (order by k.saldo_total desc) as ranking from ({_BALANCES}) k""")
def kpi5_with_ties(bank):
    marts_of = warehouse.mart_views(bank.gold)
    ranked = marts.branch_ranking(marts_of["kpi1"](), bank.mart("kpi5").select("cod_agencia", "volume_total"), ties=True)
    return ranked.select("cod_agencia", "ranking")


@query("kpi6_staff_portfolio", """
    select o.cod_colaborador, o.primeiro_nome || ' ' || o.ultimo_nome as nome_completo, o.cargo, a.nome as agencia,
           coalesce(c.n, 0) as qtd_contas_geridas, coalesce(c.saldo, 0)::double as saldo_gerido,
           coalesce(p.n, 0) as qtd_propostas, coalesce(p.ok, 0) as propostas_aprovadas
    from g_colaborador o
    left join g_agencia a on a.sk_agencia = o.sk_agencia_principal
    left join (select sk_colaborador, count(distinct num_conta) as n, sum(saldo_total) as saldo
               from f_contas where computed_flag group by 1) c on c.sk_colaborador = o.sk_colaborador
    left join (select sk_colaborador, count(distinct cod_proposta) as n,
                      count(distinct cod_proposta) filter (where status_proposta = 'Aprovada') as ok
               from f_propostas group by 1) p on p.sk_colaborador = o.sk_colaborador
    where o.eh_ativo""")
def kpi6(bank):
    return bank.mart("kpi6")


@query("top_staff_report", """
    select o.cod_colaborador, c.saldo::double as saldo_gerido
    from g_colaborador o join (select sk_colaborador, sum(saldo_total) as saldo from f_contas where computed_flag group by 1) c using (sk_colaborador)
    where o.eh_ativo order by c.saldo desc, o.cod_colaborador limit 20""")
def top_staff_report(bank):
    return warehouse.report(bank.gold, "kpi6", 20, "qtd_contas_geridas > 0").select("cod_colaborador", "saldo_gerido")


@query("reports_in_order", f"""
    select 'kpi5' as mart, cod_agencia::varchar as chave,
           row_number() over (order by k.saldo_total desc, coalesce(v.volume_total, 0) desc, k.cod_agencia) as posicao
    from ({_BALANCES}) k left join ({_VOLUMES}) v using (cod_agencia)
    union all
    select * from (
      select 'kpi6', cod_colaborador::varchar, row_number() over (order by saldo desc, cod_colaborador) as posicao
      from g_colaborador o join (select sk_colaborador, sum(saldo_total) as saldo from f_contas where computed_flag group by 1) c using (sk_colaborador)
      where o.eh_ativo) where posicao <= 20""")
def reports_in_order(bank):
    """Reports as they are read, first row first: the place of each row is its place in the answer."""
    branches = warehouse.report(bank.gold, "kpi5").select("cod_agencia").collect()  # a row for each branch
    staff = warehouse.report(bank.gold, "kpi6", 20, "qtd_contas_geridas > 0").select("cod_colaborador").collect()
    lines = [(mart, str(row[0]), place) for mart, rows in (("kpi5", branches), ("kpi6", staff)) for place, row in enumerate(rows, 1)]
    return dimensions.constant_rows(bank.spark, ["mart", "chave", "posicao"], lines).withColumn("posicao", F.col("posicao").cast("bigint"))


@query("views_over_views", f"""
    select k.uf, count(*) as agencias, sum(k.saldo_total)::double as saldo, sum(v.volume_total)::double as volume
    from ({_BALANCES}) k join ({_VOLUMES}) v using (cod_agencia) group by 1""")
def views_over_views(bank):
    """SQL over the published marts."""
    warehouse.publish_marts(bank.gold)
    return bank.spark.sql(
        "select k.uf, count(*) as agencias, sum(k.saldo_total) as saldo, sum(r.volume_total) as volume "
        "from mart_kpi1 k join mart_kpi5 r on r.cod_agencia = k.cod_agencia group by k.uf"
    )


@query("kpi7_client_segments", f"""
    select k.faixa_etaria, count(distinct k.sk_cliente) as qtd_clientes,
           {avg_money('sum(c.saldo_total)', 'count(c.saldo_total)')} as saldo_medio, {money('c.saldo_total')} as saldo_total,
           {ratio('sum(k.score_credito)', 'count(k.score_credito)', 2)} as score_medio, count(distinct c.num_conta) as qtd_contas,
           coalesce(nullif(list_position(['18-24', '25-34', '35-44', '45-54', '55-64', '65+'], k.faixa_etaria), 0), 7) as ordem
    from g_cliente k left join f_contas c on c.sk_cliente = k.sk_cliente and c.computed_flag
    group by k.faixa_etaria""")
def kpi7(bank):
    labels = [label for _, _, label in AGE_BANDS]
    return bank.mart("kpi7").withColumn("ordem", marts.band_order("faixa_etaria", labels).cast("int"))


@query("kpi8_deflated_volume", f"""
    select m.ano, m.mes, m.mes_nome, m.indice_ipca::double as indice_mes, b.base::double as indice_base, m.volume::double as volume_nominal,
           {ratio(f"{cents('m.volume')} * {cents('b.base')}", cents('m.indice_ipca'))} / 100 as volume_real,
           {ratio(cents('b.base'), cents('m.indice_ipca'), 6)} as fator_correcao
    from (select t.ano, t.mes, t.mes_nome, t.indice_ipca, sum(x.valor_absoluto) as volume
          from f_transacoes x join g_tempo t using (sk_tempo) where t.indice_ipca is not null group by all) m,
         (select arg_max(indice_ipca, data) as base from g_tempo where indice_ipca is not null) b""")
def kpi8(bank):
    return bank.mart("kpi8")


@query("working_days_per_month", """
    select ano, mes, mes_nome, count(*) filter (where not eh_fim_semana and not eh_feriado) as dias_uteis,
           count(*) filter (where eh_feriado) as qtd_feriados, count(*) as total_dias
    from g_tempo group by all""")
def working_days_per_month(bank):
    return marts.working_days(bank.gold["dim_tempo"])


@query("clients_by_municipality", f"""
    select m.municipio, m.uf, m.regiao, m.populacao,
           m.pib_per_capita::double as pib_per_capita, count(distinct k.sk_cliente) as qtd_clientes,
           {pct('count(distinct k.sk_cliente)', 'm.populacao', 4)} as penetracao_pct,
           {money('x.valor_transacao')} as volume_transacoes,
           {avg_money('sum(x.valor_transacao)', 'count(x.valor_transacao)')} as ticket_medio
    from g_municipio m left join g_cliente k on k.sk_municipio = m.sk_municipio
    left join f_transacoes x on x.sk_cliente = k.sk_cliente
    group by m.sk_municipio, m.municipio, m.uf, m.regiao, m.populacao, m.pib_per_capita""", ("populacao",))
def clients_by_municipality(bank):
    gold = bank.gold
    return marts.clients_by_municipality(gold["dim_municipio"], gold["dim_cliente"], gold["fato_transacoes"])


@query("credit_by_region", f"""
    select m.regiao, m.uf, {avg_money('sum(m.pib_per_capita)', 'count(m.pib_per_capita)')} as pib_per_capita_medio,
           count(*) as qtd_propostas, count(*) filter (where p.status_proposta = 'Aprovada') as propostas_aprovadas,
           {pct("count(*) filter (where p.status_proposta = 'Aprovada')", 'count(*)')} as taxa_aprovacao_pct,
           {avg_money('sum(p.valor_proposta)', 'count(p.valor_proposta)')} as valor_medio_solicitado
    from g_municipio m join g_cliente k on k.sk_municipio = m.sk_municipio join f_propostas p on p.sk_cliente = k.sk_cliente
    group by m.regiao, m.uf""")
def credit_by_region(bank):
    gold = bank.gold
    return marts.credit_by_region(gold["dim_municipio"], gold["dim_cliente"], gold["fato_propostas_credito"])


@query("transactions_in_dollars", f"""
    select x.cod_transacao, t.data::varchar as data, x.valor_transacao::double as valor_transacao, t.cotacao_dolar::double as cotacao_dolar,
           case when t.cotacao_dolar > 0 then {ratio(f"{cents('x.valor_transacao')} * 1000000", "(t.cotacao_dolar * 1000000)::hugeint")} / 100 end as valor_usd
    from f_transacoes x join g_tempo t using (sk_tempo)""")
def transactions_in_dollars(bank):
    return marts.transactions_in_dollars(bank.gold["fato_transacoes"], bank.gold["dim_tempo"])


@query("transactions_against_rate", f"""
    select x.cod_transacao, t.data::varchar as data, x.valor_transacao::double as valor_transacao, t.taxa_selic::double as taxa_selic,
           {ratio("(t.taxa_selic * 1000000)::hugeint", "252000000", 6)} as selic_diaria,
           {ratio(f"{cents('x.valor_transacao')} * (t.taxa_selic * 1000000)::hugeint", "25200000000")} / 100 as custo_oportunidade_dia
    from f_transacoes x join g_tempo t using (sk_tempo) where t.taxa_selic is not null""")
def transactions_against_rate(bank):
    return marts.transactions_against_rate(bank.gold["fato_transacoes"], bank.gold["dim_tempo"])


@query("first_branch_per_client", """
    select cod_cliente, arg_min(cod_agencia, num_conta) as cod_agencia from s_contas group by 1""")
def first_branch_per_client(bank):
    return marts.first_branch(bank.silver["contas"])


@query("last_quote_of_day", """
    select dia::varchar as data, c::double as cotacao_compra, v::double as cotacao_venda,
           ((((c + v) * 10000)::bigint + 1) // 2)::double / 10000 as cotacao_media
    from (select ts::date as dia, arg_max(c, (ts, c, v)) as c, arg_max(v, (ts, c, v)) as v
          from (select ts, cast(value as decimal(14,4)) as c, cast(value * 1.5 as decimal(14,4)) as v from events) group by 1)""")
def last_quote_of_day(bank):
    quotes = bank.table("events").select(
        "ts", F.col("value").cast("decimal(14,4)").alias("compra"), (F.col("value") * 1.5).cast("decimal(14,4)").alias("venda")
    )
    return marts.last_quote_of_day(quotes, "ts", "compra", "venda")


@query("investment_total", f"""
    select coalesce(sum(case when status = 'Ativo' then valor_atual end), 0)::double as patrimonio_ativo, count(*) as qtd_posicoes
    from (select case when data_vencimento <= date '2001-08-01' then 'Vencido' else 'Ativo' end as status,
                 cast({ratio(f"{cents('valor_aplicado')} * (10000 + (rentabilidade * 10000)::hugeint)", "10000")} / 100 as decimal(18,2)) as valor_atual
          from e_investimentos)""")
def investment_total(bank):
    positions = bank.event("investimentos").select(
        finance.current_value("valor_aplicado", "rentabilidade").alias("valor_atual"),
        finance.maturity_status("data_vencimento", "2001-08-01").alias("status"),
    )
    return marts.investment_total(positions)


@query("arrears_total", "select sum(valor_aberto)::double as carteira_em_atraso, count(*) as qtd_contratos from e_inadimplencia")
def arrears_total(bank):
    return marts.arrears_total(bank.event("inadimplencia"))


@query("fraud_totals", """
    select count(*) as qtd_ocorrencias, count(*) filter (where flag_confirmada) as qtd_confirmadas,
           sum(valor_fraude) filter (where flag_confirmada)::double as valor_confirmado, sum(valor_recuperado)::double as valor_recuperado
    from e_fraudes""")
def fraud_totals(bank):
    return marts.fraud_totals(bank.event("fraudes"))


@query("value_calibration", """
    select nome_transacao, count(*) as qtd, round(stddev_pop(valor_absoluto::double) + 1, 2) as desvio,
           median((valor_absoluto * 100)::bigint) / 100 as mediana
    from s_transacoes where valor_absoluto > 0 group by 1""")
def value_calibration(bank):
    return marts.value_calibration(bank.silver["transacoes"])


@query("event_value_median", """
    select event_type, median((v * 100)::bigint) / 100 as mediana from (select event_type, cast(value as decimal(14,2)) as v from events) group by 1""")
def event_value_median(bank):
    values = bank.table("events").select("event_type", F.col("value").cast("decimal(14,2)").alias("v"))
    return marts.exact_median(values, "event_type", "v")


@query("branch_counts_by_region", "select regiao, count(*) as qtd from g_agencia group by 1")
def branch_counts_by_region(bank):
    return marts.counts_by(bank.gold["dim_agencia"], "regiao")


@query("branch_counts_by_type", "select tipo_agencia, count(*) as qtd from g_agencia group by 1")
def branch_counts_by_type(bank):
    return marts.counts_by(bank.gold["dim_agencia"], "tipo_agencia")


@query("branch_openings_by_year", """
    select year(data_abertura)::int as ano, count(*) as qtd, (sum(count(*)) over (order by year(data_abertura)))::bigint as acumulado
    from g_agencia group by year(data_abertura)""")
def branch_openings_by_year(bank):
    return marts.openings_by_year(bank.gold["dim_agencia"])


_QUOTAS = """
    select n_nationkey, n, greatest(1, round_even(1100 * n::double / (sum(n) over ())::double, 0))::bigint as q
    from (select c_nationkey as n_nationkey, count(*) as n from customer group by 1)"""


@query("staff_allocated_by_clients", f"""
    select n_nationkey, n as peso,
           q + case when n_nationkey = (select arg_min(n_nationkey, (-q, n_nationkey)) from ({_QUOTAS}))
                    then 1100 - (select sum(q) from ({_QUOTAS})) else 0 end::bigint as cota
    from ({_QUOTAS})""")
def staff_allocated_by_clients(bank):
    weights = bank.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("peso"))
    return marts.allocate(weights, "n_nationkey", "peso", 1100)


@query("gdp_per_head", f"""
    select g.c_nationkey, g.pib_mil * 1000 as pib_total,
           case when p.populacao > 0 then {ratio('g.pib_mil * 1000', 'p.populacao', 2)} end as pib_per_capita
    from (select c_nationkey, count(*) * 7919 as pib_mil from customer group by 1) g
    left join (select s_nationkey, (count(*) - 1) * 37 as populacao from supplier group by 1) p on p.s_nationkey = g.c_nationkey""")
def gdp_per_head(bank):
    gdp = bank.table("customer").groupBy("c_nationkey").agg((F.count("*") * 7919).alias("pib_mil"))
    people = bank.table("supplier").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(
        ((F.count("*") - 1) * 37).alias("populacao")
    )
    return marts.gdp_per_head(gdp, people, "c_nationkey").select("c_nationkey", "pib_total", "pib_per_capita")


@query("income_per_head", f"""
    select codigo_ibge, coalesce(s.renda::double, {ratio(cents('pib_per_capita'), '12')} / 100) as renda_media_per_capita,
           case when s.renda is not null then 'PUBLICADA' else 'ESTIMATIVA' end as fonte
    from g_municipio left join (select 1000000 + s_nationkey as codigo_ibge, max(cast(s_acctbal as decimal(14,2))) as renda
                                from supplier group by 1) s using (codigo_ibge)""")
def income_per_head(bank):
    published = (
        bank.table("supplier").groupBy((F.col("s_nationkey") + 1000000).alias("codigo_ibge"))
        .agg(F.max(F.col("s_acctbal").cast("decimal(14,2)")).alias("renda"))
    )
    return marts.income_per_head(published, bank.gold["dim_municipio"])


@query("accounts_marked_all_active", f"""
    select a.cod_agencia, count(distinct c.num_conta) as qtd_contas, {money('c.saldo_total')} as saldo_total
    from f_contas c join g_agencia a using (sk_agencia) group by 1""")
def accounts_marked_all_active(bank):
    """The form of the account fact that treats every account as active."""
    gold = bank.gold
    fact = facts.fact_accounts(
        bank.silver["contas"], gold["dim_tempo"], gold["dim_cliente"], gold["dim_agencia"], gold["dim_colaborador"],
        F.lit("2001-08-01").cast("date"),
    )
    return marts.balance_by_branch(fact, gold["dim_agencia"], labels=["cod_agencia"]).select(
        "cod_agencia", "qtd_contas", "saldo_total"
    )


@query("original_accounts_only", f"""
    select count(*) as qtd, {money('valor_absoluto')} as volume from f_transacoes
    where num_conta in (select num_conta::bigint from raw_contas)""")
def original_accounts_only(bank):
    """Volume of the accounts named in a raw list, by semi join; the key is cast once."""
    listed = bank.raw["contas"].select(t.to_whole("num_conta").alias("num_conta"))
    kept = bank.gold["fato_transacoes"].join(listed, "num_conta", "left_semi")
    return kept.agg(F.count("*").alias("qtd"), marts.money("valor_absoluto").alias("volume"))
