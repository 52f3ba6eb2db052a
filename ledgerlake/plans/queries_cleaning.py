"""Cleaning operators and business columns over the raw bank tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import dates, finance, rules
from ledgerlake.functions import text as t
from ledgerlake.operators import cleaning, dimensions, marts
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import (
    CHANNEL_FAMILIES,
    CHANNEL_WORDS,
    SERVICE_FAMILIES,
    SERVICE_WORDS,
    age,
    age_band,
    cents,
    family,
    number,
    ratio,
    region,
    words,
)


@query("clean_clients", """
    select cod_cliente, primeiro_nome, ultimo_nome, email, tipo_pessoa, data_inclusao::varchar as data_inclusao, cpf_digits,
           cpf_formatado, data_nascimento::varchar as data_nascimento, endereco, cep_digits, idade, faixa_etaria
    from s_clientes""", ("idade",))
def clean_clients(bank):
    return bank.clean("clientes")


@query("clean_synthetic_clients", """
    select * replace (data_inclusao::varchar as data_inclusao, data_nascimento::varchar as data_nascimento,
                      renda_mensal::double as renda_mensal) from s_sinteticos""")
def clean_synthetic_clients(bank):
    return bank.clean("clientes_sinteticos")


@query("clean_accounts", """
    select * replace (data_abertura::varchar as data_abertura, saldo_total::double as saldo_total,
                      saldo_disponivel::double as saldo_disponivel, data_ultimo_lancamento::varchar as data_ultimo_lancamento)
    from s_contas""", ("cod_colaborador",))
def clean_accounts(bank):
    return bank.clean("contas")


@query("clean_transactions", """
    select * replace (strftime(data_transacao, '%Y-%m-%d %H:%M:%S') as data_transacao, valor_transacao::double as valor_transacao,
                      mes_referencia::varchar as mes_referencia, valor_absoluto::double as valor_absoluto)
    from s_transacoes""")
def clean_transactions(bank):
    return bank.clean("transacoes")


@query("clean_branches", """
    select * replace (data_abertura::varchar as data_abertura, meta_comercial_mensal::double as meta_comercial_mensal,
                      latitude::double as latitude, longitude::double as longitude) from s_agencias""")
def clean_branches(bank):
    return bank.clean("agencias")


@query("clean_staff", """
    select * replace (data_nascimento::varchar as data_nascimento, salario_base::double as salario_base,
                      data_admissao::varchar as data_admissao, data_demissao::varchar as data_demissao) from s_colaboradores""", ("cod_agencia", "nivel_hierarquico"))
def clean_staff(bank):
    return bank.clean("colaboradores")


@query("clean_proposals", """
    select * replace (data_entrada_proposta::varchar as data_entrada_proposta, taxa_juros_mensal::double as taxa_juros_mensal,
                      valor_proposta::double as valor_proposta, valor_financiamento::double as valor_financiamento,
                      valor_entrada::double as valor_entrada, valor_prestacao::double as valor_prestacao) from s_propostas""")
def clean_proposals(bank):
    return bank.clean("propostas")


@query("clean_ipca", """
    select * replace (data::varchar as data, indice::double as indice, variacao_mensal::double as variacao_mensal,
                      acumulado_12m::double as acumulado_12m, acumulado_ano::double as acumulado_ano) from s_ipca""")
def clean_ipca(bank):
    return bank.clean("ipca")


@query("clean_selic", """
    select data::varchar as data, taxa_selic::double as taxa_selic, taxa_selic_aa::double as taxa_selic_aa, tipo from s_selic""")
def clean_selic(bank):
    return bank.clean("selic")


@query("clean_municipalities", f"""
    select m.codigo_ibge::int as codigo_ibge, m.municipio, upper(m.uf) as uf, {region('m.uf')} as regiao,
           p.populacao::int as populacao, p.ano::int as ano_populacao, g.pib_total::bigint as pib_total,
           g.pib_per_capita::double as pib_per_capita, g.ano::int as ano_pib
    from raw_municipios m
    left join raw_populacao p on p.codigo_ibge = m.codigo_ibge and p.ano = '2022'
    left join raw_pib_municipal g on g.codigo_ibge = m.codigo_ibge and g.ano = '2021'""", ("populacao", "ano_populacao", "pib_total", "ano_pib"))
def clean_municipalities(bank):
    return bank.clean("municipios")


@query("latest_year_municipalities", """
    select codigo_ibge, municipio, uf, populacao, ano_populacao, pib_total, pib_per_capita::double as pib_per_capita, ano_pib, regiao,
           case when pib_per_capita < 10000 then '<10k' when pib_per_capita < 25000 then '10-25k'
                when pib_per_capita < 50000 then '25-50k' else '>50k' end as faixa_pib_per_cap
    from g_municipio""", ("populacao", "ano_populacao", "pib_total", "ano_pib"))
def latest_year_municipalities(bank):
    return dimensions.municipality_rows(
        bank.raw["municipios"], bank.raw["populacao"], bank.raw["pib_municipal"]
    )


@query("proposals_under_common_names", """
    select cod_proposta, data_entrada_proposta as data_proposta, taxa_juros_mensal as taxa_juros,
           quantidade_parcelas as prazo_meses, null as produto from raw_propostas_credito
    union all
    select cod_proposta, data_entrada_proposta, taxa_juros_mensal, quantidade_parcelas, produto from raw_propostas_sinteticas""")
def proposals_under_common_names(bank):
    both = [
        cleaning.rename_to(bank.raw[name], cleaning.PROPOSAL_NAMES)
        for name in ("propostas_credito", "propostas_sinteticas")
    ]
    return both[0].unionByName(both[1], allowMissingColumns=True).select(
        "cod_proposta", "data_proposta", "taxa_juros", "prazo_meses", "produto"
    )


@query("numeric_texts", f"""
    select num_conta, saldo_total as texto, regexp_full_match(saldo_total, '-?[0-9]+\\.?[0-9]*') as numero,
           regexp_full_match(saldo_total, '[0-9]+\\.?[0-9]*') as numero_sem_sinal,
           ({number('saldo_total')})::double as valor from raw_contas""")
def numeric_texts(bank):
    return bank.raw["contas"].select(
        "num_conta",
        F.col("saldo_total").alias("texto"),
        t.numeric_text("saldo_total").alias("numero"),
        t.numeric_text("saldo_total", signed=False).alias("numero_sem_sinal"),
        t.strict_decimal("saldo_total").alias("valor"),
    )


@query("coerced_numbers", """
    select num_conta, valor::double as valor
    from (select num_conta, try_cast(saldo_total as decimal(14,2)) as valor from raw_contas) where valor is not null""")
def coerced_numbers(bank):
    parsed = bank.raw["contas"].select("num_conta", t.to_decimal("saldo_total").alias("valor"))
    return cleaning.drop_unparsed(parsed, ["valor"])


_DAY_PARTS = ("lpad(cast(extract(day from o_orderdate) as string), 2, '0') || '/' || "
              "lpad(cast(extract(month from o_orderdate) as string), 2, '0') || '/' || cast(extract(year from o_orderdate) as string)")
_MIXED_TEXT = f"""case o_orderkey % 6
    when 0 then cast(cast(o_orderdate as date) as string) || ' 10:15:00+02:00'
    when 1 then cast(cast(o_orderdate as date) as string) || 'T10:15:00Z'
    when 2 then {_DAY_PARTS} || ' 10:15:00'
    when 3 then {_DAY_PARTS}
    when 4 then cast(cast(o_orderdate as date) as string) || ' 10:15:00 UTC'
    else 'sem data' end"""


@query("mixed_instants", """
    select o_orderkey, strftime(case o_orderkey % 6
             when 0 then o_orderdate + interval '8 hours 15 minutes' when 3 then o_orderdate
             when 5 then null else o_orderdate + interval '10 hours 15 minutes' end, '%Y-%m-%d %H:%M:%S') as instante
    from orders""")
def mixed_instants(bank):
    texts = bank.table("orders").select("o_orderkey", F.expr(_MIXED_TEXT).alias("texto"))
    return texts.select("o_orderkey", t.mixed_instant("texto").alias("instante"))


@query("comma_decimals", """
    select c_custkey, case when c_custkey % 10 in (3, 4, 5) then null else cast(c_acctbal as decimal(14,2))::double end as valor
    from customer""")
def comma_decimals(bank):
    text = F.expr(
        "case c_custkey % 10 when 3 then '-' when 4 then 'null' when 5 then '' "
        "else replace(cast(cast(c_acctbal as decimal(14,2)) as string), '.', ',') end"
    )
    return bank.table("customer").select("c_custkey", t.comma_decimal(text).alias("valor"))


@query("nested_places", """
    select n_nationkey::bigint as codigo_ibge, n_name as municipio, 'U' || n_nationkey as uf, 'Estado ' || n_nationkey as uf_nome,
           case n_regionkey when 0 then 'Norte' when 1 then 'Nordeste' when 2 then 'Sudeste' when 3 then 'Sul' else 'R4' end as regiao,
           case n_regionkey when 0 then 'N' when 1 then 'NE' when 2 then 'SE' when 3 then 'S' else 'R4' end as regiao_sigla
    from nation""")
def nested_places(bank):
    code = F.expr("element_at(array('N', 'NE', 'SE', 'S', 'R4'), n_regionkey + 1)")
    state = F.struct(
        F.concat(F.lit("U"), "n_nationkey").alias("sigla"),
        F.concat(F.lit("Estado "), "n_nationkey").alias("nome"),
        F.struct(code.alias("sigla")).alias("regiao"),
    )
    near = F.struct(F.struct(state.alias("UF")).alias("mesorregiao"))
    wide = F.struct(F.struct(state.alias("UF")).alias("regiao-intermediaria"))
    first = F.col("n_nationkey") % 2 == 0
    place = F.struct(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("nome"),
        F.when(first, near).alias("microrregiao"),
        F.when(~first, wide).alias("regiao-imediata"),
    )
    return cleaning.flatten_places(bank.table("nation").select(F.to_json(place).alias("value")))


@query("nested_series_totals", """
    select c_nationkey::varchar as codigo_ibge, sum(n)::bigint as total
    from (select c_nationkey, c_mktsegment, count(*) * 1000 as n from customer where c_mktsegment <> 'MACHINERY' group by 1, 2)
    group by 1""")
def nested_series_totals(bank):
    """One JSON answer per place, whose cells carry blanks, suppression marks and numbers."""
    counts = bank.table("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    cell = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("...")).otherwise(
        F.concat(F.col("n").cast("string"), F.lit(" 000"))
    )
    series = F.struct(
        F.struct(F.col("c_nationkey").cast("string").alias("id"), F.lit("x").alias("nome")).alias("localidade"),
        F.create_map(F.lit("2022"), cell).alias("serie"),
    )
    answer = F.to_json(F.array(F.struct(F.array(F.struct(F.array(series).alias("series"))).alias("resultados"))))
    flat = cleaning.flatten_series(counts.select(answer.alias("value")))
    return marts.total_over_categories(flat, "codigo_ibge", t.marked_count("valor"))


_D = [f"(ascii(substr(d, {i}, 1)) - 48)" for i in range(1, 12)]


def _check(length: int) -> str:
    total = " + ".join(f"{_D[i]} * {length + 1 - i}" for i in range(length))
    return f"case when 11 - ({total}) % 11 >= 10 then 0 else 11 - ({total}) % 11 end"


@query("identity_numbers", f"""
    select cod_cliente, cpfcnpj, case when length(d) <> 11 then false when d = repeat(d[1], 11) then false
                else ({_check(9)}) = {_D[9]} and ({_check(10)}) = {_D[10]} end::varchar as cpf_valido,
           length(regexp_replace(cep, '[^0-9]', '', 'g')) = 8 as cep_valido
    from (select *, regexp_replace(cpfcnpj, '[^0-9]', '', 'g') as d from raw_clientes)""")
def identity_numbers(bank):
    # A missing number is neither valid nor invalid, so the verdict is published as text.
    return bank.raw["clientes"].select(
        "cod_cliente", "cpfcnpj", t.valid_cpf("cpfcnpj").cast("string").alias("cpf_valido"),
        t.valid_cep("cep").alias("cep_valido"),
    )


_BY_DAYS = "date_diff('day', data_nascimento, date '2026-06-10') / 365.25"


@query("age_bands", f"""
    select cod_cliente, {age('data_nascimento')} as idade, {age_band(age('data_nascimento'), 'Menor de idade')} as faixa,
           case when {_BY_DAYS} < 25 then '18-24' when {_BY_DAYS} < 35 then '25-34' when {_BY_DAYS} < 45 then '35-44'
                when {_BY_DAYS} < 55 then '45-54' when {_BY_DAYS} < 65 then '55-64' else '65+' end as faixa_por_dias
    from (select cod_cliente, try_cast(data_nascimento as date) as data_nascimento from raw_clientes)""", ("idade",))
def age_bands(bank):
    birth = t.to_day("data_nascimento")
    return bank.raw["clientes"].select(
        "cod_cliente",
        dates.age_years(birth).alias("idade"),
        rules.age_band(dates.age_years(birth), "Menor de idade").alias("faixa"),
        rules.age_band_by_days(birth, dates.day(dates.REFERENCE_DAY)).alias("faixa_por_dias"),
    )


_EARLIER = "date '2024-03-01'"


@query("ages_at_another_day", f"""
    select cod_cliente, {age('data_nascimento', _EARLIER)} as idade, {age_band(age('data_nascimento', _EARLIER))} as faixa_etaria
    from s_clientes""", ("idade",))
def ages_at_another_day(bank):
    """The clean clients of a layer whose day is not the default one."""
    return cleaning.clean_clients(bank.raw["clientes"], dt.date(2024, 3, 1)).select("cod_cliente", "idade", "faixa_etaria")


@query("score_bands", """
    select k.cod_cliente, k.score_credito, b.classificacao as faixa, b.faixa_score as intervalo, b.risco, b.taxa::double as taxa_max_mes
    from (select cod_cliente, score_credito::int as score_credito from raw_clientes_sinteticos) k
    join (values (0, 300, 'Muito Baixo', '0-300', 'Alto', 0.30), (301, 500, 'Baixo', '301-500', 'Alto', 0.03),
                 (501, 700, 'Regular', '501-700', 'Médio', 0.02), (701, 850, 'Bom', '701-850', 'Baixo', 0.01),
                 (851, 1000, 'Excelente', '851-1000', 'Baixo', 0.006)) b(lo, hi, classificacao, faixa_score, risco, taxa)
      on k.score_credito between b.lo and b.hi""")
def score_bands(bank):
    clients = bank.raw["clientes_sinteticos"].select(
        "cod_cliente", t.to_whole("score_credito").alias("score_credito")
    )
    return dimensions.with_score_class(clients, "score_credito").select(
        "cod_cliente",
        "score_credito",
        rules.score_band("score_credito").alias("faixa"),
        F.col("faixa_score").alias("intervalo"),
        "risco",
        "taxa_max_mes",
    )


@query("income_bands", """
    select case when c_acctbal * 3 < 2000 then '<2k' when c_acctbal * 3 < 5000 then '2-5k' when c_acctbal * 3 < 10000 then '5-10k'
                when c_acctbal * 3 < 20000 then '10-20k' else '>20k' end as faixa_renda, count(*) as qtd
    from customer group by 1""")
def income_bands(bank):
    return marts.counts_by(
        bank.table("customer").select(rules.income_band(F.col("c_acctbal") * 3).alias("faixa_renda")), "faixa_renda"
    )


@query("channel_names", f"""
    select *, {family('canal', CHANNEL_FAMILIES, 'Digital')} as tipo_canal,
           {family('atendimento', SERVICE_FAMILIES, 'Automatico')} as tipo_atendimento
    from (select nome_transacao, {words('nome_transacao', CHANNEL_WORDS)} as canal,
                 {words('nome_transacao', SERVICE_WORDS)} as atendimento, count(*) as qtd
          from raw_transacoes group by 1)""")
def channel_names(bank):
    names = bank.raw["transacoes"].groupBy("nome_transacao").agg(F.count("*").alias("qtd"))
    return names.withColumns(
        {"canal": rules.channel_of("nome_transacao"), "atendimento": rules.service_channel_of("nome_transacao")}
    ).withColumns({"tipo_canal": rules.channel_family("canal"), "tipo_atendimento": rules.service_family("atendimento")})


@query("regions_of_states", f"select cod_agencia, uf, {region('uf')} as regiao from raw_agencias")
def regions_of_states(bank):
    return bank.raw["agencias"].select("cod_agencia", "uf", rules.region_of("uf").alias("regiao"))


@query("arrears_grades", """
    select dias_atraso, case when dias_atraso <= 30 then '0-30' when dias_atraso <= 60 then '31-60' when dias_atraso <= 90 then '61-90'
             else '90+' end as bucket,
           case when dias_atraso > 180 then 'Crítico' when dias_atraso > 90 then 'Alto' when dias_atraso > 30 then 'Médio' else 'Baixo' end as faixa_risco,
           count(*) as qtd
    from e_inadimplencia group by 1""")
def arrears_grades(bank):
    days = marts.counts_by(bank.event("inadimplencia"), "dias_atraso")
    return days.withColumns(
        {"bucket": rules.arrears_bucket("dias_atraso"), "faixa_risco": rules.risk_grade("dias_atraso")}
    )


@query("instalments", """
    select cod_proposta, case when i > 0 then round(v * (i * pow(1 + i, n)) / (pow(1 + i, n) - 1), 2) end as parcela
    from (select cod_proposta, valor_financiamento::double as v, taxa_juros_mensal::double as i, quantidade_parcelas::double as n
          from s_propostas)""")
def instalments(bank):
    return bank.clean("propostas").select(
        "cod_proposta",
        finance.annuity("valor_financiamento", "taxa_juros_mensal", "quantidade_parcelas").alias("parcela"),
    )


@query("investment_values", f"""
    select id_investimento, {ratio(f"{cents('valor_aplicado')} * (10000 + (rentabilidade * 10000)::hugeint)", "10000")} / 100 as valor_atual,
           case when data_vencimento <= date '1999-06-30' then 'Vencido' else 'Ativo' end as status
    from e_investimentos""")
def investment_values(bank):
    return bank.event("investimentos").select(
        "id_investimento",
        finance.current_value("valor_aplicado", "rentabilidade").alias("valor_atual"),
        finance.maturity_status("data_vencimento", "1999-06-30").alias("status"),
    )


@query("card_usage", f"""
    select id_fatura, (limite_total - gasto_mes)::double as limite_disponivel,
           case when limite_total > 0 then {ratio(f"{cents('gasto_mes')} * 100", cents('limite_total'), 2)} else 0 end as pct_utilizacao
    from e_cartoes""")
def card_usage(bank):
    return bank.event("cartoes").select(
        "id_fatura",
        finance.available_limit("limite_total", "gasto_mes").alias("limite_disponivel"),
        finance.utilisation_pct("gasto_mes", "limite_total").alias("pct_utilizacao"),
    )


_NUMBER = "regexp_full_match({}, '-?[0-9]+\\.?[0-9]*')"


_KEY = "case when {0} is null then 'chave ausente' when try_cast({0} as bigint) is null then 'chave inválida'"
_PRODUCT_REJECTS = "".join(
    f""" union all
      select '{table}', case when nullif(trim({key}), '') is null then 'chave ausente' when try_cast(trim({key}) as bigint) is null then 'chave inválida'
             when nullif(trim(cod_cliente), '') is null then 'cliente ausente' when try_cast(trim(cod_cliente) as bigint) is null then 'cliente inválido' end from raw_{table}"""
    for table, key in [("investimentos", "id_investimento"), ("cartoes", "id_fatura"), ("seguros", "id_apolice"), ("inadimplencia", "id_inadimplencia"), ("fraudes", "id_fraude")]
)


@query("rejected_rows", f"""
    select tabela, motivo, count(*) as qtd from (
      select 'clientes' as tabela, case when cpfcnpj is null then 'documento ausente' when cod_cliente is null then 'chave ausente'
             when try_cast(cod_cliente as bigint) is null then 'chave inválida' end as motivo from raw_clientes
      union all
      select 'contas', case when num_conta is null then 'chave ausente' when try_cast(num_conta as bigint) is null then 'chave inválida'
             when saldo_total is null then 'valor ausente' when not {_NUMBER.format('saldo_total')} then 'valor não numérico'
             when abs(round(saldo_total::decimal(38,10), 2)) >= 1000000000000 then 'valor grande demais' end from raw_contas
      union all
      select 'transacoes', case when cod_transacao is null then 'chave ausente' when try_cast(cod_transacao as bigint) is null then 'chave inválida'
             when valor_transacao is null then 'valor ausente' when not {_NUMBER.format('valor_transacao')} then 'valor não numérico'
             when abs(round(valor_transacao::decimal(38,10), 2)) >= 1000000000000 then 'valor grande demais'
             when valor_transacao::decimal(38,10) = 0 then 'valor zero' end from raw_transacoes
      union all
      select 'propostas_credito', case when cod_proposta is null then 'chave ausente' when try_cast(cod_proposta as bigint) is null then 'chave inválida'
             when valor_proposta is null then 'valor ausente' when not regexp_full_match(valor_proposta, '[0-9]+\\.?[0-9]*') then 'valor não numérico'
             when round(valor_proposta::decimal(38,10), 2) >= 1000000000000 then 'valor grande demais' end from raw_propostas_credito
      union all
      select 'clientes_sinteticos', {_KEY.format('cod_cliente')} end from raw_clientes_sinteticos
      union all
      select 'propostas_sinteticas', {_KEY.format('cod_proposta')} end from raw_propostas_sinteticas
      union all
      select 'agencias', case when cod_agencia is null then 'chave ausente' end from raw_agencias
      union all
      select 'ipca', case when data is null then 'chave ausente' when not regexp_full_match(data, '\\d{{4}}-\\d{{2}}-\\d{{2}}') then 'chave inválida' end from raw_ipca
      {_PRODUCT_REJECTS}
    ) where motivo is not null group by 1, 2""")
def rejected_rows(bank):
    """What cleaning leaves out, counted by reason."""
    return cleaning.reject_counts(bank.raw)


@query("amounts_at_the_edges", """
    select cod_transacao, num_conta, valor_transacao::double as valor_transacao, flag_credito from s_transacoes
    where abs(valor_transacao) < 1 or num_conta > 2147483647""")
def amounts_at_the_edges(bank):
    """Tiny amounts and accounts beyond 32 bits are kept."""
    return bank.silver["transacoes"].where("abs(valor_transacao) < 1 or num_conta > 2147483647").select(
        "cod_transacao", "num_conta", "valor_transacao", "flag_credito"
    )


def _lost(table: str, field: str, kind: str) -> str:
    return f"select '{table}' as tabela, '{field}' as campo, count(case when nullif(trim({field}), '') is not null and try_cast(trim({field}) as {kind}) is null then 1 end) as qtd from raw_{table}"


_NARROW = {
    "clientes_sinteticos": ["idade smallint", "score_credito smallint", "renda_mensal decimal(12,2)", "data_nascimento date"],
    "propostas_credito": ["quantidade_parcelas smallint", "carencia smallint", "taxa_juros_mensal decimal(8,6)", "data_entrada_proposta date"],
    "propostas_sinteticas": ["quantidade_parcelas smallint", "carencia smallint", "taxa_juros_mensal decimal(8,6)", "valor_proposta decimal(14,2)"],
    "transacoes": ["num_conta bigint", "data_transacao timestamp"],
    "contas": ["saldo_disponivel decimal(14,2)", "data_abertura date", "data_ultimo_lancamento date"],
}


@query("lost_values", " union all ".join(_lost(table, *column.split(" ", 1)) for table, columns in _NARROW.items() for column in columns))
def lost_values(bank):
    """Fields that were given but do not fit their column."""
    return cleaning.lost_values(bank.raw, {table: cleaning.NARROW[table] for table in _NARROW})
