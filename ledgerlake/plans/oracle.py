"""The same answers in plain SQL, for DuckDB to compute from the supplied tables.

Nothing here is used by the engine. A query names the building blocks it needs
and `sql` puts them in front of it. Rounded quotients are formed in whole
numbers, so that both engines round exact halves alike.
"""

from __future__ import annotations

import re

from ledgerlake.plans.bank_view import EVENT_SQL, RAW_SQL, TABLES

SIGNED, UNSIGNED = r"-?[0-9]+\.?[0-9]*", r"[0-9]+\.?[0-9]*"
# Fixed values, written out once more so that a wrong one in the engine shows.
AGE_BANDS = [(18, 24, "18-24"), (25, 34, "25-34"), (35, 44, "35-44"), (45, 54, "45-54"), (55, 64, "55-64"), (65, None, "65+")]
STATES = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
CHANNEL_WORDS = [
    ("pix", "Pix"), ("ted", "TED"), ("doc", "DOC"), ("credito", "Compra Credito"), ("debito", "Compra Debito"),
    ("saque", "Saque"), ("deposito", "Deposito Especie"), ("boleto", "Pagamento Boleto"),
]
SERVICE_WORDS = [
    ("internet banking", "Internet Banking"), ("aplicativo", "Aplicativo Movel"), ("app", "Aplicativo Movel"),
    ("pix", "Aplicativo Movel"), ("caixa eletronico", "Caixa Eletronico"), ("atm", "Caixa Eletronico"), ("agencia", "Agencia"),
    ("telefone", "Central Telefonica"), ("debito automatico", "Debito Automatico"), ("ted", "Internet Banking"),
]
CHANNEL_FAMILIES = {
    "Transferencia": ["Pix", "TED", "DOC"], "Cartao": ["Compra Credito", "Compra Debito"], "Caixa": ["Saque", "Deposito Especie"], "Boleto": ["Pagamento Boleto"],
}
SERVICE_FAMILIES = {
    "Digital": ["Internet Banking", "Aplicativo Movel"], "Autoatendimento": ["Caixa Eletronico"], "Presencial": ["Agencia"], "Remoto": ["Central Telefonica"],
}
GDP_GROWTH = {"Norte": 0.065, "Nordeste": 0.055, "Centro-Oeste": 0.080, "Sudeste": 0.048, "Sul": 0.058}
POPULATION_GROWTH = {"Norte": 0.010, "Nordeste": 0.004, "Centro-Oeste": 0.012, "Sudeste": 0.005, "Sul": 0.006}
AS_OF, LAST_DAY = "date '2026-06-10'", "date '2001-08-01'"


def ratio(num: str, den: str, places: int = 0) -> str:
    """num / den for whole numbers, rounded half away from zero, as a double."""
    n, d, scale = f"({num})::hugeint", f"({den})::hugeint", 10**places
    quotient = f"sign({n}) * ((abs({n}) * {2 * scale} + {d}) // (2 * {d}))"
    return f"(case when {d} <> 0 then ({quotient})::double / {scale} end)"


def cents(amount: str) -> str:
    return f"(({amount}) * 100)::hugeint"


def avg_money(total: str, n: str) -> str:
    return f"({ratio(cents(total), n)} / 100)"


def pct(part: str, whole: str, places: int = 2) -> str:
    return ratio(f"({part}) * 100", whole, places)


def money(amount: str) -> str:
    return f"sum({amount})::double"


def number(text: str, kind: str = "decimal(14,2)", signed: bool = True) -> str:
    pattern = SIGNED if signed else UNSIGNED
    return f"case when regexp_full_match({text}, '{pattern}') then try_cast({text} as {kind}) end"


def held(text: str, signed: bool = True) -> str:
    """The amount rounded to cents, null where it has too many digits."""
    return f"try_cast({number(text, 'decimal(38,10)', signed)} as decimal(14,2))"


def age(birth: str, day: str = AS_OF) -> str:
    return f"date_part('year', age({day}, {birth}))::int"


def age_band(years: str, below: str = "Menor") -> str:
    cases = " ".join(
        f"when {years} >= {low} {'' if high is None else f'and {years} <= {high}'} then '{label}'"
        for low, high, label in AGE_BANDS
    )
    return f"case {cases} else '{below}' end"


def region(state: str) -> str:
    cases = " ".join(
        f"when upper({state}) in ({', '.join(repr(s) for s in states)}) then '{name}'"
        for name, states in STATES.items()
    )
    return f"case {cases} else 'Sudeste' end"


def words(name: str, pairs: list[tuple[str, str]]) -> str:
    return "case " + " ".join(f"when {name} ilike '%{w}%' then '{label}'" for w, label in pairs) + " else 'Outros' end"


def family(value: str, families: dict[str, list[str]], default: str) -> str:
    cases = " ".join(
        f"when {value} in ({', '.join(repr(m) for m in members)}) then '{name}'" for name, members in families.items()
    )
    return f"case {cases} else '{default}' end"


def _daily(source: str, column: str, name: str) -> str:
    return (f"select try_cast(data as date) as data, max({number(column, 'decimal(14,6)')}) as {name} "
            f"from {source} group by 1 having max({number(column, 'decimal(14,6)')}) is not null")


_PROPOSAL = """
    try_cast(cod_proposta as bigint) as cod_proposta, try_cast(cod_cliente as bigint) as cod_cliente,
    try_cast(cod_colaborador as bigint) as cod_colaborador, try_cast(data_entrada_proposta as date) as data_entrada_proposta,
    try_cast(taxa_juros_mensal as decimal(8,6)) as taxa_juros_mensal, {amount} as valor_proposta,
    try_cast(valor_financiamento as decimal(14,2)) as valor_financiamento,
    try_cast(valor_entrada as decimal(14,2)) as valor_entrada, try_cast(valor_prestacao as decimal(14,2)) as valor_prestacao,
    try_cast(quantidade_parcelas as int) as quantidade_parcelas,
    coalesce(try_cast(nullif(carencia, '') as int), 0) as carencia_dias, trim(status_proposta) as status_proposta"""

BLOCKS: dict[str, str] = {
    **{f"raw_{name}": text.format(**{t: t for t in TABLES}) for name, text in RAW_SQL.items()},
    **{f"e_{name}": text.format(**{t: t for t in TABLES}) for name, text in EVENT_SQL.items()},
    "s_clientes": f"""
        select *, {age('data_nascimento')} as idade, {age_band(age('data_nascimento'))} as faixa_etaria
        from (select try_cast(cod_cliente as bigint) as cod_cliente, trim(primeiro_nome) as primeiro_nome,
                     trim(ultimo_nome) as ultimo_nome, lower(trim(email)) as email,
                     upper(trim(tipo_cliente)) as tipo_pessoa, try_cast(data_inclusao as date) as data_inclusao,
                     regexp_replace(cpfcnpj, '\\D', '', 'g') as cpf_digits, cpfcnpj as cpf_formatado,
                     try_cast(data_nascimento as date) as data_nascimento, trim(endereco) as endereco,
                     regexp_replace(cep, '\\D', '', 'g') as cep_digits
              from raw_clientes where cpfcnpj is not null)""",
    "s_sinteticos": """
        select try_cast(cod_cliente as bigint) as cod_cliente, trim(primeiro_nome) as primeiro_nome,
               trim(ultimo_nome) as ultimo_nome, lower(trim(email)) as email, upper(tipo_cliente) as tipo_pessoa,
               try_cast(data_inclusao as date) as data_inclusao, cpfcnpj as cpf_formatado,
               try_cast(data_nascimento as date) as data_nascimento, try_cast(idade as int) as idade, faixa_etaria,
               cidade, upper(uf) as uf, cep as cep_digits, try_cast(renda_mensal as decimal(12,2)) as renda_mensal,
               faixa_renda, profissao, escolaridade, try_cast(score_credito as int) as score_credito, faixa_score
        from raw_clientes_sinteticos""",
    "s_contas": f"""
        select *, coalesce(data_ultimo_lancamento >= (select max(try_cast(data_ultimo_lancamento as date)) from raw_contas) - 90,
                           false) as eh_conta_ativa
        from (select try_cast(num_conta as bigint) as num_conta, try_cast(cod_cliente as bigint) as cod_cliente,
                     try_cast(cod_agencia as bigint) as cod_agencia, try_cast(cod_colaborador as bigint) as cod_colaborador,
                     trim(tipo_conta) as tipo_conta, try_cast(data_abertura as date) as data_abertura,
                     {held('saldo_total')} as saldo_total, try_cast(saldo_disponivel as decimal(14,2)) as saldo_disponivel,
                     try_cast(data_ultimo_lancamento as date) as data_ultimo_lancamento
              from raw_contas)
        where saldo_total is not null""",
    "s_transacoes": f"""
        select * exclude (wide), date_trunc('month', data_transacao)::date as mes_referencia, abs(valor_transacao) as valor_absoluto,
               wide >= 0 as flag_credito
        from (select try_cast(cod_transacao as bigint) as cod_transacao, try_cast(num_conta as bigint) as num_conta,
                     try_cast(data_transacao as timestamp) as data_transacao, trim(nome_transacao) as nome_transacao,
                     {held('valor_transacao')} as valor_transacao, {number('valor_transacao', 'decimal(38,10)')} as wide, {words('nome_transacao', CHANNEL_WORDS)} as canal
              from raw_transacoes)
        where wide <> 0 and valor_transacao is not null""",
    "s_agencias": f"""
        select try_cast(a.cod_agencia as bigint) as cod_agencia, trim(a.nome) as nome,
               upper(trim(a.tipo_agencia)) as tipo_agencia, a.cidade, upper(a.uf) as uf, {region('a.uf')} as regiao,
               try_cast(a.data_abertura as date) as data_abertura,
               coalesce(try_cast(e.meta_comercial_mensal as decimal(14,2)), 500000) as meta_comercial_mensal,
               try_cast(e.latitude as decimal(10,7)) as latitude, try_cast(e.longitude as decimal(10,7)) as longitude,
               true as eh_ativa
        from raw_agencias a left join raw_agencias_expandidas e using (cod_agencia)""",
    "s_colaboradores": """
        select try_cast(cod_colaborador as bigint) as cod_colaborador, primeiro_nome, ultimo_nome, lower(email) as email, cpf,
               try_cast(data_nascimento as date) as data_nascimento, cidade, upper(uf) as uf, regiao, cargo,
               try_cast(nivel_hierarquico as int) as nivel_hierarquico, departamento,
               try_cast(salario_base as decimal(12,2)) as salario_base, try_cast(cod_agencia as bigint) as cod_agencia,
               try_cast(data_admissao as date) as data_admissao, try_cast(nullif(data_demissao, '') as date) as data_demissao,
               lower(eh_ativo) in ('true', '1', 't') as eh_ativo
        from raw_colaboradores_expandidos
        union all
        select try_cast(c.cod_colaborador as bigint), c.primeiro_nome, c.ultimo_nome, lower(c.email), c.cpf,
               try_cast(c.data_nascimento as date), null, null, null, null, null, null, null, null, null, null, true
        from raw_colaboradores c
        where c.cod_colaborador not in (select cod_colaborador from raw_colaboradores_expandidos)""",
    "s_propostas": f"""
        select * from (select {_PROPOSAL.format(amount=number('valor_proposta', signed=False))} from raw_propostas_credito)
        where valor_proposta is not null
        union all
        select {_PROPOSAL.format(amount='try_cast(valor_proposta as decimal(14,2))')} from raw_propostas_sinteticas""",
    "s_ipca": """
        select try_cast(data as date) as data, try_cast(ano as int) as ano, mes, try_cast(mes_num as int) as mes_num,
               try_cast(indice as decimal(10,2)) as indice, try_cast(no_mes as decimal(6,2)) as variacao_mensal,
               try_cast(acumulado_12m as decimal(6,2)) as acumulado_12m, try_cast(acumulado_ano as decimal(6,2)) as acumulado_ano, tipo
        from (select data, ano, mes, mes_num, indice, no_mes, acumulado_12m, acumulado_ano, 'REAL' as tipo from raw_ipca
              where regexp_full_match(data, '\\d{4}-\\d{2}-\\d{2}')
              union all
              select data, ano, mes, mes_num, indice, no_mes, acumulado_12m, acumulado_ano, tipo
              from raw_ipca_projetado where tipo = 'PROJECAO')""",
    "s_selic": """
        select try_cast(data as date) as data, try_cast(taxa_selic as decimal(10,6)) as taxa_selic,
               try_cast(taxa_selic as decimal(18,10)) * 25200 as taxa_selic_aa, tipo
        from (select *, 'REAL' as tipo from raw_selic union all select * from raw_selic_projetada where tipo = 'PROJECAO')""",
    "span": """
        select min(d) as first_day, max(d) as last_day
        from (select o_orderdate::date as d from orders union all select l_shipdate::date from lineitem)""",
    "g_dias": """
        select (d - first_day + 1)::int as sk_tempo, d as data, year(d)::int as ano, month(d)::int as mes,
               monthname(d) as mes_nome, dayofweek(d)::int as dia_semana
        from (select first_day, unnest(generate_series(first_day, last_day, interval 1 day))::date as d from span)""",
    "g_indice": f"""
        select try_cast(ano as int) as ano, try_cast(mes_num as int) as mes,
               max(try_cast(indice as decimal(14,2))) as indice_ipca, max(try_cast(no_mes as decimal(14,2))) as ipca_mes
        from raw_ipca where regexp_full_match(indice, '{SIGNED}') group by 1, 2""",
    "g_feriados": "select data::date as data, min(nome) as nome_feriado from raw_feriados group by 1",
    "g_tempo": f"""
        select c.*, s.taxa_selic, i.taxa_cdi, u.cotacao_dolar, e.cotacao_euro, x.indice_ipca, x.ipca_mes,
               c.dia_semana in (0, 6) as eh_fim_semana, f.data is not null as eh_feriado, f.nome_feriado,
               c.dia_semana not in (0, 6) and f.data is null as eh_dia_util
        from g_dias c
        left join ({_daily('raw_selic', 'taxa_selic', 'taxa_selic')}) s on s.data = c.data
        left join ({_daily('raw_cdi', 'taxa_cdi', 'taxa_cdi')}) i on i.data = c.data
        left join ({_daily('raw_dolar_ptax', 'cotacao_media', 'cotacao_dolar')}) u on u.data = c.data
        left join ({_daily('raw_euro_ptax', 'cotacao_media', 'cotacao_euro')}) e on e.data = c.data
        left join g_indice x on x.ano = c.ano and x.mes = c.mes
        left join g_feriados f on f.data = c.data""",
    "g_municipio": f"""
        select row_number() over (order by m.codigo_ibge::int) as sk_municipio, m.codigo_ibge::int as codigo_ibge,
               m.municipio, m.uf, {region('m.uf')} as regiao, p.populacao, p.ano as ano_populacao, g.pib_total, g.pib_per_capita, g.ano as ano_pib
        from raw_municipios m
        left join (select codigo_ibge, populacao::int as populacao, ano::int as ano from raw_populacao
                   qualify ano = max(ano) over (partition by codigo_ibge)) p on p.codigo_ibge = m.codigo_ibge
        left join (select codigo_ibge, pib_total::bigint as pib_total, pib_per_capita::decimal(14,2) as pib_per_capita, ano::int as ano
                   from raw_pib_municipal qualify ano = max(ano) over (partition by codigo_ibge)) g on g.codigo_ibge = m.codigo_ibge""",
    "g_ligacao": "select upper(trim(municipio)) as c, upper(trim(uf)) as u, min(sk_municipio) as sk_municipio from g_municipio group by 1, 2",
    "g_agencia": """
        select row_number() over (order by cod_agencia) as sk_agencia, a.*, l.sk_municipio
        from s_agencias a left join g_ligacao l on l.c = upper(trim(a.cidade)) and l.u = upper(trim(a.uf))""",
    "g_cliente": """
        select row_number() over (order by cod_cliente) as sk_cliente, k.*, l.sk_municipio
        from (select * from (
                select cod_cliente, primeiro_nome, ultimo_nome, email, tipo_pessoa, data_inclusao, cpf_formatado, data_nascimento,
                       idade, faixa_etaria, cep_digits, null as cidade, null as uf, null as renda_mensal, null as score_credito, 0 as carga
                from s_clientes
                union all
                select cod_cliente, primeiro_nome, ultimo_nome, email, tipo_pessoa, data_inclusao, cpf_formatado, data_nascimento,
                       idade, faixa_etaria, cep_digits, cidade, uf, renda_mensal, score_credito, 1 from s_sinteticos)
              qualify row_number() over (partition by cod_cliente order by data_inclusao desc nulls last, carga desc) = 1) k
        left join g_ligacao l on l.c = upper(trim(k.cidade)) and l.u = upper(trim(k.uf))""",
    "g_colaborador": """
        select row_number() over (order by c.cod_colaborador) as sk_colaborador, c.*, a.sk_agencia as sk_agencia_principal
        from s_colaboradores c left join g_agencia a on a.cod_agencia = c.cod_agencia""",
    "g_canal": f"""
        select row_number() over (order by canal) as sk_canal, canal as nome_canal,
               {family('canal', CHANNEL_FAMILIES, 'Digital')} as tipo_canal
        from (select distinct canal from s_transacoes)""",
    "f_transacoes": """
        select t.sk_tempo, k.sk_cliente, a.sk_agencia, n.sk_canal, x.cod_transacao, x.num_conta, x.nome_transacao,
               x.valor_transacao, x.valor_absoluto, x.flag_credito
        from s_transacoes x
        join g_dias t on t.data = x.data_transacao::date
        join s_contas c on c.num_conta = x.num_conta
        join g_cliente k on k.cod_cliente = c.cod_cliente
        join g_agencia a on a.cod_agencia = c.cod_agencia
        left join g_canal n on n.nome_canal = x.canal""",
    "f_contas": f"""
        select t.sk_tempo, k.sk_cliente, a.sk_agencia, o.sk_colaborador, c.num_conta, c.saldo_total, c.saldo_disponivel,
               c.eh_conta_ativa as computed_flag
        from s_contas c
        join g_dias t on t.data = coalesce(c.data_ultimo_lancamento, {LAST_DAY})
        join g_cliente k on k.cod_cliente = c.cod_cliente
        join g_agencia a on a.cod_agencia = c.cod_agencia
        left join g_colaborador o on o.cod_colaborador = c.cod_colaborador""",
    "f_propostas": """
        select t.sk_tempo as sk_tempo_entrada, k.sk_cliente, o.sk_colaborador, p.cod_proposta::bigint as cod_proposta, p.status_proposta,
               try_cast(p.valor_proposta as decimal(14,2)) as valor_proposta,
               try_cast(p.valor_financiamento as decimal(14,2)) as valor_financiamento,
               try_cast(p.taxa_juros_mensal as decimal(8,6)) as taxa_juros_mensal
        from raw_propostas_credito p
        join g_dias t on t.data = p.data_entrada_proposta::date
        join g_cliente k on k.cod_cliente = p.cod_cliente::int
        left join g_colaborador o on o.cod_colaborador = p.cod_colaborador::int""",
}


def sql(final: str) -> str:
    """The query with the building blocks it refers to, directly or not."""
    needed: set[str] = set()
    queue = [final]
    while queue:
        text = queue.pop()
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                queue.append(BLOCKS[name])
    parts = [f"{name} as ({BLOCKS[name].strip()})" for name in BLOCKS if name in needed]
    body = final.strip()
    if body.startswith("with"):
        body = f"select * from ({body})"
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
