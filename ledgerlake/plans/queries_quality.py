"""Audit rules, scorecard, column checks, expectations and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerlake.functions import text as t
from ledgerlake.operators import marts, quality
from ledgerlake.operators.quality import ColumnCheck, Expectation, RowRule
from ledgerlake.plans.catalog import query
from ledgerlake.plans.oracle import age

_FIVE = "(select string_agg(v, ' | ' order by v) from (select {0} as v from {1} where {2} order by 1 limit 5))"
_BAD_CPF = "not regexp_full_match(cpfcnpj, '\\d{3}\\.\\d{3}\\.\\d{3}-\\d{2}')"
_AGE = age("try_cast(data_nascimento as date)")
_TOO_MUCH = "try_cast(saldo_disponivel as decimal(38,10)) > try_cast(saldo_total as decimal(38,10)) + 0.01"


def _rule(table: str, field: str, text: str, severity: str, count: str, sample: str = "null::varchar") -> str:
    return (f"select '{table}' as tabela, '{field}' as campo, '{text}' as regra, '{severity}' as severidade, "
            f"({count})::bigint as qtd_registros, {sample} as amostra, 'ABERTO' as status")


def _orphans(child: str, key: str, parent: str, what: str = "count(*)") -> str:
    return f"select {what} from raw_{child} c where not exists (select 1 from raw_{parent} p where p.{key} = c.{key})"


_LOG = "\nunion all\n".join([
    _rule("clientes", "cpfcnpj", "Formato CPF inválido", "ERROR", f"select count(*) from raw_clientes where {_BAD_CPF}",
          _FIVE.format("cpfcnpj", "raw_clientes", _BAD_CPF)),
    _rule("clientes", "cpfcnpj", "CPF duplicado", "ERROR", "select count(cpfcnpj) - count(distinct cpfcnpj) from raw_clientes",
          _FIVE.format("cpfcnpj", "(select cpfcnpj, count(*) as n from raw_clientes where cpfcnpj is not null group by 1)", "n > 1")),
    _rule("clientes", "email", "Email duplicado", "WARNING", "select count(email) - count(distinct lower(email)) from raw_clientes"),
    _rule("clientes", "data_nascimento", "Idade fora do range 18-120 anos", "ERROR",
          f"select count(*) from raw_clientes where {_AGE} < 18 or {_AGE} > 120"),
    _rule("clientes", "email", "Email nulo", "WARNING", "select count(*) from raw_clientes where email is null or email = ''"),
    _rule("contas", "cod_cliente", "Conta sem cliente", "ERROR", _orphans("contas", "cod_cliente", "clientes")),
    _rule("contas", "cod_agencia", "Conta sem agência", "ERROR", _orphans("contas", "cod_agencia", "agencias")),
    _rule("contas", "saldo_disponivel", "Saldo disponível maior que saldo total", "ERROR",
          f"select count(*) from raw_contas where {_TOO_MUCH}", _FIVE.format("num_conta", "raw_contas", _TOO_MUCH)),
    _rule("contas", "data_abertura", "Data de abertura no futuro", "ERROR",
          "select count(*) from raw_contas where data_abertura::date > date '1997-01-01'"),
    _rule("transacoes", "valor_transacao", "Valor de transação zero", "ERROR",
          "select count(*) from raw_transacoes where try_cast(valor_transacao as decimal(38,10)) = 0"),
    _rule("transacoes", "num_conta", "Transação sem conta", "ERROR",
          _orphans("transacoes", "num_conta", "contas", "count(distinct num_conta)")),
    _rule("transacoes", "data_transacao", "Transação anterior à abertura da conta", "ERROR",
          "select count(*) from raw_transacoes x join raw_contas c using (num_conta) "
          "where x.data_transacao::timestamp::date < c.data_abertura::date"),
    _rule("transacoes", "valor_transacao", "Valor acima de 1.000.000", "WARNING",
          "select count(*) from raw_transacoes where abs(try_cast(valor_transacao as decimal(38,10))) > 1000000"),
    _rule("propostas_credito", "taxa_juros_mensal", "Taxa fora do range 0%-30%", "ERROR",
          "select count(*) from raw_propostas_credito where taxa_juros_mensal::decimal(14,6) not between 0 and 0.30"),
    _rule("propostas_credito", "valor_entrada", "Entrada não menor que a proposta", "ERROR",
          "select count(*) from raw_propostas_credito where try_cast(valor_entrada as decimal(38,10)) >= try_cast(valor_proposta as decimal(38,10))"),
    _rule("propostas_credito", "cod_cliente", "Proposta sem cliente", "ERROR", _orphans("propostas_credito", "cod_cliente", "clientes")),
    _rule("ipca", "data", "Mês faltando na série", "ERROR",
          "select count(*) from (select unnest(generate_series(date '2010-01-01', date '2025-12-01', interval 1 month))::date as m) "
          "where m not in (select data::date from raw_ipca)"),
    _rule("selic", "data", "Intervalo maior que 5 dias na série", "WARNING",
          "select count(*) from (select d - lag(d) over (order by d) as gap from (select distinct data::date as d from raw_selic)) where gap > 5"),
])

_AUDIT_DAY = dt.date(1997, 1, 1)


def _bank_rules():
    """The standard rules; ages are taken at the reference day, openings at a day inside the data."""
    rules = []
    for rule in quality.bank_rules():
        if rule.field == "data_abertura":
            rule = RowRule(rule.table, rule.field, rule.text, rule.severity,
                           t.to_day("data_abertura") > F.lit(_AUDIT_DAY))
        rules.append(rule)
    return rules


@query("audit_log", _LOG)
def audit_log(bank):
    return quality.audit(bank.raw, _bank_rules())


@query("audit_scorecard", f"""
    select tabela, severidade, count(*) filter (where qtd_registros > 0) as qtd_regras_violadas,
           sum(qtd_registros)::bigint as total_registros_afetados, sum(qtd_registros)::bigint as registros_em_aberto,
           case severidade when 'ERROR' then 1 when 'WARNING' then 2 else 3 end as ordem
    from ({_LOG}) group by 1, 2""")
def audit_scorecard(bank):
    return quality.scorecard(quality.audit(bank.raw, _bank_rules())).withColumn(
        "ordem", quality.severity_rank("severidade")
    )


@query("repeated_line_items", """
    select count(*) - count(distinct (l_orderkey, l_linenumber)) as repetidas from lineitem""")
def repeated_line_items(bank):
    groups = bank.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("c"))
    return groups.agg(F.sum(F.col("c") - 1).alias("repetidas"))


@query("shipped_before_order", """
    select count(*) as qtd from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate""")
def shipped_before_order(bank):
    rule = quality.BeforeParentRule("itens", "l_shipdate", "Embarque antes do pedido", "ERROR", "k", "pedidos", "o_orderdate")
    items = bank.table("lineitem").withColumnRenamed("l_orderkey", "k")
    orders = bank.table("orders").withColumnRenamed("o_orderkey", "k")
    return quality.audit({"itens": items, "pedidos": orders}, [rule]).select(F.col("qtd_registros").alias("qtd"))


@query("missing_series_months", """
    select m::varchar as mes from (select unnest(generate_series(date '1994-06-01', date '2002-03-01', interval 1 month))::date as m)
    where m not in (select date_trunc('month', o_orderdate)::date from orders)""")
def missing_series_months(bank):
    return quality.missing_months(
        bank.table("orders"), "o_orderdate", F.lit(dt.date(1994, 6, 1)), F.lit(dt.date(2002, 3, 1))
    )


@query("series_day_gaps", """
    select de::varchar as de, ate::varchar as ate, (ate - de)::int as dias
    from (select lag(d) over (order by d) as de, d as ate from (select distinct o_orderdate::date as d from orders))
    where ate - de > 1""")
def series_day_gaps(bank):
    return quality.day_gaps(bank.table("orders"), "o_orderdate", 1)


_CHANNELS = ("Pix", "TED", "DOC", "Compra Credito", "Compra Debito", "Saque", "Pagamento Boleto", "Outros")
_CHECKS = [
    ColumnCheck("clientes", "cod_cliente", "not_null"),
    ColumnCheck("clientes", "cod_cliente", "unique"),
    ColumnCheck("clientes", "data_nascimento", "not_null"),
    ColumnCheck("clientes", "faixa_etaria", "accepted_values", ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")),
    ColumnCheck("contas", "num_conta", "unique"),
    ColumnCheck("contas", "cod_cliente", "relationships", to="clientes"),
    ColumnCheck("transacoes", "cod_transacao", "not_null"),
    ColumnCheck("transacoes", "cod_transacao", "unique"),
    ColumnCheck("transacoes", "canal", "accepted_values", _CHANNELS),
    ColumnCheck("transacoes", "num_conta", "relationships", to="contas"),
    ColumnCheck("propostas", "status_proposta", "accepted_values", ("Aprovada", "Reprovada", "Enviada")),
]


def _check(table: str, column: str, test: str, count: str) -> str:
    return f"select '{table}' as tabela, '{column}' as coluna, '{test}' as teste, ({count})::bigint as falhas"


@query("column_checks", "\nunion all\n".join([
    _check("clientes", "cod_cliente", "not_null", "select count(*) from s_clientes where cod_cliente is null"),
    _check("clientes", "cod_cliente", "unique", "select count(*) from (select 1 from s_clientes group by cod_cliente having count(*) > 1)"),
    _check("clientes", "data_nascimento", "not_null", "select count(*) from s_clientes where data_nascimento is null"),
    _check("clientes", "faixa_etaria", "accepted_values", "select count(*) from s_clientes where faixa_etaria = 'Menor'"),
    _check("contas", "num_conta", "unique", "select count(*) from (select 1 from s_contas group by num_conta having count(*) > 1)"),
    _check("contas", "cod_cliente", "relationships", "select count(*) from s_contas where cod_cliente not in (select cod_cliente from s_clientes)"),
    _check("transacoes", "cod_transacao", "not_null", "select count(*) from s_transacoes where cod_transacao is null"),
    _check("transacoes", "cod_transacao", "unique", "select count(*) from (select 1 from s_transacoes group by cod_transacao having count(*) > 1)"),
    _check("transacoes", "canal", "accepted_values", "select count(*) from s_transacoes where canal = 'Deposito Especie'"),
    _check("transacoes", "num_conta", "relationships", "select count(*) from s_transacoes where num_conta not in (select num_conta from s_contas)"),
    _check("propostas", "status_proposta", "accepted_values", "select count(*) from s_propostas where status_proposta = 'Em Análise'"),
]))
def column_checks(bank):
    return quality.column_checks(bank.silver, _CHECKS)


@query("expectations", """
    select 'conta informada' as expectativa, true as fatal, count(*) filter (where num_conta is null) as falhas, count(*) as linhas from s_contas
    union all
    select 'saldo nao negativo', false, count(*) filter (where not coalesce(saldo_total >= 0, false)), count(*) from s_contas
    union all
    select 'lancamento informado', false, count(*) filter (where data_ultimo_lancamento is null), count(*) from s_contas""")
def expectations(bank):
    rules = [
        Expectation("conta informada", "num_conta IS NOT NULL", fatal=True),
        Expectation("saldo nao negativo", "saldo_total >= 0"),
        Expectation("lancamento informado", "data_ultimo_lancamento IS NOT NULL"),
    ]
    return quality.expectation_report(bank.silver["contas"], rules)


@query("marts_reconciled", """
    select * from (
      select 'kpi2_3' as kpi, 'volume_total' as campo, sum(valor_absoluto)::double as obtido, 'APROVADO' as situacao from f_transacoes
      union all select 'kpi4', 'qtd_propostas', count(*)::double, 'APROVADO' from f_propostas
      union all select 'kpi5', 'qtd_agencias', count(distinct sk_agencia)::double, 'APROVADO' from f_contas where computed_flag
      union all select 'kpi7', 'qtd_clientes', count(*)::double, 'APROVADO' from g_cliente)""")
def marts_reconciled(bank):
    """Totals of the marts against the same totals taken straight from the facts and dimensions."""
    gold = bank.gold
    actual = [
        quality.totals(bank.mart("kpi2_3"), "kpi2_3", {"volume_total": F.sum("volume_total")}),
        quality.totals(bank.mart("kpi4"), "kpi4", {"qtd_propostas": F.sum("qtd_propostas")}),
        quality.totals(bank.mart("kpi5"), "kpi5", {"qtd_agencias": F.count("*")}),
        quality.totals(bank.mart("kpi7"), "kpi7", {"qtd_clientes": F.sum("qtd_clientes")}),
    ]
    expected = [
        quality.totals(gold["fato_transacoes"], "kpi2_3", {"volume_total": marts.money("valor_absoluto")}),
        quality.totals(gold["fato_propostas_credito"], "kpi4", {"qtd_propostas": F.count("*")}),
        quality.totals(gold["fato_contas"].where("eh_conta_ativa"), "kpi5", {"qtd_agencias": F.count_distinct("sk_agencia")}),
        quality.totals(gold["dim_cliente"], "kpi7", {"qtd_clientes": F.count("*")}),
    ]

    def stacked(parts):
        first = parts[0]
        for part in parts[1:]:
            first = first.unionByName(part)
        return first

    return quality.reconcile(stacked(actual), stacked(expected)).select("kpi", "campo", "obtido", "situacao")
