"""Fact tables: measures plus the surrogate keys of their dimensions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import dates
from ledgerlake.functions import finance
from ledgerlake.functions import text as t
from ledgerlake.functions.rules import arrears_bucket, risk_grade
from ledgerlake.operators.keys import PART_ROWS, current_rows, lookup


@dataclass(frozen=True)
class Lookup:
    """A dimension's surrogate key, found by natural key.

    `natural` and `surrogate` are columns of the dimension; `fact_key` is the
    fact column (or expression) to match and `name` the key's name in the fact.
    Dimensions are stored tables, so the optimizer knows their size and broadcasts
    a calendar or a list of channels by itself.
    """

    dim: DataFrame
    natural: str
    surrogate: str
    fact_key: str | Column
    how: str = "inner"
    name: str | None = None
    part_rows: int | None = None


def build_fact(source: DataFrame, lookups: list[Lookup], measures: list[str | Column]) -> DataFrame:
    """Resolve every lookup, then keep the surrogate keys and the measures."""
    fact, keys = source, []
    for i, look in enumerate(lookups):
        name, probe = look.name or look.surrogate, f"_probe{i}"
        expression = F.col(look.fact_key) if isinstance(look.fact_key, str) else look.fact_key
        side = look.dim.select(F.col(look.natural).alias(probe), F.col(look.surrogate).alias(name))
        fact = lookup(fact.withColumn(probe, expression), side, probe, look.how, look.part_rows)
        keys.append(name)
    return fact.select(*keys, *measures)


def resolve_accounts(accounts: DataFrame, clients: DataFrame, branches: DataFrame) -> DataFrame:
    """Account -> client and branch keys.

    Resolved once on the account table, so that the transaction table is joined
    (and shuffled) once instead of three times.
    """
    return build_fact(
        accounts,
        [
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(branches, "cod_agencia", "sk_agencia", "cod_agencia"),
        ],
        ["num_conta"],
    )


def place_transactions(
    transactions: DataFrame,
    cal: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    branches: DataFrame,
    channels: DataFrame,
    keep_unmatched: bool = False,
    part_rows: int | None = PART_ROWS,
) -> DataFrame:
    """Transactions with the keys of their dimensions, without the measures that are computed from others.

    `keep_unmatched` gives the variant whose lookups are all left joins. Day and channel become keys first, so that the
    one shuffle, by account, moves neither instants nor names of channels.
    """
    how = "left" if keep_unmatched else "inner"
    placed = build_fact(
        transactions,
        [
            Lookup(cal, "data", "sk_tempo", F.col("data_transacao").cast("date"), how),
            Lookup(channels, "nome_canal", "sk_canal", "canal", "left"),
        ],
        ["cod_transacao", "num_conta", "nome_transacao", "valor_transacao", "flag_credito"],
    )
    owned = lookup(placed, resolve_accounts(accounts, clients, branches), "num_conta", how, part_rows)
    return owned.select(
        "sk_tempo",
        "sk_canal",
        "sk_cliente",
        "sk_agencia",
        "cod_transacao",
        "num_conta",
        "nome_transacao",
        "valor_transacao",
        "flag_credito",
    )


def transaction_measures(placed: DataFrame) -> DataFrame:
    """The same rows with their absolute amount beside the signed one."""
    at = placed.columns.index("valor_transacao") + 1
    return placed.select(*placed.columns[:at], F.abs("valor_transacao").alias("valor_absoluto"), *placed.columns[at:])


def fact_transactions(
    transactions: DataFrame,
    cal: DataFrame,
    accounts: DataFrame,
    clients: DataFrame,
    branches: DataFrame,
    channels: DataFrame,
    keep_unmatched: bool = False,
    part_rows: int | None = PART_ROWS,
) -> DataFrame:
    return transaction_measures(
        place_transactions(transactions, cal, accounts, clients, branches, channels, keep_unmatched, part_rows)
    )


def fact_accounts(
    accounts: DataFrame,
    cal: DataFrame,
    clients: DataFrame,
    branches: DataFrame,
    staff: DataFrame,
    as_of: dt.date = dates.REFERENCE_DAY,
    all_active: bool = True,
) -> DataFrame:
    """One row per account. `all_active` marks every account active; else the computed flag stays."""
    last_day = F.coalesce(F.col("data_ultimo_lancamento"), dates.day(as_of))
    active = F.lit(True) if all_active else F.col("eh_conta_ativa")
    return build_fact(
        accounts,
        [
            Lookup(cal, "data", "sk_tempo", last_day),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(branches, "cod_agencia", "sk_agencia", "cod_agencia"),
            Lookup(staff, "cod_colaborador", "sk_colaborador", "cod_colaborador", "left"),
        ],
        ["num_conta", "saldo_total", "saldo_disponivel", active.alias("eh_conta_ativa")],
    )


def fact_proposals(raw: DataFrame, cal: DataFrame, clients: DataFrame, staff: DataFrame) -> DataFrame:
    """Built from the original raw proposals, to keep their grain."""
    source = raw.where("cod_proposta IS NOT NULL AND data_entrada_proposta IS NOT NULL")
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", t.to_day("data_entrada_proposta"), name="sk_tempo_entrada"),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", t.to_whole("cod_cliente")),
            Lookup(staff, "cod_colaborador", "sk_colaborador", t.to_whole("cod_colaborador"), "left"),
        ],
        [
            t.to_whole("cod_proposta", "bigint").alias("cod_proposta"),
            "status_proposta",
            t.to_decimal("valor_proposta").alias("valor_proposta"),
            t.to_decimal("valor_financiamento").alias("valor_financiamento"),
            t.to_decimal("valor_entrada").alias("valor_entrada"),
            t.to_decimal("valor_prestacao").alias("valor_prestacao"),
            t.to_whole("quantidade_parcelas", "smallint").alias("quantidade_parcelas"),
            t.to_decimal("taxa_juros_mensal", 8, 6).alias("taxa_juros_mensal"),
        ],
    )


def fact_investments(
    source: DataFrame, cal: DataFrame, clients: DataFrame, products: DataFrame, as_of: dt.date | Column
) -> DataFrame:
    """Positions with their value today and whether they have matured."""
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", "data_aplicacao"),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(products, "cod_produto", "sk_produto", "cod_produto"),
        ],
        [
            "id_investimento",
            "data_aplicacao",
            "data_vencimento",
            "valor_aplicado",
            finance.current_value("valor_aplicado", "rentabilidade").alias("valor_atual"),
            finance.maturity_status("data_vencimento", as_of).alias("status"),
        ],
    )


def fact_cards(source: DataFrame, cal: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", "mes_referencia"),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(products, "cod_produto", "sk_produto", "cod_produto"),
        ],
        [
            "id_fatura",
            "limite_total",
            "gasto_mes",
            finance.available_limit("limite_total", "gasto_mes").alias("limite_disponivel"),
            finance.utilisation_pct("gasto_mes", "limite_total").alias("pct_utilizacao"),
        ],
    )


def fact_insurance(source: DataFrame, cal: DataFrame, clients: DataFrame, products: DataFrame) -> DataFrame:
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", "data_inicio"),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(products, "cod_produto", "sk_produto", "cod_produto"),
        ],
        ["num_apolice", "data_inicio", "data_fim", "valor_segurado", "premio_mensal", "status_apolice"],
    )


def fact_arrears(source: DataFrame, cal: DataFrame, clients: DataFrame) -> DataFrame:
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", "data_referencia"),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
        ],
        [
            "cod_contrato",
            "valor_aberto",
            "dias_atraso",
            arrears_bucket("dias_atraso").alias("bucket"),
            risk_grade("dias_atraso").alias("faixa_risco"),
        ],
    )


def fact_frauds(source: DataFrame, cal: DataFrame, clients: DataFrame, channels: DataFrame) -> DataFrame:
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", F.col("data_ocorrencia").cast("date")),
            Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
            Lookup(channels, "nome_canal", "sk_canal", "canal", "left"),
        ],
        [
            "id_fraude",
            F.date_format("data_ocorrencia", "HH:mm:ss").alias("hora_ocorrencia"),
            "valor_fraude",
            "flag_confirmada",
            "valor_recuperado",
        ],
    )


def fact_revenue(source: DataFrame, cal: DataFrame, branches: DataFrame, products: DataFrame) -> DataFrame:
    return build_fact(
        source,
        [
            Lookup(cal, "data", "sk_tempo", "data"),
            Lookup(branches, "cod_agencia", "sk_agencia", "cod_agencia"),
            Lookup(products, "cod_produto", "sk_produto", "cod_produto", "left"),
        ],
        [
            "tipo_receita",
            "valor_receita",
            "valor_custo",
            finance.margin("valor_receita", "valor_custo").alias("margem"),
        ],
    )


# Of each product source, the day it counts for, and whether it has a product, a branch and a channel.
PRODUCT_FACTS = {
    "investimentos": ("data_aplicacao", True, True, False),
    "cartoes": ("mes_referencia", True, True, False),
    "seguros": ("data_inicio", True, True, False),
    "inadimplencia": ("data_referencia", False, False, False),
    "fraudes": ("data_ocorrencia", False, True, True),
}


def product_fact(
    source: DataFrame,
    table: str,
    cal: DataFrame,
    clients: DataFrame,
    branches: DataFrame | None,
    products: DataFrame | None,
    channels: DataFrame | None,
) -> DataFrame:
    """A cleaned product source as a fact: its keys resolved, all its other columns as they are.

    Calendar, client and product must be known; branch and channel may be missing. A dimension that the table has no
    key of may be None.
    """
    day, has_product, has_branch, has_channel = PRODUCT_FACTS[table]
    lookups = [
        Lookup(cal, "data", "sk_tempo", day),
        Lookup(current_rows(clients), "cod_cliente", "sk_cliente", "cod_cliente"),
    ]
    taken = {"cod_cliente", "nome_produto"}
    if has_product:
        lookups.append(Lookup(products, "cod_produto", "sk_produto", "cod_produto"))
        taken.add("cod_produto")
    if has_branch:
        lookups.append(Lookup(branches, "cod_agencia", "sk_agencia", "cod_agencia", "left"))
        taken.add("cod_agencia")
    if has_channel:
        lookups.append(Lookup(channels, "nome_canal", "sk_canal", "canal", "left"))
        taken.add("canal")
    return build_fact(source, lookups, [c for c in source.columns if c not in taken])
