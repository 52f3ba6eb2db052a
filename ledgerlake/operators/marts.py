"""Business marts: balances, volumes, conversion, rankings, portfolios and segments.

Facts are aggregated on their own keys before any dimension is joined, so that a
key holding a third of the rows is reduced map-side and the joins see one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import finance
from ledgerlake.functions.dates import month_label
from ledgerlake.operators.keys import current_rows

# The status that counts as approved, and the labels of a branch.
APPROVED = "Aprovada"
BRANCH_LABELS = ("cod_agencia", "nome", "tipo_agencia", "cidade", "uf")


def money(amount: Column | str) -> Column:
    """A total of amounts, exact at any row count."""
    return F.sum(F.col(amount) if isinstance(amount, str) else amount).cast("decimal(38,2)")


def mean(total: Column | str, n: Column | str) -> Column:
    """Average amount to the cent; NULL over no rows."""
    total = F.col(total) if isinstance(total, str) else total
    n = F.col(n) if isinstance(n, str) else n
    return F.round(total.cast("decimal(24,2)") / F.nullif(n, F.lit(0)).cast("decimal(14,0)"), 2)


# ------------------------------------------------------------------ balances


def balance_by_branch(
    accounts: DataFrame,
    branches: DataFrame,
    key: str = "sk_agencia",
    labels: Sequence[str] = BRANCH_LABELS,
) -> DataFrame:
    """Accounts, total, available and average balance of each branch, active accounts only."""
    per_branch = (
        accounts.where("eh_conta_ativa")
        .groupBy(key)
        .agg(
            F.count_distinct("num_conta").alias("qtd_contas"),
            money("saldo_total").alias("saldo_total"),
            money("saldo_disponivel").alias("saldo_disponivel"),
            F.count("saldo_total").alias("_n"),
        )
    )
    return per_branch.join(branches.select(key, *labels), key).select(
        *labels,
        "qtd_contas",
        "saldo_total",
        "saldo_disponivel",
        mean("saldo_total", "_n").alias("saldo_medio"),
    )


def volume_by(transactions: DataFrame, keys: Sequence[str], name: str = "volume_total") -> DataFrame:
    return transactions.groupBy(*keys).agg(
        F.count("*").alias("qtd_transacoes"), money(F.abs("valor_transacao")).alias(name)
    )


def branch_ranking(
    balances: DataFrame, volumes: DataFrame, key: str = "cod_agencia", ties: bool = False
) -> DataFrame:
    """Rank branches by balance, then volume, then code. `ties` gives equal balances one rank.

    The window runs over one row per branch, not over the facts.
    """
    both = balances.join(volumes.select(key, "volume_total"), key, "left").withColumn(
        "volume_total", F.coalesce("volume_total", F.lit(0).cast("decimal(38,2)"))
    )
    if ties:
        rank = F.rank().over(Window.orderBy(F.desc("saldo_total")))
    else:
        rank = F.row_number().over(
            Window.orderBy(F.desc("saldo_total"), F.desc("volume_total"), F.asc(key))
        )
    return both.withColumn("ranking", rank)


# ------------------------------------------------------------------ volumes


def daily_volume(transactions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Count and volume per calendar day and key: what the monthly marts join to the calendar.

    The fact is reduced map-side here, so the calendar meets one row per day and
    key and the fact itself is never shuffled for a join.
    """
    return volume_by(transactions, ["sk_tempo", *keys])


def mix_by_month(
    transactions: DataFrame, cal: DataFrame, kind: str = "nome_transacao", weight: str = "count"
) -> DataFrame:
    """Count, volume and share of each transaction type within its month.

    `weight` says whether the share is of the count or of the value.
    """
    monthly = (
        daily_volume(transactions, [kind])
        .join(cal.select("sk_tempo", "ano", "mes", "mes_nome"), "sk_tempo")
        .groupBy("ano", "mes", "mes_nome", kind)
        .agg(F.sum("qtd_transacoes").alias("qtd_transacoes"), money("volume_total").alias("volume_total"))
    )
    part = "qtd_transacoes" if weight == "count" else "volume_total"
    # The window sees one row per month and type.
    whole = F.sum(part).over(Window.partitionBy("ano", "mes"))
    return monthly.withColumn("pct_mix", finance.share_pct(part, whole))


def with_month_label(df: DataFrame, name: str = "ano_mes") -> DataFrame:
    return df.withColumn(name, month_label(F.make_date("ano", "mes", F.lit(1))))


def deflated_volume(transactions: DataFrame, cal: DataFrame, index: str = "indice_ipca") -> DataFrame:
    """Monthly volume at the prices of the last month that has an index.

    Months without an index are left out; a zero index gives NULL.
    """
    priced = cal.where(F.col(index).isNotNull())
    base = priced.agg(F.max_by(index, "data")).scalar()
    monthly = (
        daily_volume(transactions)
        .join(priced.select("sk_tempo", "ano", "mes", "mes_nome", index), "sk_tempo")
        .groupBy("ano", "mes", "mes_nome", F.col(index).alias("indice_mes"))
        .agg(money("volume_total").alias("volume_nominal"))
        .withColumn("indice_base", base)
    )
    month_index = F.nullif("indice_mes", F.lit(0).cast("decimal(10,2)"))
    return monthly.withColumns(
        {
            "volume_real": F.round(
                F.col("volume_nominal").cast("decimal(20,2)") * F.col("indice_base") / month_index, 2
            ),
            "fator_correcao": F.round(F.col("indice_base") / month_index, 6),
        }
    )


# ------------------------------------------------------------------ proposals


def share_by_status(proposals: DataFrame, status: str = "status_proposta") -> DataFrame:
    """Count, amounts, mean rate and share of each status."""
    grouped = proposals.groupBy(status).agg(
        F.count("*").alias("qtd_propostas"),
        money("valor_proposta").alias("valor_total_proposto"),
        money("valor_financiamento").alias("valor_total_financiado"),
        F.count("valor_proposta").alias("_n"),
        F.sum("taxa_juros_mensal").alias("_rate"),
        F.count("taxa_juros_mensal").alias("_rates"),
    )
    whole = grouped.agg(F.sum("qtd_propostas")).scalar()
    rate = F.col("_rate").cast("decimal(24,6)") * 100 / F.nullif("_rates", F.lit(0)).cast("decimal(10,0)")
    return grouped.select(
        status,
        "qtd_propostas",
        "valor_total_proposto",
        "valor_total_financiado",
        mean("valor_total_proposto", "_n").alias("valor_medio"),
        F.round(rate, 4).alias("taxa_media_pct"),
        finance.share_pct("qtd_propostas", whole).alias("pct_status"),
    )


def staff_portfolio(
    staff: DataFrame, branches: DataFrame, accounts: DataFrame, proposals: DataFrame
) -> DataFrame:
    """Accounts, balance and proposals managed by each active member of staff."""
    held = (
        accounts.where("eh_conta_ativa")
        .groupBy("sk_colaborador")
        .agg(
            F.count_distinct("num_conta").alias("qtd_contas_geridas"),
            money("saldo_total").alias("saldo_gerido"),
        )
    )
    # One row per proposal first: then both distinct counts are plain sums.
    offered = (
        proposals.groupBy("sk_colaborador", "cod_proposta")
        .agg(F.max((F.col("status_proposta") == APPROVED).cast("int")).alias("_ok"))
        .groupBy("sk_colaborador")
        .agg(F.count("*").alias("qtd_propostas"), F.sum("_ok").alias("propostas_aprovadas"))
    )
    home = branches.select(F.col("sk_agencia").alias("sk_agencia_principal"), F.col("nome").alias("agencia"))
    return (
        staff.where("eh_ativo")
        .join(home, "sk_agencia_principal", "left")
        .join(held, "sk_colaborador", "left")
        .join(offered, "sk_colaborador", "left")
        .select(
            "cod_colaborador",
            finance.full_name("primeiro_nome", "ultimo_nome").alias("nome_completo"),
            "cargo",
            "agencia",
            F.coalesce("qtd_contas_geridas", F.lit(0)).alias("qtd_contas_geridas"),
            F.coalesce("saldo_gerido", F.lit(0).cast("decimal(38,2)")).alias("saldo_gerido"),
            F.coalesce("qtd_propostas", F.lit(0)).alias("qtd_propostas"),
            F.coalesce("propostas_aprovadas", F.lit(0)).alias("propostas_aprovadas"),
        )
    )


# ------------------------------------------------------------------ clients


def client_segments(clients: DataFrame, accounts: DataFrame, band: str = "faixa_etaria") -> DataFrame:
    """Clients, balances and mean score of each age band; clients without accounts count too."""
    held = (
        accounts.where("eh_conta_ativa")
        .groupBy("sk_cliente")
        .agg(
            money("saldo_total").alias("_total"),
            F.count("saldo_total").alias("_n"),
            F.count_distinct("num_conta").alias("_contas"),
            F.count("*").alias("_rows"),
        )
    )
    # A client's score weighs once per account row, and once without any.
    weight = F.greatest(F.coalesce("_rows", F.lit(0)), F.lit(1))
    return (
        current_rows(clients)
        .join(held, "sk_cliente", "left")
        .groupBy(band)
        .agg(
            # The join leaves one row per client, so rows are clients.
            F.count("*").alias("qtd_clientes"),
            F.sum("_total").cast("decimal(38,2)").alias("saldo_total"),
            F.sum("_n").alias("_n"),
            F.coalesce(F.sum("_contas"), F.lit(0)).alias("qtd_contas"),
            F.sum(F.col("score_credito") * weight).alias("_score"),
            F.sum(F.when(F.col("score_credito").isNotNull(), weight)).alias("_scored"),
        )
        .select(
            band,
            "qtd_clientes",
            mean("saldo_total", "_n").alias("saldo_medio"),
            "saldo_total",
            mean("_score", "_scored").alias("score_medio"),
            "qtd_contas",
        )
    )


def band_order(band: Column | str, labels: Sequence[str]) -> Column:
    """Sort position of a band label; labels not listed come last."""
    band = F.col(band) if isinstance(band, str) else band
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), band)
    return F.when(position > 0, position).otherwise(len(labels) + 1)


def clients_by_municipality(
    municipalities: DataFrame, clients: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Clients, share of the population, volume and mean ticket of every municipality."""
    spent = transactions.groupBy("sk_cliente").agg(
        money("valor_transacao").alias("_total"), F.count("valor_transacao").alias("_n")
    )
    per_place = (
        clients.where("sk_municipio IS NOT NULL")
        .select("sk_cliente", "sk_municipio")
        .join(spent, "sk_cliente", "left")
        .groupBy("sk_municipio")
        .agg(
            F.count("*").alias("qtd_clientes"),
            F.sum("_total").cast("decimal(38,2)").alias("volume_transacoes"),
            F.sum("_n").alias("_n"),
        )
    )
    people = F.nullif("populacao", F.lit(0))
    return municipalities.join(per_place, "sk_municipio", "left").select(
        "municipio",
        "uf",
        "regiao",
        "populacao",
        "pib_per_capita",
        F.coalesce("qtd_clientes", F.lit(0)).alias("qtd_clientes"),
        finance.share_pct(F.coalesce("qtd_clientes", F.lit(0)), people, 4).alias("penetracao_pct"),
        "volume_transacoes",
        mean("volume_transacoes", "_n").alias("ticket_medio"),
    )


def credit_by_region(municipalities: DataFrame, clients: DataFrame, proposals: DataFrame) -> DataFrame:
    """Proposals and approval rate of each region and state, beside its product per head."""
    per_client = proposals.groupBy("sk_cliente").agg(
        F.count("*").alias("_rows"),
        F.count_if(F.col("status_proposta") == APPROVED).alias("_ok"),
        money("valor_proposta").alias("_value"),
        F.count("valor_proposta").alias("_n"),
    )
    gdp = F.col("pib_per_capita")
    return (
        clients.select("sk_cliente", "sk_municipio")
        .join(per_client, "sk_cliente")
        .join(municipalities.select("sk_municipio", "regiao", "uf", "pib_per_capita"), "sk_municipio")
        .groupBy("regiao", "uf")
        .agg(
            # The average runs over proposal rows, so each municipality weighs by its rows.
            F.sum(gdp * F.col("_rows")).alias("_gdp"),
            F.sum(F.when(gdp.isNotNull(), F.col("_rows"))).alias("_gdp_rows"),
            F.sum("_rows").alias("qtd_propostas"),
            F.sum("_ok").alias("propostas_aprovadas"),
            money("_value").alias("_value"),
            F.sum("_n").alias("_n"),
        )
        .select(
            "regiao",
            "uf",
            mean("_gdp", "_gdp_rows").alias("pib_per_capita_medio"),
            "qtd_propostas",
            "propostas_aprovadas",
            finance.share_pct("propostas_aprovadas", "qtd_propostas").alias("taxa_aprovacao_pct"),
            mean("_value", "_n").alias("valor_medio_solicitado"),
        )
    )


def first_branch(accounts: DataFrame) -> DataFrame:
    """The branch of each client's first account, by account number."""
    return accounts.groupBy("cod_cliente").agg(
        F.min_by("cod_agencia", F.struct("num_conta", "cod_agencia")).alias("cod_agencia")
    )


# ------------------------------------------------------------------ calendar and rates


def working_days(cal: DataFrame) -> DataFrame:
    """Working days, holidays and days of each month."""
    return cal.groupBy("ano", "mes", "mes_nome").agg(
        F.count_if(~F.col("eh_fim_semana") & ~F.col("eh_feriado")).alias("dias_uteis"),
        F.count_if("eh_feriado").alias("qtd_feriados"),
        F.count("*").alias("total_dias"),
    )


def transactions_in_dollars(transactions: DataFrame, cal: DataFrame) -> DataFrame:
    quoted = cal.select("sk_tempo", "data", "cotacao_dolar")
    return transactions.join(quoted, "sk_tempo").select(
        "cod_transacao",
        "data",
        "valor_transacao",
        "cotacao_dolar",
        finance.in_dollars("valor_transacao", "cotacao_dolar").alias("valor_usd"),
    )


def transactions_against_rate(transactions: DataFrame, cal: DataFrame) -> DataFrame:
    """Daily rate and what each amount would have earned that day; days without a rate drop out."""
    rated = cal.where("taxa_selic IS NOT NULL").select("sk_tempo", "data", "taxa_selic")
    return transactions.join(rated, "sk_tempo").select(
        "cod_transacao",
        "data",
        "valor_transacao",
        "taxa_selic",
        finance.daily_rate("taxa_selic").alias("selic_diaria"),
        finance.opportunity_cost("valor_transacao", "taxa_selic").alias("custo_oportunidade_dia"),
    )


def last_quote_of_day(quotes: DataFrame, at: str, bid: str, ask: str) -> DataFrame:
    """The last quote of each day and its middle rate."""
    last = F.max(F.struct(F.col(at), F.col(bid), F.col(ask))).alias("_q")
    by_day = quotes.groupBy(F.col(at).cast("date").alias("data")).agg(last)
    bid_value, ask_value = F.col(f"_q.{bid}"), F.col(f"_q.{ask}")
    return by_day.select(
        "data",
        F.round(bid_value, 4).alias("cotacao_compra"),
        F.round(ask_value, 4).alias("cotacao_venda"),
        F.round((bid_value + ask_value) / 2, 4).alias("cotacao_media"),
    )


# ------------------------------------------------------------------ portfolios


def investment_total(positions: DataFrame) -> DataFrame:
    return positions.agg(
        F.coalesce(money(F.when(F.col("status") == "Ativo", F.col("valor_atual"))), F.lit(0)).alias(
            "patrimonio_ativo"
        ),
        F.count("*").alias("qtd_posicoes"),
    )


def arrears_total(contracts: DataFrame) -> DataFrame:
    return contracts.agg(money("valor_aberto").alias("carteira_em_atraso"), F.count("*").alias("qtd_contratos"))


def fraud_totals(frauds: DataFrame) -> DataFrame:
    return frauds.agg(
        F.count("*").alias("qtd_ocorrencias"),
        F.count_if("flag_confirmada").alias("qtd_confirmadas"),
        money(F.when(F.col("flag_confirmada"), F.col("valor_fraude"))).alias("valor_confirmado"),
        money("valor_recuperado").alias("valor_recuperado"),
    )


# ------------------------------------------------------------------ statistics and shares


def exact_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median of a non-negative decimal per group, without gathering a group anywhere.

    Equal values are merged first, map-side and by one shuffle. A monotone bucket of
    the value (256 per doubling, so a few thousand per group) locates the two middle
    ranks among the merged rows, and only the values of those buckets are put in order.
    """
    bucket = F.floor(F.log2(F.col(value).cast("double") + 1) * 256)
    merged = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n")).withColumn("_b", bucket)
    sizes = merged.groupBy(group, "_b").agg(F.sum("_n").alias("_n"))
    upto = Window.partitionBy(group).orderBy("_b")
    placed = sizes.withColumn("_end", F.sum("_n").over(upto)).withColumn(
        "_all", F.sum("_n").over(Window.partitionBy(group))
    )
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    start = F.col("_end") - F.col("_n")
    middle = placed.where(
        low.between(start + 1, F.col("_end")) | high.between(start + 1, F.col("_end"))
    ).select(
        F.col(group).alias("_g"), F.col("_b").alias("_mb"), start.alias("_start"), low.alias("_low"), high.alias("_high")
    )
    counted = merged.join(middle, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_mb")))
    inside = Window.partitionBy(group, "_b").orderBy(value)
    ranked = counted.withColumn("_end", F.col("_start") + F.sum("_n").over(inside))
    first = F.col("_end") - F.col("_n") + 1
    return (
        ranked.groupBy(group)
        .agg(
            F.max(F.when(F.col("_low").between(first, F.col("_end")), F.col(value))).alias("_lo"),
            F.max(F.when(F.col("_high").between(first, F.col("_end")), F.col(value))).alias("_hi"),
        )
        .select(group, ((F.col("_lo") + F.col("_hi")) / 2).alias("mediana"))
    )


def value_calibration(transactions: DataFrame, kind: str = "nome_transacao", value: str = "valor_absoluto") -> DataFrame:
    """Median and population deviation (plus one) of the non-zero amounts of each type."""
    used = transactions.where(F.col(value) > 0)
    spread = used.groupBy(kind).agg(
        F.count("*").alias("qtd"),
        F.round(F.stddev_pop(F.col(value).cast("double")) + 1, 2).alias("desvio"),
    )
    middle = exact_median(used, kind, value).withColumnRenamed(kind, "_kind")
    return spread.join(middle, F.col(kind).eqNullSafe(F.col("_kind"))).drop("_kind")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("qtd"))


def openings_by_year(branches: DataFrame, opened: str = "data_abertura") -> DataFrame:
    """Branches opened each year and in existence at its end. One row per year reaches the window."""
    yearly = branches.groupBy(F.year(opened).alias("ano")).agg(F.count("*").alias("qtd"))
    return yearly.withColumn("acumulado", F.sum("qtd").over(Window.orderBy("ano")))


def allocate(df: DataFrame, key: str, weight: str, total: int, name: str = "cota") -> DataFrame:
    """Split a whole total by weight: at least one each, and the largest share takes the remainder.

    Halves round to even. Among equal largest shares the smallest key takes it.
    """
    whole = df.agg(F.sum(weight)).scalar()
    share = F.greatest(
        F.lit(1), F.bround(F.lit(total) * F.col(weight).cast("double") / whole.cast("double"), 0).cast("long")
    )
    quotas = df.withColumn(name, share)
    rest = quotas.agg(F.lit(total) - F.sum(name)).scalar()
    largest = quotas.agg(F.min_by(key, F.struct(-F.col(name), F.col(key)))).scalar()
    return quotas.withColumn(name, F.col(name) + F.when(F.col(key) == largest, rest).otherwise(0))


def gdp_per_head(gdp: DataFrame, population: DataFrame, key: str = "codigo_ibge") -> DataFrame:
    """Product given in thousands, turned into units and divided by the population."""
    joined = gdp.withColumn("pib_total", F.col("pib_mil") * 1000).join(
        population.select(key, "populacao"), key, "left"
    )
    people = F.when(F.col("populacao") > 0, F.col("populacao"))
    return joined.withColumn(
        "pib_per_capita",
        F.round(F.col("pib_total").cast("decimal(24,2)") / people.cast("decimal(12,0)"), 2),
    )


def income_per_head(published: DataFrame, estimate: DataFrame, key: str = "codigo_ibge") -> DataFrame:
    """The published income, else a twelfth of the yearly product per head, tagged with its source."""
    joined = estimate.join(published.select(key, "renda"), key, "left")
    return joined.select(
        key,
        F.coalesce("renda", F.round(F.col("pib_per_capita") / 12, 2)).alias("renda_media_per_capita"),
        F.when(F.col("renda").isNotNull(), "PUBLICADA").otherwise("ESTIMATIVA").alias("fonte"),
    )


def total_over_categories(series: DataFrame, key: str, value: Column) -> DataFrame:
    """Sum of the parsable cells of each key; suppressed cells are skipped."""
    return (
        series.select(key, value.alias("_v"))
        .where("_v IS NOT NULL")
        .groupBy(key)
        .agg(F.sum("_v").alias("total"))
    )
