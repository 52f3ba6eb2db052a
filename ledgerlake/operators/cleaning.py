"""Raw text tables to typed, clean ones.

Each function takes raw tables whose columns are all text and returns the typed
table. Nothing here filters on a condition that a cast depends on: the casts
return NULL for bad text, so the optimizer may reorder freely.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import text as t
from ledgerlake.functions.dates import REFERENCE_DAY, age_years, month_start
from ledgerlake.functions.finance import annual_rate
from ledgerlake.functions.rules import age_band, channel_of, region_by_code, region_of

# A branch without its own target, and the days an account may rest and stay active.
DEFAULT_TARGET = 500000
ACTIVE_DAYS = 90


def clean_clients(raw: DataFrame, as_of: dt.date = REFERENCE_DAY) -> DataFrame:
    typed = raw.where(F.col("cpfcnpj").isNotNull()).select(
        t.to_whole("cod_cliente").alias("cod_cliente"),
        F.trim("primeiro_nome").alias("primeiro_nome"),
        F.trim("ultimo_nome").alias("ultimo_nome"),
        F.lower(F.trim("email")).alias("email"),
        F.upper(F.trim("tipo_cliente")).alias("tipo_pessoa"),
        t.to_day("data_inclusao").alias("data_inclusao"),
        t.digits("cpfcnpj").alias("cpf_digits"),
        F.col("cpfcnpj").alias("cpf_formatado"),
        t.to_day("data_nascimento").alias("data_nascimento"),
        F.trim("endereco").alias("endereco"),
        t.digits("cep").alias("cep_digits"),
    )
    aged = typed.withColumn("idade", age_years("data_nascimento", as_of).cast("smallint"))
    return aged.withColumn("faixa_etaria", age_band("idade")).where("cod_cliente IS NOT NULL")


def clean_synthetic_clients(raw: DataFrame) -> DataFrame:
    """As above, but age, band and score come with the data."""
    return raw.select(
        t.to_whole("cod_cliente").alias("cod_cliente"),
        F.trim("primeiro_nome").alias("primeiro_nome"),
        F.trim("ultimo_nome").alias("ultimo_nome"),
        F.lower(F.trim("email")).alias("email"),
        F.upper("tipo_cliente").alias("tipo_pessoa"),
        t.to_day("data_inclusao").alias("data_inclusao"),
        F.col("cpfcnpj").alias("cpf_formatado"),
        t.to_day("data_nascimento").alias("data_nascimento"),
        t.to_whole("idade", "smallint").alias("idade"),
        "faixa_etaria",
        "cidade",
        F.upper("uf").alias("uf"),
        F.col("cep").alias("cep_digits"),
        t.to_decimal("renda_mensal", 12).alias("renda_mensal"),
        "faixa_renda",
        "profissao",
        "escolaridade",
        t.to_whole("score_credito", "smallint").alias("score_credito"),
        "faixa_score",
    ).where("cod_cliente IS NOT NULL")


def activity_flag(last_entry: Column, newest: Column, days: int = ACTIVE_DAYS) -> Column:
    """Active means an entry within `days` of the newest entry in the whole table."""
    return F.coalesce(last_entry >= F.date_sub(newest, days), F.lit(False))


def clean_accounts(raw: DataFrame) -> DataFrame:
    last_entry = t.to_day("data_ultimo_lancamento")
    newest = raw.agg(F.max(last_entry)).scalar()
    typed = raw.where(F.col("saldo_total").rlike(t.amount_pattern())).select(
        t.to_whole("num_conta").alias("num_conta"),
        t.to_whole("cod_cliente").alias("cod_cliente"),
        t.to_whole("cod_agencia").alias("cod_agencia"),
        t.to_whole("cod_colaborador").alias("cod_colaborador"),
        F.trim("tipo_conta").alias("tipo_conta"),
        t.to_day("data_abertura").alias("data_abertura"),
        t.to_decimal("saldo_total").alias("saldo_total"),
        t.to_decimal("saldo_disponivel").alias("saldo_disponivel"),
        last_entry.alias("data_ultimo_lancamento"),
    ).where("num_conta IS NOT NULL")
    return typed.withColumn("eh_conta_ativa", activity_flag(F.col("data_ultimo_lancamento"), newest))


def clean_transactions(
    raw: DataFrame, channel: Callable[[str], Column] = channel_of
) -> DataFrame:
    """Zero and sign are told from the amount as written, before it is rounded.

    Rows that cannot be kept are listed, each with its reason, by `rejects`.
    """
    fits = F.col("valor_transacao").rlike(t.amount_pattern(zero=False))
    amount = t.to_decimal("valor_transacao")
    moment = t.to_instant("data_transacao")
    return (
        raw.where(fits)
        .select(
            t.to_whole("cod_transacao", "bigint").alias("cod_transacao"),
            t.to_whole("num_conta").alias("num_conta"),
            moment.alias("data_transacao"),
            F.trim("nome_transacao").alias("nome_transacao"),
            amount.alias("valor_transacao"),
            channel("nome_transacao").alias("canal"),
            month_start(moment).alias("mes_referencia"),
            F.abs(amount).alias("valor_absoluto"),
            (~F.col("valor_transacao").startswith("-")).alias("flag_credito"),
        )
        .where("cod_transacao IS NOT NULL")
    )


def clean_branches(raw: DataFrame, extended: DataFrame) -> DataFrame:
    extra = extended.select(
        "cod_agencia",
        t.to_decimal("meta_comercial_mensal").alias("_meta"),
        t.to_decimal("latitude", 10, 7).alias("latitude"),
        t.to_decimal("longitude", 10, 7).alias("longitude"),
    )
    return (
        raw.where("cod_agencia IS NOT NULL")
        .join(extra, "cod_agencia", "left")
        .select(
            t.to_whole("cod_agencia").alias("cod_agencia"),
            F.trim("nome").alias("nome"),
            F.upper(F.trim("tipo_agencia")).alias("tipo_agencia"),
            "cidade",
            F.upper("uf").alias("uf"),
            region_of("uf").alias("regiao"),
            t.to_day("data_abertura").alias("data_abertura"),
            F.coalesce("_meta", F.lit(DEFAULT_TARGET).cast("decimal(14,2)")).alias("meta_comercial_mensal"),
            "latitude",
            "longitude",
            F.lit(True).alias("eh_ativa"),
        )
    )


def clean_staff(extended: DataFrame, originals: DataFrame) -> DataFrame:
    """Extended rows first, then the originals that have no extended row."""
    full = extended.where("cod_colaborador IS NOT NULL").select(
        t.to_whole("cod_colaborador").alias("cod_colaborador"),
        "primeiro_nome",
        "ultimo_nome",
        F.lower("email").alias("email"),
        "cpf",
        t.to_day("data_nascimento").alias("data_nascimento"),
        "cidade",
        F.upper("uf").alias("uf"),
        "regiao",
        "cargo",
        t.to_whole("nivel_hierarquico", "smallint").alias("nivel_hierarquico"),
        "departamento",
        t.to_decimal("salario_base", 12).alias("salario_base"),
        t.to_whole("cod_agencia").alias("cod_agencia"),
        t.to_day("data_admissao").alias("data_admissao"),
        t.to_day(t.blank_to_null("data_demissao")).alias("data_demissao"),
        t.truthy("eh_ativo").alias("eh_ativo"),
    )
    bare = originals.join(extended, "cod_colaborador", "left_anti").select(
        t.to_whole("cod_colaborador").alias("cod_colaborador"),
        "primeiro_nome",
        "ultimo_nome",
        F.lower("email").alias("email"),
        "cpf",
        t.to_day("data_nascimento").alias("data_nascimento"),
        F.lit(True).alias("eh_ativo"),
    )
    return full.unionByName(bare, allowMissingColumns=True)


def _proposals(raw: DataFrame) -> DataFrame:
    return raw.select(
        t.to_whole("cod_proposta", "bigint").alias("cod_proposta"),
        t.to_whole("cod_cliente").alias("cod_cliente"),
        t.to_whole("cod_colaborador").alias("cod_colaborador"),
        t.to_day("data_entrada_proposta").alias("data_entrada_proposta"),
        t.to_decimal("taxa_juros_mensal", 8, 6).alias("taxa_juros_mensal"),
        t.to_decimal("valor_proposta").alias("valor_proposta"),
        t.to_decimal("valor_financiamento").alias("valor_financiamento"),
        t.to_decimal("valor_entrada").alias("valor_entrada"),
        t.to_decimal("valor_prestacao").alias("valor_prestacao"),
        t.to_whole("quantidade_parcelas", "smallint").alias("quantidade_parcelas"),
        F.coalesce(t.to_whole(t.blank_to_null("carencia"), "smallint"), F.lit(0).cast("smallint")).alias(
            "carencia_dias"
        ),
        F.trim("status_proposta").alias("status_proposta"),
    ).where("cod_proposta IS NOT NULL")


def clean_proposals(originals: DataFrame, synthetic: DataFrame | None = None) -> DataFrame:
    """Originals need an unsigned plain amount; synthetic rows are taken as they come."""
    kept = _proposals(originals.where(F.col("valor_proposta").rlike(t.amount_pattern(signed=False))))
    return kept if synthetic is None else kept.unionByName(_proposals(synthetic))


def tag_projection(real: DataFrame, projected: DataFrame) -> DataFrame:
    """Real rows tagged REAL, then the rows of the second table tagged PROJECAO."""
    return real.withColumn("tipo", F.lit("REAL")).unionByName(
        projected.where(F.col("tipo") == "PROJECAO"), allowMissingColumns=True
    )


def clean_ipca(raw: DataFrame, projected: DataFrame) -> DataFrame:
    joined = tag_projection(raw.where(F.col("data").rlike(t.ISO_DAY)), projected)
    return joined.select(
        t.to_day("data").alias("data"),
        t.to_whole("ano", "smallint").alias("ano"),
        "mes",
        t.to_whole("mes_num", "smallint").alias("mes_num"),
        t.to_decimal("indice", 10).alias("indice"),
        t.to_decimal("no_mes", 6).alias("variacao_mensal"),
        t.to_decimal("acumulado_12m", 6).alias("acumulado_12m"),
        t.to_decimal("acumulado_ano", 6).alias("acumulado_ano"),
        "tipo",
    )


def clean_selic(raw: DataFrame, projected: DataFrame) -> DataFrame:
    return tag_projection(raw, projected).select(
        t.to_day("data").alias("data"),
        t.to_decimal("taxa_selic", 10, 6).alias("taxa_selic"),
        annual_rate(t.to_decimal("taxa_selic", 18, 10)).alias("taxa_selic_aa"),
        "tipo",
    )


def clean_municipalities(
    places: DataFrame,
    population: DataFrame,
    gdp: DataFrame,
    population_year: str = "2022",
    gdp_year: str = "2021",
) -> DataFrame:
    people = population.where(F.col("ano") == population_year).select(
        "codigo_ibge",
        t.to_whole("populacao").alias("populacao"),
        t.to_whole("ano", "smallint").alias("ano_populacao"),
    )
    product = gdp.where(F.col("ano") == gdp_year).select(
        "codigo_ibge",
        t.to_whole("pib_total", "bigint").alias("pib_total"),
        t.to_decimal("pib_per_capita").alias("pib_per_capita"),
        t.to_whole("ano", "smallint").alias("ano_pib"),
    )
    return (
        places.join(people, "codigo_ibge", "left")
        .join(product, "codigo_ibge", "left")
        .select(
            t.to_whole("codigo_ibge").alias("codigo_ibge"),
            "municipio",
            F.upper("uf").alias("uf"),
            region_of("uf").alias("regiao"),
            "populacao",
            "ano_populacao",
            "pib_total",
            "pib_per_capita",
            "ano_pib",
        )
    )


def rename_to(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


# The common names of the proposal columns in the merged table.
PROPOSAL_NAMES = {
    "data_entrada_proposta": "data_proposta",
    "taxa_juros_mensal": "taxa_juros",
    "quantidade_parcelas": "prazo_meses",
}


def drop_unparsed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows whose key failed to parse."""
    return df.dropna(subset=keys)


def flatten_places(raw: DataFrame, column: str = "value") -> DataFrame:
    """One row per place from nested JSON: the first path to the state wins, else the second."""
    state = "struct<sigla:string,nome:string,regiao:struct<sigla:string>>"
    schema = (
        "struct<id:bigint,nome:string,"
        f"microrregiao:struct<mesorregiao:struct<UF:{state}>>,"
        f"`regiao-imediata`:struct<`regiao-intermediaria`:struct<UF:{state}>>>"
    )
    place = raw.select(F.from_json(column, schema).alias("p"))
    with_state = place.select(
        "p.id",
        "p.nome",
        F.coalesce(
            F.col("p.microrregiao.mesorregiao.UF"),
            F.col("p.`regiao-imediata`.`regiao-intermediaria`.UF"),
        ).alias("s"),
    )
    return with_state.select(
        F.col("id").alias("codigo_ibge"),
        F.col("nome").alias("municipio"),
        F.col("s.sigla").alias("uf"),
        F.col("s.nome").alias("uf_nome"),
        region_by_code("s.regiao.sigla").alias("regiao"),
        F.col("s.regiao.sigla").alias("regiao_sigla"),
    )


def flatten_series(raw: DataFrame, column: str = "value", year: str = "2022") -> DataFrame:
    """One row per place and series from the nested answer of a statistics service."""
    schema = (
        "array<struct<resultados:array<struct<series:array<struct<"
        "localidade:struct<id:string,nome:string>,serie:map<string,string>>>>>>>"
    )
    return (
        raw.select(F.explode(F.from_json(column, schema)).alias("v"))
        .select(F.explode("v.resultados").alias("r"))
        .select(F.explode("r.series").alias("s"))
        .select(
            F.col("s.localidade.id").alias("codigo_ibge"),
            F.col("s.localidade.nome").alias("municipio"),
            F.lit(int(year)).alias("ano"),
            F.try_element_at(F.col("s.serie"), F.lit(year)).alias("valor"),
        )
    )


def variant_places(raw: DataFrame, column: str = "value") -> DataFrame:
    """As `flatten_places`, for answers whose layout is not declared: each value is looked up along two paths."""
    state = ["$.microrregiao.mesorregiao.UF", "$['regiao-imediata']['regiao-intermediaria'].UF"]
    answer = raw.select(F.try_parse_json(column).alias("j")).where("j IS NOT NULL")

    def found(path: str) -> Column:
        return F.coalesce(*[F.try_variant_get("j", f"{s}{path}", "string") for s in state])

    return answer.select(
        F.try_variant_get("j", "$.id", "bigint").alias("codigo_ibge"),
        F.try_variant_get("j", "$.nome", "string").alias("municipio"),
        found(".sigla").alias("uf"),
        found(".nome").alias("uf_nome"),
        region_by_code(found(".regiao.sigla")).alias("regiao"),
        found(".regiao.sigla").alias("regiao_sigla"),
    )


def variant_series(raw: DataFrame, column: str = "value") -> DataFrame:
    """One row per place, series and period of a nested answer, whatever periods it holds."""
    answers = raw.select(F.try_parse_json(column).alias("j")).where("j IS NOT NULL")
    spread = lambda df, path, kept: df.select(*kept, F.explode(F.try_variant_get("j", path, "array<variant>")).alias("j"))
    series = spread(spread(spread(answers, "$", []), "$.resultados", []), "$.series", [])
    places = series.select(
        F.try_variant_get("j", "$.localidade.id", "string").alias("codigo_ibge"),
        F.try_variant_get("j", "$.localidade.nome", "string").alias("municipio"),
        F.explode(F.try_variant_get("j", "$.serie", "map<string,string>")).alias("periodo", "valor"),
    )
    return places


# ---------------------------------------------------------------- product sources

# The kinds of the product sources' columns; those not named are trimmed text.
PRODUCT_KINDS = {
    "investimentos": {
        "id_investimento": "bigint", "cod_cliente": "bigint", "cod_agencia": "bigint", "data_aplicacao": "date", "data_vencimento": "date",
        "valor_aplicado": "decimal(14,2)", "valor_atual": "decimal(14,2)", "rentabilidade_pct": "decimal(8,4)", "data_resgate": "date",
        "valor_resgate": "decimal(14,2)",
    },
    "cartoes": {
        "id_fatura": "bigint", "cod_cliente": "bigint", "cod_agencia": "bigint", "mes_referencia": "date", "limite_total": "decimal(12,2)",
        "limite_disponivel": "decimal(12,2)", "gasto_mes": "decimal(12,2)", "valor_fatura": "decimal(12,2)", "valor_pago": "decimal(12,2)",
        "valor_parcelado": "decimal(12,2)", "qtd_parcelas": "int", "dias_atraso": "int", "taxa_rotativo_mes": "decimal(6,4)",
        "pct_utilizacao": "decimal(5,2)",
    },
    "seguros": {
        "id_apolice": "bigint", "cod_cliente": "bigint", "cod_agencia": "bigint", "data_inicio": "date", "data_fim": "date",
        "valor_segurado": "decimal(14,2)", "premio_mensal": "decimal(10,2)", "valor_sinistro": "decimal(14,2)", "foi_cross_sell": "boolean",
    },
    "inadimplencia": {
        "id_inadimplencia": "bigint", "cod_cliente": "bigint", "data_referencia": "date", "valor_total_contrato": "decimal(14,2)",
        "valor_aberto": "decimal(14,2)", "dias_atraso": "int", "score_credito": "int", "valor_recuperado": "decimal(14,2)",
        "flag_write_off": "boolean", "data_write_off": "date",
    },
    "fraudes": {
        "id_fraude": "bigint", "cod_cliente": "bigint", "cod_agencia": "bigint", "data_ocorrencia": "date", "valor_fraude": "decimal(14,2)",
        "flag_tentativa": "boolean", "flag_confirmada": "boolean", "valor_recuperado": "decimal(14,2)", "data_deteccao": "timestamp_ntz",
    },
}


def clean_product_source(raw: DataFrame, table: str) -> DataFrame:
    """Typed rows of a product source; bad text gives NULL, and rows without their own key or client go."""
    kinds = PRODUCT_KINDS[table]
    key = next(iter(kinds))

    def typed(name: str) -> Column:
        kind, value = kinds.get(name), F.trim(name)
        if kind is None:
            return value.alias(name)
        return (F.when(value != "", t.truthy(value)) if kind == "boolean" else t.blank_to_null(value).try_cast(kind)).alias(name)

    return raw.select(*map(typed, raw.columns)).where(f"{key} IS NOT NULL AND cod_cliente IS NOT NULL")


# ---------------------------------------------------------------- rows that cleaning leaves out

@dataclass(frozen=True)
class Kept:
    """What cleaning asks of a raw table's rows: a key, perhaps further ones, perhaps an amount with or without sign and zero."""

    table: str
    key: str
    amount: str | None = None
    signed: bool = True
    zero: bool = True
    kind: str = "bigint"
    owner: str | None = None
    blank: bool = False  # blank keys count as missing


# What cleaning asks of each table that it filters.
KEPT_IF = [
    Kept("clientes", "cod_cliente"),
    Kept("clientes_sinteticos", "cod_cliente"),
    Kept("contas", "num_conta", "saldo_total"),
    Kept("transacoes", "cod_transacao", "valor_transacao", zero=False),
    Kept("propostas_credito", "cod_proposta", "valor_proposta", signed=False),
    Kept("propostas_sinteticas", "cod_proposta"),
    Kept("agencias", "cod_agencia", kind="string"),
    Kept("ipca", "data", kind="day"),
    *[Kept(table, next(iter(kinds)), owner="cod_cliente", blank=True) for table, kinds in PRODUCT_KINDS.items()],
]


def reject_reason(rule: Kept) -> Column:
    """Why a raw row is not kept; NULL for a row that is."""

    def given(name: str) -> Column:
        return t.blank_to_null(F.trim(name)) if rule.blank else F.col(name)

    def wrong(name: str) -> Column:
        if rule.kind == "string":
            return F.lit(False)
        return ~F.col(name).rlike(t.ISO_DAY) if rule.kind == "day" else t.to_whole(given(name)).isNull()

    reason = F.when(given(rule.key).isNull(), "chave ausente").when(wrong(rule.key), "chave inválida")
    if rule.owner is not None:
        reason = reason.when(given(rule.owner).isNull(), "cliente ausente").when(wrong(rule.owner), "cliente inválido")
    if rule.amount is not None:
        amount = F.col(rule.amount)
        reason = (
            reason.when(amount.isNull(), "valor ausente")
            .when(~t.numeric_text(rule.amount, rule.signed), "valor não numérico")
            .when(~amount.rlike(t.amount_pattern(rule.signed)), "valor grande demais")
        )
        if not rule.zero:
            reason = reason.when(~amount.rlike(t.amount_pattern(rule.signed, zero=False)), "valor zero")
    # A client without an identity number is no client at all; that is told first.
    return F.when(F.col("cpfcnpj").isNull(), "documento ausente").otherwise(reason) if rule.table == "clientes" else reason


def rejects(raw: Mapping[str, DataFrame], rules: Sequence[Kept] = KEPT_IF) -> DataFrame:
    """Every raw row that cleaning leaves out: table, key, amount as written, reason."""
    found = None
    for rule in rules:
        one = raw[rule.table].select(
            F.lit(rule.table).alias("tabela"), F.col(rule.key).alias("chave"),
            (F.lit(None).cast("string") if rule.amount is None else F.col(rule.amount)).alias("valor"), reject_reason(rule).alias("motivo"),
        ).where("motivo IS NOT NULL")
        found = one if found is None else found.unionByName(one)
    return found


def reject_counts(raw: Mapping[str, DataFrame], rules: Sequence[Kept] = KEPT_IF) -> DataFrame:
    """Rows left out by table and reason, for the audit."""
    return rejects(raw, rules).groupBy("tabela", "motivo").agg(F.count("*").alias("qtd"))


# Fields whose text may not fit the column that cleaning gives them; the row is kept with NULL there.
NARROW = {
    "clientes_sinteticos": {"idade": "smallint", "score_credito": "smallint", "renda_mensal": "decimal(12,2)", "data_nascimento": "date"},
    "propostas_credito": {"quantidade_parcelas": "smallint", "carencia": "smallint", "taxa_juros_mensal": "decimal(8,6)", "data_entrada_proposta": "date"},
    "propostas_sinteticas": {"quantidade_parcelas": "smallint", "carencia": "smallint", "taxa_juros_mensal": "decimal(8,6)", "valor_proposta": "decimal(14,2)"},
    "transacoes": {"num_conta": "bigint", "data_transacao": "timestamp_ntz"},
    "contas": {"saldo_disponivel": "decimal(14,2)", "data_abertura": "date", "data_ultimo_lancamento": "date"},
    **PRODUCT_KINDS,
}


def lost_values(raw: Mapping[str, DataFrame], kinds: Mapping[str, Mapping[str, str]] = NARROW) -> DataFrame:
    """Texts that were given but give NULL under their column's type: table, column, rows; one pass over each table."""
    found = None
    for table, columns in kinds.items():
        typed = {c: k for c, k in columns.items() if k != "boolean"}
        lost = [F.count_if(t.blank_to_null(F.trim(c)).isNotNull() & F.trim(c).try_cast(k).isNull()).alias(c) for c, k in typed.items()]
        rows = [F.struct(F.lit(table).alias("tabela"), F.lit(c).alias("campo"), F.col(c).alias("qtd")) for c in typed]
        one = raw[table].agg(*lost).select(F.inline(F.array(*rows)))
        found = one if found is None else found.unionByName(one)
    return found
