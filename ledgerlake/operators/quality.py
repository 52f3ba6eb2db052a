"""Data-quality rules, audit log, scorecard, column checks, expectations and reconciliation.

A rule yields one audit row: table, column, text, severity, rows hit, sample and
status. All rules are counted together, in one pass over each table (`findings`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions import text as t
from ledgerlake.functions.dates import REFERENCE_DAY, age_years, day, month_start
from ledgerlake.operators import findings
from ledgerlake.operators.findings import Probe

SAMPLE_ROWS = 5
# Failed totals named in an error, beside their count.
EXAMPLES = 20
SAMPLE_GLUE = " | "

# Severities in order of weight, the status of a new finding, and the verdicts.
SEVERITIES = ["ERROR", "WARNING", "INFO"]
OPEN = "ABERTO"
PASSED, FAILED = "APROVADO", "FALHOU"


@dataclass(frozen=True)
class RowRule:
    """Rows of `table` for which `hit` is TRUE."""

    table: str
    field: str
    text: str
    severity: str
    hit: Column
    sample: Column | None = None


@dataclass(frozen=True)
class DuplicateRule:
    """Rows beyond the first of each value; `fold` ignores case."""

    table: str
    field: str
    text: str
    severity: str
    fold: bool = False
    sample: bool = False


@dataclass(frozen=True)
class OrphanRule:
    """Rows (or distinct keys) of `table` whose key is missing from `parent`."""

    table: str
    field: str
    text: str
    severity: str
    parent: str
    parent_field: str | None = None
    distinct: bool = False


@dataclass(frozen=True)
class BeforeParentRule:
    """Rows dated before the day their parent row was opened."""

    table: str
    field: str
    text: str
    severity: str
    key: str
    parent: str
    opened: str


@dataclass(frozen=True)
class MissingMonthRule:
    """Months between two days that a series does not hold."""

    table: str
    field: str
    text: str
    severity: str
    first: dt.date
    last: dt.date


@dataclass(frozen=True)
class GapRule:
    """Steps of more than `days` between neighbouring days of a series."""

    table: str
    field: str
    text: str
    severity: str
    days: int = 5


Rule = RowRule | DuplicateRule | OrphanRule | BeforeParentRule | MissingMonthRule | GapRule


def _probe(rule: Rule) -> Probe:
    """What a rule looks at."""
    if isinstance(rule, RowRule):
        return Probe(findings.ROWS, rule.table, rule.sample, rule.hit)
    if isinstance(rule, DuplicateRule):
        return Probe(findings.EXTRA, rule.table, F.lower(rule.field) if rule.fold else F.col(rule.field))
    if isinstance(rule, OrphanRule):
        mode = findings.ORPHAN_KEYS if rule.distinct else findings.ORPHAN_ROWS
        return Probe(mode, rule.table, F.col(rule.field), parent=rule.parent, parent_key=F.col(rule.parent_field or rule.field))
    if isinstance(rule, BeforeParentRule):
        return Probe(findings.BEFORE, rule.table, F.col(rule.key), day=F.col(rule.field).try_cast("date"), parent=rule.parent,
                     parent_key=F.col(rule.key), parent_day=F.col(rule.opened).try_cast("date"))
    day_of = F.col(rule.field).try_cast("date")
    if isinstance(rule, MissingMonthRule):
        return Probe(findings.MONTHS, rule.table, day=day_of, first=rule.first, last=rule.last)
    return Probe(findings.GAPS, rule.table, day=day_of, days=rule.days)


def missing_months(series: DataFrame, field: str, first: Column, last: Column) -> DataFrame:
    present = series.select(month_start(F.col(field).try_cast("date")).alias("mes")).distinct()
    expected = series.sparkSession.range(1).select(
        F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("mes")
    )
    return expected.join(present, "mes", "left_anti")


def day_gaps(series: DataFrame, field: str, days: int) -> DataFrame:
    """Neighbouring days of a series that lie more than `days` apart. One row per day reaches the window."""
    distinct_days = series.select(F.col(field).try_cast("date").alias("ate")).where("ate IS NOT NULL").distinct()
    stepped = distinct_days.withColumn("de", F.lag("ate").over(Window.orderBy("ate")))
    return stepped.withColumn("dias", F.datediff("ate", "de")).where(F.col("dias") > days).select("de", "ate", "dias")


def audit(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """The audit log: one row per rule, zero counts included. Runs one job, which reads each table once."""
    sampled = {
        i: isinstance(r, RowRule)
        for i, r in enumerate(rules)
        if isinstance(r, RowRule) and r.sample is not None or isinstance(r, DuplicateRule) and r.sample
    }
    found = findings.counts(tables, [_probe(r) for r in rules], sampled, SAMPLE_ROWS, SAMPLE_GLUE)
    named = [
        F.struct(F.lit(i).alias("rule"), F.lit(r.table).alias("tabela"), F.lit(r.field).alias("campo"), F.lit(r.text).alias("regra"), F.lit(r.severity).alias("severidade"))
        for i, r in enumerate(rules)
    ]
    listed = found.sparkSession.range(1).select(F.inline(F.array(*named)))
    # A row for each rule on either side.
    return listed.join(F.broadcast(found), "rule", "left").select(
        "tabela", "campo", "regra", "severidade", F.coalesce("n", F.lit(0)).alias("qtd_registros"), F.col("sample").alias("amostra"), F.lit(OPEN).alias("status")
    )


def scorecard(log: DataFrame) -> DataFrame:
    """Rules with hits, rows hit and rows still open, per table and severity."""
    hits = F.col("qtd_registros")
    return log.groupBy("tabela", "severidade").agg(
        F.count_if(hits > 0).alias("qtd_regras_violadas"),
        F.sum(hits).alias("total_registros_afetados"),
        F.sum(F.when(F.col("status") == OPEN, hits).otherwise(0)).alias("registros_em_aberto"),
    )


def severity_rank(severity: Column | str) -> Column:
    severity = F.col(severity) if isinstance(severity, str) else severity
    return F.when(severity == SEVERITIES[0], 1).when(severity == SEVERITIES[1], 2).otherwise(3)


def bank_rules(as_of: dt.date = REFERENCE_DAY) -> list[Rule]:
    """The standard audit of the raw bank tables."""
    # Wide enough for any text of a number, so that small and huge values count for what they are.
    number = lambda value, precision=38, scale=10: t.to_decimal(value, precision, scale)
    age = age_years(t.to_day("data_nascimento"), as_of)
    return [
        RowRule("clientes", "cpfcnpj", "Formato CPF inválido", "ERROR",
                ~F.col("cpfcnpj").rlike(t.CPF_FORMAT), F.col("cpfcnpj")),
        DuplicateRule("clientes", "cpfcnpj", "CPF duplicado", "ERROR", sample=True),
        DuplicateRule("clientes", "email", "Email duplicado", "WARNING", fold=True),
        RowRule("clientes", "data_nascimento", "Idade fora do range 18-120 anos", "ERROR",
                ~age.between(18, 120)),
        RowRule("clientes", "email", "Email nulo", "WARNING",
                F.col("email").isNull() | (F.col("email") == "")),
        OrphanRule("contas", "cod_cliente", "Conta sem cliente", "ERROR", "clientes"),
        OrphanRule("contas", "cod_agencia", "Conta sem agência", "ERROR", "agencias"),
        RowRule("contas", "saldo_disponivel", "Saldo disponível maior que saldo total", "ERROR",
                number("saldo_disponivel") > number("saldo_total") + F.lit("0.01").cast("decimal(3,2)"),
                F.col("num_conta")),
        RowRule("contas", "data_abertura", "Data de abertura no futuro", "ERROR",
                t.to_day("data_abertura") > day(as_of)),
        RowRule("transacoes", "valor_transacao", "Valor de transação zero", "ERROR",
                number("valor_transacao") == 0),
        OrphanRule("transacoes", "num_conta", "Transação sem conta", "ERROR", "contas", distinct=True),
        BeforeParentRule("transacoes", "data_transacao", "Transação anterior à abertura da conta", "ERROR",
                         "num_conta", "contas", "data_abertura"),
        RowRule("transacoes", "valor_transacao", "Valor acima de 1.000.000", "WARNING",
                F.abs(number("valor_transacao")) > 1000000),
        RowRule("propostas_credito", "taxa_juros_mensal", "Taxa fora do range 0%-30%", "ERROR",
                ~number("taxa_juros_mensal").between(0, F.lit("0.30").cast("decimal(3,2)"))),
        RowRule("propostas_credito", "valor_entrada", "Entrada não menor que a proposta", "ERROR",
                number("valor_entrada") >= number("valor_proposta")),
        OrphanRule("propostas_credito", "cod_cliente", "Proposta sem cliente", "ERROR", "clientes"),
        MissingMonthRule("ipca", "data", "Mês faltando na série", "ERROR",
                         dt.date(2010, 1, 1), dt.date(2025, 12, 1)),
        GapRule("selic", "data", "Intervalo maior que 5 dias na série", "WARNING"),
    ]


# ------------------------------------------------------------------ column checks


@dataclass(frozen=True)
class ColumnCheck:
    """`test` is not_null, unique, accepted_values or relationships."""

    table: str
    column: str
    test: str
    values: tuple[str, ...] = ()
    to: str | None = None
    field: str | None = None


def _checked(check: ColumnCheck) -> Probe:
    column = F.col(check.column)
    if check.test == "not_null":
        return Probe(findings.ROWS, check.table, when=column.isNull())
    if check.test == "accepted_values":
        return Probe(findings.ROWS, check.table, when=~column.isin(*check.values))
    if check.test == "unique":
        return Probe(findings.REPEATED, check.table, column)
    if check.test == "relationships":
        return Probe(findings.ORPHAN_ROWS, check.table, column, column.isNotNull(), parent=check.to, parent_key=F.col(check.field or check.column))
    raise ValueError(f"unknown check {check.test}")


def column_checks(tables: Mapping[str, DataFrame], checks: Sequence[ColumnCheck]) -> DataFrame:
    """Failures of each check, zero counts included. Runs one job, which reads each table once."""
    found = findings.counts(tables, [_checked(c) for c in checks], {}, SAMPLE_ROWS, SAMPLE_GLUE)
    named = [F.struct(F.lit(i).alias("rule"), F.lit(c.table).alias("tabela"), F.lit(c.column).alias("coluna"), F.lit(c.test).alias("teste")) for i, c in enumerate(checks)]
    listed = found.sparkSession.range(1).select(F.inline(F.array(*named)))
    return listed.join(F.broadcast(found), "rule", "left").select("tabela", "coluna", "teste", F.coalesce("n", F.lit(0)).alias("falhas"))


# ------------------------------------------------------------------ expectations and gates


class QualityError(Exception):
    """A gate refused the data."""


@dataclass(frozen=True)
class Expectation:
    """A SQL condition every row should meet. NULL counts as not met."""

    name: str
    condition: str
    fatal: bool = False


def expectation_report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows that fail each expectation, from one pass over the table."""
    counts = df.agg(
        F.count("*").alias("rows"),
        *[
            F.count_if(~F.coalesce(F.expr(e.condition), F.lit(False))).alias(f"e{i}")
            for i, e in enumerate(expectations)
        ],
    )
    rows = [
        F.struct(F.lit(e.name).alias("expectativa"), F.lit(e.fatal).alias("fatal"),
                 F.col(f"e{i}").alias("falhas"), F.col("rows").alias("linhas"))
        for i, e in enumerate(expectations)
    ]
    return counts.select(F.inline(F.array(*rows)))


def expect(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Run the report (one job) and raise if a fatal expectation failed; else hand the table on."""
    broken = expectation_report(df, expectations).where("fatal AND falhas > 0").collect()
    if broken:
        raise QualityError("; ".join(f"{r.expectativa}: {r.falhas} of {r.linhas} rows" for r in broken))
    return df


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Stop when a source is empty. Reads at most one row."""
    if df.isEmpty():
        raise QualityError(f"{name} is empty")
    return df


def totals(kpi: DataFrame, name: str, measures: dict[str, Column]) -> DataFrame:
    """One row per total of a mart: (kpi, campo, valor)."""
    one = kpi.agg(*[m.alias(k) for k, m in measures.items()])
    rows = [
        F.struct(F.lit(name).alias("kpi"), F.lit(k).alias("campo"), F.col(k).cast("double").alias("valor"))
        for k in measures
    ]
    return one.select(F.inline(F.array(*rows)))


def reconcile(
    actual: DataFrame, expected: DataFrame, tolerance: float = 0.02, relative: float = 0.0
) -> DataFrame:
    """Compare totals key by key; a key missing on one side fails. Expected totals may carry their own `tolerancia` and `relativa`."""
    own = [F.col(c) if c in expected.columns else F.lit(float(v)).alias(c) for c, v in (("tolerancia", tolerance), ("relativa", relative))]
    a = actual.select("kpi", "campo", F.col("valor").alias("obtido"))
    e = expected.select("kpi", "campo", F.col("valor").alias("esperado"), *own)
    gap = F.abs(F.col("obtido") - F.col("esperado"))
    allowed = F.greatest(F.col("tolerancia"), F.abs("esperado") * F.col("relativa"))
    return a.join(e, ["kpi", "campo"], "full").select(
        "kpi", "campo", "obtido", "esperado",
        F.round(gap, 2).alias("diferenca"),
        F.when(gap <= allowed, PASSED).otherwise(FAILED).alias("situacao"),
    )


def require_passed(results: DataFrame) -> DataFrame:
    """Raise when any reconciliation row failed."""
    failed = results.where(F.col("situacao") != PASSED)
    count = failed.count()
    if count:
        shown = "; ".join(f"{r.kpi}.{r.campo}: {r.obtido} != {r.esperado}" for r in failed.take(EXAMPLES))
        raise QualityError(f"{count} of the totals failed, for example {shown}")
    return results
