"""The rules as functions of the catalog, for use in plain SQL. Each is an expression: the optimizer sees through it."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerlake.functions import rules
from ledgerlake.functions.dates import REFERENCE_DAY

_DIGITS = "regexp_replace({0}, '[^0-9]', '')"


def _check_digit(number: str, length: int) -> str:
    total = f"aggregate(sequence(1, {length}), 0, (t, i) -> t + CAST(substr({number}, i, 1) AS INT) * ({length + 2} - i))"
    return f"CASE WHEN 11 - {total} % 11 >= 10 THEN 0 ELSE 11 - {total} % 11 END"


def _cpf(text: str) -> str:
    number = _DIGITS.format(text)
    digit = [f"CAST(substr({number}, {place}, 1) AS INT)" for place in (10, 11)]
    return (
        f"CASE WHEN length({number}) <> 11 THEN false WHEN {number} = repeat(substr({number}, 1, 1), 11) THEN false "
        f"ELSE ({_check_digit(number, 9)}) = {digit[0]} AND ({_check_digit(number, 10)}) = {digit[1]} END"
    )


def _bands(value: str, bands: list[tuple], default: str) -> str:
    cases = " ".join(f"WHEN {value} >= {low}" + ("" if high is None else f" AND {value} <= {high}") + f" THEN '{label}'" for low, high, label in bands)
    return f"CASE {cases} ELSE '{default}' END"


def _age(birth: str, day: str) -> str:
    month_day = "(month({0}) * 100 + day({0}))"
    return f"(year({day}) - year({birth}) - CASE WHEN {month_day.format(day)} < {month_day.format(birth)} THEN 1 ELSE 0 END)"


def functions() -> dict[str, str]:
    """Name -> parameters, result and body."""
    day = f"DATE'{REFERENCE_DAY}'"
    return {
        "valida_cpf": f"(cpf STRING) RETURNS BOOLEAN RETURN {_cpf('cpf')}",
        "valida_cep": f"(cep STRING) RETURNS BOOLEAN RETURN {_DIGITS.format('cep')} RLIKE '^[0-9]{{8}}$'",
        "faixa_etaria": f"(nascimento DATE, em DATE DEFAULT {day}) RETURNS STRING RETURN {_bands(_age('nascimento', 'em'), rules.AGE_BANDS, 'Menor de idade')}",
        "faixa_score": f"(score DOUBLE) RETURNS STRING RETURN {_bands('score', rules.SCORE_BANDS, 'Inválido')}",
    }


def register_functions(spark: SparkSession, schema: str) -> list[str]:
    """Create or replace the functions in a schema, which is created where it is missing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    names = []
    for name, body in functions().items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {schema}.{name}{body}")
        names.append(f"{schema}.{name}")
    return names
