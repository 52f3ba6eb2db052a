"""The published answers of the bank's own data set, and the check of the marts against them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.operators.dimensions import constant_rows
from ledgerlake.operators.quality import reconcile, totals

# Expected totals as (mart, total, value). Status counts are compared in rising order.
EXPECTED = [
    ("kpi1", "qtd_agencias", 10.0),
    ("kpi1", "saldo_total", 26509620.12),
    ("kpi2_3", "qtd_linhas", 1478.0),
    ("kpi2_3", "volume_total", 58122708.67),
    ("kpi4", "contagem_1", 468.0),
    ("kpi4", "contagem_2", 490.0),
    ("kpi4", "contagem_3", 513.0),
    ("kpi4", "contagem_4", 525.0),
    ("kpi5", "primeira_agencia", 7.0),
    ("kpi6", "qtd_colaboradores", 100.0),
    ("kpi6", "saldo_gerido", 26509620.12),
    ("kpi7", "18-24", 5312.0),
    ("kpi7", "25-34", 12021.0),
    ("kpi7", "35-44", 16346.0),
    ("kpi7", "45-54", 11647.0),
    ("kpi7", "55-64", 4492.0),
    ("kpi7", "65+", 1179.0),
    ("kpi8", "qtd_meses", 155.0),
    ("kpi8", "volume_nominal", 58122708.67),
]
# How far sums may lie apart, and the share of the managed balance; counts must agree.
TOLERANCE = 0.10
SUMS = {("kpi1", "saldo_total"), ("kpi2_3", "volume_total"), ("kpi6", "saldo_gerido"), ("kpi8", "volume_nominal")}
SHARES = {("kpi6", "saldo_gerido"): 0.01}


def expected_totals(spark: SparkSession) -> DataFrame:
    """mart, total, value, and how far the answer may be from it."""
    rows = [(*row, TOLERANCE if row[:2] in SUMS else 0.0, SHARES.get(row[:2], 0.0)) for row in EXPECTED]
    return constant_rows(spark, ["kpi", "campo", "valor", "tolerancia", "relativa"], rows)


def actual_totals(marts: dict[str, DataFrame]) -> DataFrame:
    """The same totals of a set of marts. Every window here sees one row per status."""
    rising = Window.orderBy("qtd_propostas", "status_proposta")
    counts = marts["kpi4"].select(
        F.lit("kpi4").alias("kpi"),
        F.concat(F.lit("contagem_"), F.row_number().over(rising)).alias("campo"),
        F.col("qtd_propostas").cast("double").alias("valor"),
    )
    bands = marts["kpi7"].select(
        F.lit("kpi7").alias("kpi"),
        F.col("faixa_etaria").alias("campo"),
        F.col("qtd_clientes").cast("double").alias("valor"),
    )
    parts = [
        totals(marts["kpi1"], "kpi1", {"qtd_agencias": F.count("*"), "saldo_total": F.sum("saldo_total")}),
        totals(marts["kpi2_3"], "kpi2_3", {"qtd_linhas": F.count("*"), "volume_total": F.sum("volume_total")}),
        counts,
        totals(marts["kpi5"], "kpi5", {"primeira_agencia": F.min_by("cod_agencia", "ranking")}),
        totals(marts["kpi6"], "kpi6", {"qtd_colaboradores": F.count("*"), "saldo_gerido": F.sum("saldo_gerido")}),
        bands,
        totals(marts["kpi8"], "kpi8", {"qtd_meses": F.count("*"), "volume_nominal": F.sum("volume_nominal")}),
    ]
    return reduce(DataFrame.union, parts)


def golden_check(marts: dict[str, DataFrame], expected: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per total with its verdict; missing or surplus totals fail."""
    return reconcile(actual_totals(marts), expected, tolerance)
