"""From CSV files to marts, on a bank small enough to add up by hand."""

import csv
import datetime as dt
import os
from decimal import Decimal

from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators.dimensions import calendar
from ledgerlake.plans import golden, warehouse
from ledgerlake.sources.readers import load_group
from ledgerlake.sources.tables import bank_specs

D = Decimal

FILES = {
    "clientes": [
        dict(cod_cliente="1", primeiro_nome="Ana", ultimo_nome="Sá", data_inclusao="2020-01-01", cpfcnpj="529.982.247-25", data_nascimento="2000-06-10"),
        dict(cod_cliente="2", primeiro_nome="Bia", ultimo_nome="Li", data_inclusao="2020-01-01", cpfcnpj="529.982.247-25", data_nascimento="1950-01-01"),
    ],
    "clientes_sinteticos": [
        dict(cod_cliente="3", primeiro_nome="Cid", ultimo_nome="Ó", data_inclusao="2021-01-01", idade="40", faixa_etaria="35-44",
             cidade="recife", uf="pe", score_credito="600", renda_mensal="1000"),
        dict(cod_cliente="2", primeiro_nome="Bia", ultimo_nome="Nova", data_inclusao="2019-01-01", idade="30", faixa_etaria="25-34"),
    ],
    "contas": [
        dict(num_conta="11", cod_cliente="1", cod_agencia="7", cod_colaborador="50", data_abertura="2020-01-01", saldo_total="100.50",
             saldo_disponivel="90", data_ultimo_lancamento="2024-02-10"),
        dict(num_conta="12", cod_cliente="3", cod_agencia="8", cod_colaborador="50", data_abertura="2024-01-20", saldo_total="10",
             saldo_disponivel="9", data_ultimo_lancamento="2024-02-11"),
        dict(num_conta="13", cod_cliente="2", cod_agencia="7", cod_colaborador="", saldo_total="x", data_ultimo_lancamento="2024-02-11"),
    ],
    "transacoes": [
        dict(cod_transacao="1", num_conta="11", data_transacao="2024-01-15 10:00:00", nome_transacao="Pix - Realizado", valor_transacao="50.25"),
        dict(cod_transacao="2", num_conta="11", data_transacao="2024-02-15 10:00:00", nome_transacao="Saque", valor_transacao="-20"),
        dict(cod_transacao="3", num_conta="12", data_transacao="2024-01-15 10:00:00", nome_transacao="Pix - Realizado", valor_transacao="10"),
        dict(cod_transacao="4", num_conta="99", data_transacao="2024-01-15 10:00:00", nome_transacao="Pix - Realizado", valor_transacao="10"),
    ],
    "agencias": [
        dict(cod_agencia="7", nome="Centro", cidade="São Paulo", uf="SP", data_abertura="2010-01-01", tipo_agencia="Física"),
        dict(cod_agencia="8", nome="Mar", cidade="Recife", uf="PE", data_abertura="2015-01-01", tipo_agencia="Digital"),
    ],
    "colaboradores": [dict(cod_colaborador="50", primeiro_nome="Eva", ultimo_nome="Reis")],
    "propostas_credito": [
        dict(cod_proposta="1", cod_cliente="1", cod_colaborador="50", data_entrada_proposta="2024-01-02", taxa_juros_mensal="0.02",
             valor_proposta="1000", valor_financiamento="900", status_proposta="Aprovada"),
        dict(cod_proposta="2", cod_cliente="3", cod_colaborador="50", data_entrada_proposta="2024-01-03", taxa_juros_mensal="0.04",
             valor_proposta="500", valor_financiamento="500", status_proposta="Enviada"),
    ],
    "ipca": [dict(data="2024-01-01", ano="2024", mes="JAN", mes_num="1", indice="100.00", no_mes="0.4"),
             dict(data="2024-02-01", ano="2024", mes="FEV", mes_num="2", indice="110.00", no_mes="0.5")],
    "feriados": [dict(data="2024-01-01", nome="Ano novo", tipo="Nacional")],
    "municipios": [dict(codigo_ibge="26", municipio="Recife", uf="PE"), dict(codigo_ibge="35", municipio="São Paulo", uf="SP")],
    "populacao": [dict(codigo_ibge="26", municipio="Recife", ano="2022", populacao="1000")],
}


def write_files(root):
    for spec in bank_specs():
        if spec.table in FILES:
            path = f"{root}/{spec.file}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w", encoding="utf-8", newline="") as f:
                writer = csv.DictWriter(f, spec.columns, restval="")
                writer.writeheader()
                writer.writerows(FILES[spec.table])


def test_files_to_marts(spark, tmp_path):
    write_files(tmp_path)
    raw, absent = load_group(spark, str(tmp_path), bank_specs())
    assert "selic" in absent and "clientes" not in absent
    root = str(tmp_path / "warehouse")
    marts = warehouse.build_warehouse(
        raw, lambda: calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31)), root, dt.date(2024, 3, 1))

    assert values(marts["kpi1"], "cod_agencia", "qtd_contas", "saldo_total") == [(7, 1, D("100.50")), (8, 1, D("10.00"))]
    assert values(marts["kpi2_3"], "mes", "nome_transacao", "qtd_transacoes", "volume_total", "pct_mix") == [
        (1, "Pix - Realizado", 2, D("60.25"), 100.0), (2, "Saque", 1, D("20.00"), 100.0)]
    assert values(marts["kpi4"], "status_proposta", "valor_medio", "taxa_media_pct", "pct_status") == [
        ("Aprovada", D("1000.00"), D("2.0000"), 50.0), ("Enviada", D("500.00"), D("4.0000"), 50.0)]
    assert values(marts["kpi5"], "ranking", "cod_agencia", "volume_total") == [(1, 7, D("70.25")), (2, 8, D("10.00"))]
    assert values(marts["kpi6"], "cod_colaborador", "qtd_contas_geridas", "saldo_gerido", "propostas_aprovadas") == [(50, 2, D("110.50"), 1)]
    # Client 2 keeps the original row, which is newer, and the band of a 76-year-old.
    assert values(marts["kpi7"], "faixa_etaria", "qtd_clientes", "saldo_total") == [
        ("18-24", 1, D("100.50")), ("35-44", 1, D("10.00")), ("65+", 1, None)]
    assert values(marts["kpi8"], "mes", "volume_real") == [(1, D("66.28")), (2, D("20.00"))]

    gold = {n: spark.read.parquet(f"{root}/gold/{n}") for n in ("dim_agencia", "dim_cliente", "fato_transacoes", "dim_tempo")}
    assert values(gold["dim_agencia"], "cod_agencia", "sk_municipio") == [(7, 2), (8, 1)]
    assert values(gold["dim_cliente"], "cod_cliente", "sk_cliente", "nome_completo", "sk_municipio") == [
        (1, 1, "Ana Sá", None), (2, 2, "Bia Li", None), (3, 3, "Cid Ó", 1)]
    assert sorted(os.listdir(f"{root}/gold/fato_transacoes"))[-2:] == ["ano_mes=2024-01", "ano_mes=2024-02"]
    assert gold["fato_transacoes"].where(F.col("_carga_ts").isNull()).isEmpty()
    assert gold["dim_tempo"].where("eh_feriado").count() == 1
    assert "_silver_ts" in spark.read.parquet(f"{root}/silver/contas").columns

    checked = golden.golden_check(marts, golden.actual_totals(marts))
    assert checked.where("situacao <> 'APROVADO'").isEmpty()
    assert [r.kpi for r in golden.golden_check(marts, golden.expected_totals(spark)).where("situacao = 'APROVADO'").collect()] == ["kpi5"]


def test_layers_are_written_once_and_reports_are_ordered(spark, tmp_path):
    write_files(tmp_path)
    raw, _ = load_group(spark, str(tmp_path), bank_specs())
    made = []

    def counted(name):
        made.append(name)
        return warehouse.silver(raw)[name]()

    layer = warehouse.StoredTables({n: (lambda n=n: counted(n)) for n in ("contas", "agencias")}, str(tmp_path / "s"))
    assert layer["contas"].count() == layer["contas"].count() == 2
    layer.build()
    assert sorted(made) == ["agencias", "contas"] and len(layer) == 2

    clean = warehouse.silver_layer(raw, str(tmp_path / "w"))
    gold = warehouse.gold_layer(raw, clean, lambda: calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 3, 31)), str(tmp_path / "w"),
                                dt.date(2024, 3, 1), partition_facts=False)
    assert [r.cod_agencia for r in warehouse.report(gold, "kpi1").collect()] == [7, 8]
    assert [r.faixa_etaria for r in warehouse.report(gold, "kpi7").collect()] == ["25-34", "35-44", "65+"]
    assert warehouse.report(gold, "kpi6", 1).count() == 1
    warehouse.publish_marts(gold)
    assert spark.sql("select count(*) from mart_kpi8").first()[0] == 2
