import datetime as dt
from decimal import Decimal

from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import cleaning
from ledgerlake.sources.tables import layout

D, day = Decimal, dt.date


def text_frame(spark, table, rows):
    """A raw table with the given cells; the others are NULL."""
    columns = layout(table)
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], schema)


def test_clients(spark):
    raw = text_frame(spark, "clientes", [
        dict(cod_cliente="1", primeiro_nome=" Ana ", ultimo_nome="Sá", email=" A@B.Com ", tipo_cliente=" pf",
             data_inclusao="2020-01-02", cpfcnpj="529.982.247-25", data_nascimento="2004-02-29", cep="01310-100"),
        dict(cod_cliente="2", cpfcnpj="1", data_nascimento="quando"),
        dict(cod_cliente="3", cpfcnpj=None),
        dict(cod_cliente="x", cpfcnpj="1"),
        dict(cod_cliente=None, cpfcnpj="1"),
    ])
    got = cleaning.clean_clients(raw, day(2025, 2, 28))
    assert values(got, "cod_cliente", "idade", "faixa_etaria") == [(1, 20, "18-24"), (2, None, "Menor")]
    one = got.where("cod_cliente = 1").first()
    assert (one.primeiro_nome, one.email, one.tipo_pessoa, one.cpf_digits, one.cep_digits) == (
        "Ana", "a@b.com", "PF", "52998224725", "01310100")


def test_accounts_need_a_plain_balance_and_rest_against_the_newest_entry(spark):
    rows = [("1", "12.", "2024-12-31"), ("2", "1e3", "2024-12-31"), ("3", "-3", "2024-10-02"),
            ("4", "7", "2024-10-01"), ("5", "7.005", None), ("6", " 7", None), ("7", None, None)]
    raw = text_frame(spark, "contas", [
        dict(num_conta=n, saldo_total=s, saldo_disponivel="1", data_ultimo_lancamento=d) for n, s, d in rows])
    got = cleaning.clean_accounts(raw)
    assert values(got, "num_conta", "saldo_total", "eh_conta_ativa") == [
        (1, D("12.00"), True), (3, D("-3.00"), True), (4, D("7.00"), False), (5, D("7.01"), False)]


def test_transactions_drop_zero_and_bad_amounts(spark):
    rows = [("1", "10.5", "Pix"), ("2", "-2", "Compra Crédito"), ("3", "0.00", "TED"), ("4", "n/d", "TED"), (None, "1", "TED")]
    raw = text_frame(spark, "transacoes", [
        dict(cod_transacao=c, valor_transacao=v, nome_transacao=n, data_transacao="2024-02-29 23:59:59") for c, v, n in rows])
    got = cleaning.clean_transactions(raw)
    assert values(got, "cod_transacao", "valor_absoluto", "flag_credito", "canal", "mes_referencia") == [
        (1, D("10.50"), True, "Pix", day(2024, 2, 1)), (2, D("2.00"), False, "Outros", day(2024, 2, 1))]


def test_branches_take_the_default_target_and_region(spark):
    raw = text_frame(spark, "agencias", [dict(cod_agencia="1", uf="ba"), dict(cod_agencia="2", uf="ZZ"), dict()])
    more = text_frame(spark, "agencias_expandidas", [dict(cod_agencia="1", meta_comercial_mensal="10", latitude="-1.5")])
    got = cleaning.clean_branches(raw, more)
    assert values(got, "cod_agencia", "uf", "regiao", "meta_comercial_mensal") == [
        (1, "BA", "Nordeste", D("10.00")), (2, "ZZ", "Sudeste", D("500000.00"))]


def test_staff_originals_only_fill_the_gaps(spark):
    more = text_frame(spark, "colaboradores_expandidos", [
        dict(cod_colaborador="1", eh_ativo="False", data_demissao="2020-01-01", salario_base="100.5"),
        dict(cod_colaborador="2", eh_ativo="t", data_demissao="")])
    base = text_frame(spark, "colaboradores", [dict(cod_colaborador="2"), dict(cod_colaborador="3")])
    got = cleaning.clean_staff(more, base)
    assert values(got, "cod_colaborador", "eh_ativo", "data_demissao") == [
        (1, False, day(2020, 1, 1)), (2, True, None), (3, True, None)]


def test_proposals_keep_synthetic_rows_as_they_come(spark):
    base = text_frame(spark, "propostas_credito", [
        dict(cod_proposta="1", valor_proposta="10", carencia=""), dict(cod_proposta="2", valor_proposta="-10"),
        dict(cod_proposta="3", valor_proposta="10.", carencia="30")])
    more = text_frame(spark, "propostas_sinteticas", [dict(cod_proposta="9", valor_proposta="-1", status_proposta=" Aprovada ")])
    got = cleaning.clean_proposals(base, more)
    assert values(got, "cod_proposta", "valor_proposta", "carencia_dias", "status_proposta") == [
        (1, D("10.00"), 0, None), (3, D("10.00"), 30, None), (9, D("-1.00"), 0, "Aprovada")]
    assert cleaning.clean_proposals(base).count() == 2


def test_series_tag_real_and_projected(spark):
    real = text_frame(spark, "ipca", [dict(data="2025-01-01", indice="100.5"), dict(data="01/2025")])
    more = text_frame(spark, "ipca_projetado", [dict(data="2026-01-01", tipo="PROJECAO"), dict(data="2025-01-01", tipo="REAL")])
    assert values(cleaning.clean_ipca(real, more), "data", "indice", "tipo") == [
        (day(2025, 1, 1), D("100.50"), "REAL"), (day(2026, 1, 1), None, "PROJECAO")]
    rates = cleaning.clean_selic(
        text_frame(spark, "selic", [dict(data="2025-01-02", taxa_selic="0.0005")]),
        text_frame(spark, "selic_projetada", [dict(data="2026-01-02", taxa_selic="0.0004", tipo="PROJECAO")]))
    assert [(float(r.taxa_selic_aa), r.tipo) for r in rates.orderBy("data").collect()] == [(12.6, "REAL"), (10.08, "PROJECAO")]


def test_second_path_of_nested_places(spark):
    state = '{"sigla":"BA","nome":"Bahia","regiao":{"sigla":"NE"}}'
    texts = ['{"id":1,"nome":"A","microrregiao":{"mesorregiao":{"UF":%s}}}' % state,
             '{"id":2,"nome":"B","microrregiao":null,"regiao-imediata":{"regiao-intermediaria":{"UF":%s}}}' % state,
             '{"id":3,"nome":"C"}']
    got = cleaning.flatten_places(spark.createDataFrame([(x,) for x in texts], "value string"))
    assert values(got, "codigo_ibge", "uf", "regiao") == [(1, "BA", "Nordeste"), (2, "BA", "Nordeste"), (3, None, None)]


def test_municipalities_of_fixed_years(spark):
    got = cleaning.clean_municipalities(
        text_frame(spark, "municipios", [dict(codigo_ibge="1", uf="sp"), dict(codigo_ibge="2", uf="am")]),
        text_frame(spark, "populacao", [dict(codigo_ibge="1", ano="2022", populacao="5"), dict(codigo_ibge="2", ano="2021", populacao="6")]),
        text_frame(spark, "pib_municipal", [dict(codigo_ibge="2", ano="2021", pib_total="9", pib_per_capita="1.5")]))
    assert values(got.select("codigo_ibge", "regiao", "populacao", F.col("pib_total"))) == [(1, "Sudeste", 5, None), (2, "Norte", None, 9)]


def test_one_pattern_tells_what_an_amount_column_can_hold(spark):
    """Against casts to wide decimals, on many spellings."""
    import random
    import re
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    from ledgerlake.functions import text as t

    rng = random.Random(2)
    texts = ["0", "-0", "00.00", "0.0000000000", "0.00000000001", "0.00000000004999", "0.00000000005", "-0.0000000001", "5.", "-5.", ".5", "-", "", "1e3", "+1", " 1", "1 ",
             "999999999999.99", "999999999999.994", "999999999999.995", "000999999999999.999", "1000000000000", "0001000000000000", "-999999999999.996", "12345678901234567890123456789", "1.2.3"]
    texts += ["".join(rng.choice("0019.-5") for _ in range(rng.randrange(1, 16))) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in texts], "v string")

    def plain(text, signed, zero):
        if not re.fullmatch(r"-?[0-9]+\.?[0-9]*" if signed else r"[0-9]+\.?[0-9]*", text):
            return False
        with localcontext() as context:
            context.prec = 60
            value = Decimal(text if not text.endswith(".") else text[:-1])
            return (zero or value.quantize(Decimal("1e-10"), ROUND_HALF_UP) != 0) and abs(value.quantize(Decimal("0.01"), ROUND_HALF_UP)) < 10**12

    for signed in (True, False):
        for zero in (True, False):
            got = {r.v: r.k for r in df.select("v", F.col("v").rlike(t.amount_pattern(signed, zero)).alias("k")).distinct().collect()}
            assert {v: k for v, k in got.items() if k != plain(v, signed, zero)} == {}
    held = df.where(F.col("v").rlike(t.amount_pattern())).where(t.to_decimal("v").isNull())
    assert held.count() == 0  # what the pattern lets pass is never lost by the cast


def test_amounts_are_parsed_once(spark):
    raw = text_frame(spark, "transacoes", [dict(cod_transacao="1", valor_transacao="1", nome_transacao="Pix", data_transacao="2024-02-29 23:59:59")])
    plan = cleaning.clean_transactions(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "decimal(38,10)" not in plan


def test_every_row_is_kept_or_rejected(spark):
    """Of each table that cleaning filters, kept rows and rejected ones add up."""
    raw = {
        "investimentos": text_frame(spark, "investimentos", [dict(id_investimento="1", cod_cliente="2"), dict(id_investimento=" ", cod_cliente="2"), dict(id_investimento="x", cod_cliente="2"),
                                                             dict(id_investimento="3"), dict(id_investimento="4", cod_cliente="y")]),
        "clientes_sinteticos": text_frame(spark, "clientes_sinteticos", [dict(cod_cliente="1"), dict(cod_cliente="x"), dict()]),
        "agencias": text_frame(spark, "agencias", [dict(cod_agencia="1"), dict(cod_agencia="x"), dict()]),
        "transacoes": text_frame(spark, "transacoes", [dict(cod_transacao="1", valor_transacao=v) for v in ("1", "0", "n/d", None, "1000000000000", "0.001")] + [dict(valor_transacao="1")]),
        "ipca": text_frame(spark, "ipca", [dict(data="2025-01-01"), dict(data="01/2025"), dict()]),
    }
    rules = [k for k in cleaning.KEPT_IF if k.table in raw]
    lost = {r.tabela: r.n for r in cleaning.rejects(raw, rules).groupBy("tabela").agg(F.count("*").alias("n")).collect()}
    kept = {
        "investimentos": cleaning.clean_product_source(raw["investimentos"], "investimentos").count(),
        "clientes_sinteticos": cleaning.clean_synthetic_clients(raw["clientes_sinteticos"]).count(),
        "agencias": cleaning.clean_branches(raw["agencias"], text_frame(spark, "agencias_expandidas", [dict(cod_agencia="9")])).count(),
        "transacoes": cleaning.clean_transactions(raw["transacoes"]).count(),
        "ipca": cleaning.clean_ipca(raw["ipca"], text_frame(spark, "ipca_projetado", [dict(tipo="REAL")])).count(),
    }
    assert {name: kept[name] + lost[name] for name in raw} == {name: df.count() for name, df in raw.items()}
    assert values(cleaning.rejects(raw, [k for k in rules if k.table == "investimentos"]), "motivo") == [("chave ausente",), ("chave inválida",), ("cliente ausente",), ("cliente inválido",)]


def test_lost_values(spark):
    raw = {"contas": text_frame(spark, "contas", [dict(saldo_disponivel="1", data_abertura="x"), dict(saldo_disponivel=" ", data_abertura="2020-01-01"), dict(saldo_disponivel="9" * 20)])}
    got = cleaning.lost_values(raw, {"contas": cleaning.NARROW["contas"]})
    assert values(got, "campo", "qtd") == [("data_abertura", 1), ("data_ultimo_lancamento", 0), ("saldo_disponivel", 1)]
