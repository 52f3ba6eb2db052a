import datetime as dt
from decimal import Decimal

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import dimensions, facts, marts

D, day = Decimal, dt.date


@pytest.fixture
def cal(spark):
    return dimensions.calendar(spark, day(2024, 1, 1), day(2024, 3, 31))


def test_standard_calendar(spark):
    cal = dimensions.calendar(spark)
    assert cal.count() == 6209
    row = cal.where("data = date'2024-02-29'").first()
    assert (row.sk_tempo, row.semestre, row.trimestre, row.mes_nome, row.mes_abrev, row.semana_ano, row.dia_semana,
            row.dia_semana_nome, row.eh_fim_semana) == (5173, 1, 1, "February", "FEB", 9, 4, "Thursday", False)
    portuguese = dimensions.calendar(spark, day(2024, 3, 2), day(2024, 3, 2), "pt").first()
    assert (portuguese.mes_nome, portuguese.dia_semana_nome, portuguese.dia_semana) == ("Março", "Sábado", 6)


def test_calendar_enrichment(spark, frame, cal):
    rates = frame("data string, taxa string", [("2024-01-02", "0.5"), ("2024-01-03", "1e3"), ("2024-01-02", "0.4")])
    prices = frame("ano string, mes_num string, indice string, no_mes string",
                   [("2024", "1", "100.5", "0.4"), ("2024", "2", "n/d", "0.1")])
    holidays = frame("data string, nome string, tipo string", [("2024-01-01", "Ano novo", "N"), ("2024-01-06", "Sábado", "N")])
    got = dimensions.with_holidays(
        dimensions.with_monthly(dimensions.with_daily(cal, rates, "taxa", "taxa_selic"), prices,
                                {"indice": "indice_ipca", "no_mes": "ipca_mes"}), holidays)
    assert got.count() == 91
    assert got.where("taxa_selic is not null").select("data").collect() == [(day(2024, 1, 2),)]
    assert got.where("indice_ipca is not null").agg(F.count("*"), F.max("mes")).first() == (31, 1)
    assert got.where("eh_feriado").count() == 2
    assert got.where("mes = 1 and eh_dia_util").count() == 22
    month = marts.working_days(got).where("mes = 1").first()
    assert (month.dias_uteis, month.qtd_feriados, month.total_dias) == (22, 2, 31)


def test_client_merges_differ_in_who_wins(frame):
    one = frame("cod_cliente int, data_inclusao string, email string", [(1, "2021-01-01", "a"), (2, "2020-01-01", "b"), (3, "2020-01-01", "c")])
    two = frame("cod_cliente int, data_inclusao string, email string, uf string", [(1, "2020-01-01", "x", "SP"), (2, "2020-01-01", "y", "SP")])
    assert values(dimensions.merge_clients(one, two), "cod_cliente", "email", "uf") == [(1, "a", None), (2, "y", "SP"), (3, "c", None)]
    assert values(dimensions.last_loaded_clients(one, two), "cod_cliente", "email") == [(1, "x"), (2, "y"), (3, "c")]


def test_municipalities_take_their_own_newest_year(frame):
    places = frame("codigo_ibge string, municipio string, uf string", [("1", "A", "SP"), ("1", "A", "SP"), ("2", "B", "RS"), (None, "C", "RS")])
    people = frame("codigo_ibge string, ano string, populacao string", [("1", "2020", "9"), ("1", "2022", "5"), ("1", "2022", "7"), ("2", "2021", "3")])
    gdp = frame("codigo_ibge string, ano string, pib_total string, pib_per_capita string", [("1", "2021", "100", "12000.50")])
    got = dimensions.dim_municipality(places, people, gdp)
    assert values(got, "sk_municipio", "codigo_ibge", "populacao", "ano_populacao", "faixa_pib_per_cap") == [
        (1, 1, 7, 2022, "10-25k"), (2, 2, 3, 2021, ">50k")]


def test_linking_by_typed_names(frame):
    places = frame("sk_municipio long, municipio string, uf string", [(1, "São Paulo ", "SP"), (2, "Campinas", "SP")])
    dim = frame("k int, cidade string, uf string", [(1, " são paulo", "sp"), (2, "CAMPINAS", "MG"), (3, None, None)])
    assert values(dimensions.link_municipality(dim, places), "k", "sk_municipio") == [(1, 1), (2, None), (3, None)]


def test_constant_dimensions(spark):
    products = dimensions.dim_product(spark)
    assert products.count() == 28
    row = products.where("cod_produto = 'FUNDO_AV'").first()
    assert (row.indexador, row.risco, row.liquidez, row.garantia_fgc) == ("IBOV", "Alto", "D+30", False)
    assert products.where("garantia_fgc").count() == 5
    assert dimensions.dim_channel_seed(spark).where("not eh_digital").count() == 2
    assert dimensions.dim_score(spark).count() == 5


@pytest.fixture
def star(spark, frame, cal):
    clients = dimensions.with_validity(frame(
        "sk_cliente long, cod_cliente int, faixa_etaria string, score_credito int, sk_municipio long, data_inclusao date",
        [(1, 10, "18-24", 700, 1, day(2020, 1, 1)), (2, 20, "18-24", None, 1, day(2020, 1, 1)),
         (3, 30, "65+", 300, 2, day(2020, 1, 1)), (4, 40, "65+", 500, None, day(2020, 1, 1))]))
    branches = frame("sk_agencia long, cod_agencia int, nome string, tipo_agencia string, cidade string, uf string",
                     [(1, 5, "A", "F", "x", "SP"), (2, 7, "B", "F", "x", "SP")])
    staff = frame("sk_colaborador long, cod_colaborador int, primeiro_nome string, ultimo_nome string, cargo string, "
                  "eh_ativo boolean, sk_agencia_principal long",
                  [(1, 100, "Ana", "S", "G", True, 1), (2, 200, "Bia", "T", "G", True, None), (3, 300, "C", "U", "G", False, 1)])
    accounts = frame("num_conta int, cod_cliente int, cod_agencia int, cod_colaborador int, saldo_total decimal(14,2), "
                     "saldo_disponivel decimal(14,2), data_ultimo_lancamento date, eh_conta_ativa boolean",
                     [(1, 10, 5, 100, D("10"), D("1"), day(2024, 1, 5), True), (2, 10, 7, 100, D("20.01"), D("2"), None, True),
                      (3, 30, 7, 999, D("-5"), D("3"), day(2024, 1, 5), False), (4, 99, 7, 100, D("1000"), D("3"), day(2024, 1, 5), True)])
    fact = facts.fact_accounts(accounts, cal, clients, branches, staff, day(2024, 2, 1), all_active=False)
    return dict(cal=cal, clients=clients, branches=branches, staff=staff, accounts=accounts, fact=fact)


def test_account_fact(star):
    assert values(star["fact"], "num_conta", "sk_tempo", "sk_cliente", "sk_agencia", "sk_colaborador") == [
        (1, 5, 1, 1, 1), (2, 32, 1, 2, 1), (3, 5, 3, 2, None)]


@pytest.mark.parametrize("part", [None, 1, 1 << 20])
def test_transaction_fact_and_its_marts(frame, star, part):
    rows = [(1, 1, dt.datetime(2024, 1, 5, 10), "Pix", D("10"), "Pix", True), (2, 1, dt.datetime(2024, 1, 6), "TED", D("-30"), "TED", False),
            (3, 2, dt.datetime(2024, 2, 1), "Pix", D("5.50"), "Pix", True), (4, 77, dt.datetime(2024, 2, 1), "Pix", D("1"), "Pix", True),
            (5, 1, dt.datetime(2030, 2, 1), "Pix", D("1"), "Pix", True), (6, 4, dt.datetime(2024, 2, 1), "Pix", D("1"), "Pix", True)]
    tx = frame("cod_transacao long, num_conta int, data_transacao timestamp, nome_transacao string, valor_transacao decimal(14,2), "
               "canal string, flag_credito boolean", rows)
    channels = frame("sk_canal long, nome_canal string", [(1, "Pix")])
    arguments = (tx, star["cal"], star["accounts"], star["clients"], star["branches"], channels)
    fact = facts.fact_transactions(*arguments, part_rows=part)
    assert values(fact, "cod_transacao", "sk_tempo", "sk_cliente", "sk_agencia", "sk_canal") == [
        (1, 5, 1, 1, 1), (2, 6, 1, 1, None), (3, 32, 1, 2, 1)]
    assert facts.fact_transactions(*arguments, keep_unmatched=True, part_rows=part).count() == 6

    mix = marts.with_month_label(marts.mix_by_month(fact, star["cal"]))
    assert values(mix, "ano_mes", "nome_transacao", "volume_total", "pct_mix") == [
        ("2024-01", "Pix", D("10.00"), 50.0), ("2024-01", "TED", D("30.00"), 50.0), ("2024-02", "Pix", D("5.50"), 100.0)]
    by_value = marts.mix_by_month(fact, star["cal"], weight="value")
    assert values(by_value.where("mes = 1"), "nome_transacao", "pct_mix") == [("Pix", 25.0), ("TED", 75.0)]

    priced = star["cal"].withColumn("indice_ipca", F.expr(
        "case mes when 1 then 100 when 2 then 0 else 110 end").cast("decimal(10,2)"))
    real = marts.deflated_volume(fact, priced)
    assert values(real, "mes", "volume_nominal", "volume_real", "fator_correcao") == [
        (1, D("40.00"), D("44.00"), D("1.100000")), (2, D("5.50"), None, None)]
    without = priced.where("mes <> 3").withColumn("indice_ipca", F.expr("case when mes = 1 then indice_ipca end"))
    assert values(marts.deflated_volume(fact, without), "mes", "indice_base") == [(1, D("100.00"))]


def test_balances_and_ranking(star):
    balances = marts.balance_by_branch(star["fact"], star["branches"])
    assert values(balances, "cod_agencia", "qtd_contas", "saldo_total", "saldo_medio") == [
        (5, 1, D("10.00"), D("10.00")), (7, 1, D("20.01"), D("20.01"))]
    volumes = balances.select("cod_agencia").where("cod_agencia = 5").withColumn("volume_total", F.lit(1).cast("decimal(38,2)"))
    assert values(marts.branch_ranking(balances, volumes), "ranking", "cod_agencia", "volume_total") == [
        (1, 7, D("0.00")), (2, 5, D("1.00"))]


def test_staff_and_segments(frame, star):
    proposals = frame("sk_colaborador long, cod_proposta long, status_proposta string",
                      [(1, 1, "Aprovada"), (1, 1, "Enviada"), (1, 2, "Enviada"), (3, 9, "Aprovada")])
    got = marts.staff_portfolio(star["staff"], star["branches"], star["fact"], proposals)
    assert values(got, "cod_colaborador", "agencia", "qtd_contas_geridas", "saldo_gerido", "qtd_propostas", "propostas_aprovadas") == [
        (100, "A", 2, D("30.01"), 2, 1), (200, None, 0, D("0.00"), 0, 0)]
    segments = marts.client_segments(star["clients"], star["fact"])
    assert values(segments, "faixa_etaria", "qtd_clientes", "saldo_medio", "score_medio", "qtd_contas") == [
        ("18-24", 2, D("15.01"), D("700.00"), 2), ("65+", 2, None, D("400.00"), 0)]


def test_municipality_marts(frame, star):
    places = frame("sk_municipio long, municipio string, uf string, regiao string, populacao int, pib_per_capita decimal(14,2)",
                   [(1, "A", "SP", "Sudeste", 1000, D("10")), (2, "B", "RS", "Sul", 0, D("30")), (3, "C", "RS", "Sul", None, None)])
    tx = frame("sk_cliente long, valor_transacao decimal(14,2)", [(1, D("10")), (1, D("-4")), (3, D("1"))])
    got = marts.clients_by_municipality(places, star["clients"], tx)
    assert values(got, "municipio", "qtd_clientes", "penetracao_pct", "volume_transacoes", "ticket_medio") == [
        ("A", 2, 0.2, D("6.00"), D("3.00")), ("B", 1, None, D("1.00"), D("1.00")), ("C", 0, None, None, None)]
    proposals = frame("sk_cliente long, cod_proposta long, status_proposta string, valor_proposta decimal(14,2)",
                      [(1, 1, "Aprovada", D("10")), (2, 2, "Enviada", D("20")), (3, 3, "Aprovada", D("5")), (4, 4, "Aprovada", D("5"))])
    credit = marts.credit_by_region(places, star["clients"], proposals)
    assert values(credit, "regiao", "qtd_propostas", "propostas_aprovadas", "taxa_aprovacao_pct", "valor_medio_solicitado", "pib_per_capita_medio") == [
        ("Sudeste", 2, 1, 50.0, D("15.00"), D("10.00")), ("Sul", 1, 1, 100.0, D("5.00"), D("30.00"))]


def test_rates_and_quotes(frame):
    quotes = frame("at timestamp, bid decimal(10,4), ask decimal(10,4)", [
        (dt.datetime(2024, 1, 1, 9), D("1"), D("2")), (dt.datetime(2024, 1, 1, 17), D("5.0001"), D("5.0004")),
        (dt.datetime(2024, 1, 2, 9), D("1"), D("2"))])
    assert values(marts.last_quote_of_day(quotes, "at", "bid", "ask"), "data", "cotacao_media") == [
        (day(2024, 1, 1), D("5.0003")), (day(2024, 1, 2), D("1.5000"))]
    income = marts.income_per_head(frame("k int, renda decimal(14,2)", [(1, D("9"))]),
                                   frame("k int, pib_per_capita decimal(14,2)", [(1, D("120")), (2, D("120")), (3, None)]), "k")
    assert values(income, "k", "renda_media_per_capita", "fonte") == [
        (1, D("9.00"), "PUBLICADA"), (2, D("10.00"), "ESTIMATIVA"), (3, None, "ESTIMATIVA")]
