import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import dates, finance, rules
from ledgerlake.functions import text as t


def column(spark, expression, values, kind="string"):
    """The expression over a column named v, in the order of the values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", expression.alias("o")).orderBy("i").collect()]


NUMBERS = ["12.50", "-3", "12.", "1e3", "+5", " 7", "", None, "abc", "12.345", "99999999999999999"]


def test_strict_numbers_follow_the_pattern(spark):
    d = Decimal
    assert column(spark, t.strict_decimal("v"), NUMBERS) == [
        d("12.50"), d("-3.00"), d("12.00"), None, None, None, None, None, None, d("12.35"), None]
    assert column(spark, t.strict_decimal("v", signed=False), ["-3", "4"]) == [None, d("4.00")]


def test_tolerant_numbers_take_what_parses(spark):
    assert column(spark, t.to_decimal("v"), ["1e3", "+5", " 7", "x"]) == [
        Decimal("1000.00"), Decimal("5.00"), Decimal("7.00"), None]


def test_comma_decimals_and_marked_counts(spark):
    assert column(spark, t.comma_decimal("v", 10, 2), ["1,50", "-", "null", "", "2.25", None, "x"]) == [
        Decimal("1.50"), None, None, None, Decimal("2.25"), None, None]
    assert column(spark, t.marked_count("v"), ["1 234", "...", "X", "-", "", "7", None]) == [
        1234, None, None, None, None, 7, None]


def test_mixed_instants_move_to_utc(spark):
    texts = ["2020-01-01 10:00:00+02:00", "2020-01-01T10:00:00Z", "2020-01-01 10:00:00 UTC", "01/02/2020",
             "01/02/2020 03:04:05", "2020-01-01", "20200203", "zz", None]
    at = dt.datetime
    assert column(spark, t.mixed_instant("v"), texts) == [
        at(2020, 1, 1, 8), at(2020, 1, 1, 10), at(2020, 1, 1, 10), at(2020, 2, 1), at(2020, 2, 1, 3, 4, 5),
        at(2020, 1, 1), at(2020, 2, 3), None, None]


def cpf_by_hand(text):
    if text is None:
        return None
    d = [int(c) for c in text if c.isdigit()]
    if len(d) != 11 or len(set(d)) == 1:
        return False
    for n in (9, 10):
        rest = 11 - sum(d[i] * (n + 1 - i) for i in range(n)) % 11
        if d[n] != (0 if rest >= 10 else rest):
            return False
    return True


def test_cpf_known_cases(spark):
    texts = ["529.982.247-25", "52998224725", "529.982.247-26", "111.111.111-11", "123", "", None]
    assert column(spark, t.valid_cpf("v"), texts) == [True, True, False, False, False, False, None]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789.-x", min_size=9, max_size=14), min_size=40, max_size=60))
def test_cpf_matches_a_plain_loop(spark, texts):
    digits = ["".join(c for c in x if c.isdigit())[:9].ljust(9, "3") for x in texts]
    completed = []
    for nine in digits:  # complete every other one with right check digits
        d = [int(c) for c in nine]
        for n in (9, 10):
            rest = 11 - sum(d[i] * (n + 1 - i) for i in range(n)) % 11
            d.append(0 if rest >= 10 else rest)
        completed.append("".join(map(str, d)))
    everything = texts + completed
    assert column(spark, t.valid_cpf("v"), everything) == [cpf_by_hand(x) for x in everything]


def test_cep_truth_and_blanks(spark):
    assert column(spark, t.valid_cep("v"), ["01310-100", "0131010", None]) == [True, False, None]
    assert column(spark, t.truthy("v"), ["True", "true", "1", "t", "False", "yes", None]) == [
        True, True, True, True, False, False, None]
    assert column(spark, t.blank_to_null("v"), ["", "a", None]) == [None, "a", None]


def age_by_hand(birth, on):
    return None if birth is None else on.year - birth.year - ((on.month, on.day) < (birth.month, birth.day))


@pytest.mark.parametrize("on", [dt.date(2025, 2, 28), dt.date(2025, 3, 1), dt.date(2026, 6, 10)])
def test_ages_around_birthdays(spark, on):
    births = [dt.date(2004, 2, 29), dt.date(2000, 6, 10), dt.date(2000, 6, 11), dt.date(1888, 1, 1), None]
    assert column(spark, dates.age_years("v", on), births, "date") == [age_by_hand(b, on) for b in births]


def test_bands(spark):
    assert column(spark, rules.age_band("v"), [17, 18, 24, 25, 64, 65, 130, None], "int") == [
        "Menor", "18-24", "18-24", "25-34", "55-64", "65+", "65+", "Menor"]
    assert column(spark, rules.score_band("v"), [0, 300, 301, 1000, 1001, -1], "int") == [
        "Muito Baixo", "Muito Baixo", "Baixo", "Excelente", "Inválido", "Inválido"]
    assert column(spark, rules.income_band("v"), [1999.99, 2000.0, 9999.0, 20000.0], "double") == [
        "<2k", "2-5k", "5-10k", ">20k"]
    assert column(spark, rules.arrears_bucket("v"), [30, 31, 60, 90, 91], "int") == ["0-30", "31-60", "31-60", "61-90", "90+"]
    assert column(spark, rules.risk_grade("v"), [30, 31, 91, 181], "int") == ["Baixo", "Médio", "Alto", "Crítico"]


def test_channels_take_the_first_match_and_keep_accents(spark):
    names = ["Pix - Realizado", "TED", "pix por TED", "DOC", "Compra Crédito", "COMPRA CREDITO", "outra", None]
    assert column(spark, rules.channel_of("v"), names) == [
        "Pix", "TED", "Pix", "DOC", "Outros", "Compra Credito", "Outros", "Outros"]
    assert column(spark, rules.service_channel_of("v"), ["App", "Agencia 1", "Debito Automatico", None]) == [
        "Aplicativo Movel", "Agencia", "Debito Automatico", "Outros"]
    assert column(spark, rules.channel_family("v"), ["Pix", "Saque", "Outros"]) == ["Transferencia", "Caixa", "Digital"]


def test_every_state_has_its_region_and_the_rest_fall_back(spark):
    pairs = [(s, r) for r, states in rules.STATES.items() for s in states]
    assert len(pairs) == 27
    assert column(spark, rules.region_of("v"), [s.lower() for s, _ in pairs]) == [r for _, r in pairs]
    assert column(spark, rules.region_of("v"), ["XX", None]) == ["Sudeste", "Sudeste"]


def test_weekdays_in_month_by_counting(spark):
    months = [dt.date(y, m, 15) for y in range(2019, 2027) for m in range(1, 13)]

    def count(d):
        day, n = d.replace(day=1), 0
        while day.month == d.month:
            n += day.weekday() < 5
            day += dt.timedelta(days=1)
        return n

    assert column(spark, dates.weekdays_in_month("v"), months, "date") == [count(m) for m in months]


def test_money(spark):
    one = spark.range(1)

    def value(expression):
        return one.select(expression.alias("o")).first().o

    money = lambda x: F.lit(Decimal(x))
    assert value(finance.annuity(money("1000.00"), F.lit(0.01), F.lit(12))) == pytest.approx(88.85)
    assert value(finance.annuity(money("1000.00"), F.lit(0.0), F.lit(12))) is None
    assert value(finance.utilisation_pct(money("50.00"), money("200.00"))) == Decimal("25.00")
    assert value(finance.utilisation_pct(money("50.00"), money("0.00"))) == 0
    assert value(finance.in_dollars(money("10.00"), money("0.0000"))) is None
    assert value(finance.in_dollars(money("10.00"), money("4.0000"))) == Decimal("2.50")
    assert value(finance.maturity_status(F.lit(None).cast("date"), "2026-05-31")) == "Ativo"
    assert value(finance.maturity_status(F.lit("2026-05-31").cast("date"), "2026-05-31")) == "Vencido"
    assert value(finance.share_pct(F.lit(1), F.lit(0))) is None
    assert value(finance.margin(money("5.00"), F.lit(None).cast("decimal(14,2)"))) == Decimal("5.00")
