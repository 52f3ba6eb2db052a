import datetime as dt

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.operators import quality as q
from ledgerlake.plans import golden


def test_rules_on_known_defects(frame):
    child = frame("k int, email string, at string", [
        (1, "a@x", "2020-01-01"), (1, "A@x", "2020-01-02"), (2, None, "2020-01-01"), (9, "b", "2021-01-01"), (9, "c", "2021-01-01"), (None, "", None)])
    parent = frame("k int, opened string", [(1, "2020-01-02"), (2, "2019-01-01")])
    series = frame("d string", [("2020-01-10",), ("2020-01-14",), ("2020-03-01",), ("2020-03-01",)])
    rules = [
        q.RowRule("child", "email", "empty", "WARNING", F.col("email").isNull() | (F.col("email") == "")),
        q.RowRule("child", "k", "big", "ERROR", F.col("k") > 5, F.col("email")),
        q.DuplicateRule("child", "email", "same text", "ERROR"),
        q.DuplicateRule("child", "email", "same folded", "ERROR", fold=True, sample=True),
        q.OrphanRule("child", "k", "lost rows", "ERROR", "parent"),
        q.OrphanRule("child", "k", "lost keys", "ERROR", "parent", distinct=True),
        q.BeforeParentRule("child", "at", "too early", "ERROR", "k", "parent", "opened"),
        q.MissingMonthRule("series", "d", "months", "ERROR", dt.date(2020, 1, 1), dt.date(2020, 4, 1)),
        q.GapRule("series", "d", "gaps", "WARNING", 5),
    ]
    log = q.audit({"child": child, "parent": parent, "series": series}, rules)
    assert values(log, "regra", "qtd_registros", "amostra") == sorted([
        ("empty", 2, None), ("big", 2, "b | c"), ("same text", 0, None), ("same folded", 1, "a@x"), ("lost rows", 3, None),
        ("lost keys", 1, None), ("too early", 1, None), ("months", 2, None), ("gaps", 1, None)], key=repr)
    card = q.scorecard(log)
    assert values(card, "tabela", "severidade", "qtd_regras_violadas", "total_registros_afetados", "registros_em_aberto") == [
        ("child", "ERROR", 5, 8, 8), ("child", "WARNING", 1, 2, 2), ("series", "ERROR", 1, 2, 2), ("series", "WARNING", 1, 1, 1)]
    resolved = q.scorecard(log.withColumn("status", F.lit("RESOLVIDO")))
    assert {r.registros_em_aberto for r in resolved.collect()} == {0}


def test_samples_hold_the_first_five(frame):
    df = frame("v string", [(f"x{i}",) for i in range(9, 0, -1)])
    rule = q.RowRule("t", "v", "all", "ERROR", F.lit(True), F.col("v"))
    assert q.audit({"t": df}, [rule]).first().amostra == "x1 | x2 | x3 | x4 | x5"


def test_column_checks(frame):
    tables = {"a": frame("k int, s string", [(1, "x"), (1, "y"), (2, None), (None, "x")]), "b": frame("k int", [(1,)])}
    checks = [q.ColumnCheck("a", "k", "not_null"), q.ColumnCheck("a", "k", "unique"),
              q.ColumnCheck("a", "s", "accepted_values", ("x",)), q.ColumnCheck("a", "k", "relationships", to="b")]
    assert values(q.column_checks(tables, checks), "teste", "falhas") == [
        ("accepted_values", 1), ("not_null", 1), ("relationships", 1), ("unique", 1)]
    with pytest.raises(ValueError):
        q.column_checks(tables, [q.ColumnCheck("a", "k", "even")])


def test_expectations_report_or_stop(frame):
    df = frame("k int, v int", [(1, 5), (2, None), (None, -1)])
    soft, hard = q.Expectation("v positive", "v > 0"), q.Expectation("k given", "k IS NOT NULL", fatal=True)
    assert values(q.expectation_report(df, [soft, hard]), "expectativa", "falhas") == [("k given", 1), ("v positive", 2)]
    assert q.expect(df, [soft]) is df
    with pytest.raises(q.QualityError, match="k given: 1 of 3"):
        q.expect(df, [soft, hard])


def test_empty_sources_stop_the_run(frame):
    with pytest.raises(q.QualityError):
        q.require_rows(frame("a int", []), "a")
    assert q.require_rows(frame("a int", [(1,)]), "a").count() == 1


def test_reconciliation(frame):
    schema = "kpi string, campo string, valor double"
    actual = frame(schema, [("a", "x", 100.0), ("a", "y", 100.0), ("a", "z", 1.0)])
    expected = frame(schema, [("a", "x", 100.02), ("a", "y", 100.5), ("a", "w", 1.0)])
    got = q.reconcile(actual, expected, 0.03)
    assert values(got, "campo", "situacao") == [("w", "FALHOU"), ("x", "APROVADO"), ("y", "FALHOU"), ("z", "FALHOU")]
    wide = q.reconcile(actual, expected, 0.03, relative=0.01).where("campo in ('x', 'y')")
    assert q.require_passed(wide) is wide
    with pytest.raises(q.QualityError):
        q.require_passed(got)


def test_golden_totals_pass_and_fail(spark, frame):
    marts = {
        "kpi1": frame("saldo_total double", [(1.0,), (2.0,)]),
        "kpi2_3": frame("volume_total double", [(5.0,)]),
        "kpi4": frame("status_proposta string, qtd_propostas long", [("b", 9), ("a", 3)]),
        "kpi5": frame("cod_agencia int, ranking int", [(4, 2), (8, 1)]),
        "kpi6": frame("saldo_gerido double", [(3.0,)]),
        "kpi7": frame("faixa_etaria string, qtd_clientes long", [("18-24", 2)]),
        "kpi8": frame("volume_nominal double", [(5.0,)]),
    }
    totals = golden.actual_totals(marts)
    assert ("kpi4", "contagem_1", 3.0) in values(totals) and ("kpi5", "primeira_agencia", 8.0) in values(totals)
    assert {r.situacao for r in golden.golden_check(marts, totals).collect()} == {"APROVADO"}
    exact = golden.golden_check(marts, totals.withColumn("valor", F.col("valor") * 1.009).withColumns({"tolerancia": F.lit(0.0), "relativa": F.lit(0.01)}))
    assert {r.situacao for r in exact.collect()} == {"APROVADO"}
    rules = {(r.kpi, r.campo): (r.tolerancia, r.relativa) for r in golden.expected_totals(spark).collect()}
    assert rules["kpi6", "saldo_gerido"] == (0.1, 0.01) and rules["kpi4", "contagem_1"] == (0.0, 0.0) and ("kpi2_3", "qtd_linhas") in rules
    published = golden.golden_check(marts, golden.expected_totals(spark))
    assert published.where("situacao = 'APROVADO'").count() == 0 and published.count() == 19
