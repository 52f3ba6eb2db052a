import os
from decimal import Decimal

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.functions import sql as functions
from ledgerlake.functions import rules
from ledgerlake.functions import text as t
from ledgerlake.operators import cleaning
from ledgerlake.operators.quality import Expectation, QualityError
from ledgerlake.operators.ranges import with_band
from ledgerlake.sources import readers, writers

D = Decimal


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


ROWS = "m string, k int, v int, w string"


def test_only_touched_partitions_are_rewritten(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    writers.overwrite(frame(ROWS, [("a", 1, 1, "x"), ("a", 2, 2, "x"), ("b", 1, 3, "x"), ("c", 1, 4, "x")]), path, ["m"])
    before = files(path)
    writers.merge_partitions(path, frame(ROWS, [("a", 2, 20, "y"), ("a", 3, 30, "y"), ("d", 1, 40, "y"), ("d", 1, 39, "y")]), ["m", "k"], ["m"], ["v"])
    after = files(path)
    assert {f for f in before if "/m=b/" in f or "/m=c/" in f} <= after
    assert not {f for f in before if "/m=a/" in f} & after
    held = spark.read.schema(ROWS).parquet(path)
    assert values(held, "m", "k", "v", "w") == [("a", 1, 1, "x"), ("a", 2, 20, "x"), ("a", 3, 30, "y"), ("b", 1, 3, "x"), ("c", 1, 4, "x"), ("d", 1, 40, "y")]
    writers.merge_partitions(path, frame(ROWS, [("b", 1, 99, "z"), ("b", 2, 98, "z")]), ["m", "k"], ["m"], [])  # nothing to update: known keys stay
    assert values(spark.read.schema(ROWS).parquet(path).where("m = 'b'"), "k", "v") == [(1, 3), (2, 98)]


def test_merges_are_refused(frame, tmp_path):
    path = f"{tmp_path}/t"
    writers.overwrite(frame(ROWS, [("a", 1, 1, "x")]), path, ["m"])
    with pytest.raises(ValueError):
        writers.merge_partitions(path, frame(ROWS, []), ["k"], ["m"], ["v"])
    with pytest.raises(QualityError):
        writers.merge_partitions(path, frame(ROWS, [(None, 1, 1, "x")]), ["m", "k"], ["m"], ["v"])


def test_the_touched_partitions_prune_the_scan(spark, frame, tmp_path):
    path, schema = f"{tmp_path}/t", "m string, n int, k int"
    writers.overwrite(frame(schema, [(f"p{i}", i % 3, i) for i in range(20)]), path, ["m", "n"])
    touched = frame(schema, [("p3", 0, 9), ("p4", 1, 9), ("p4", 1, 8), ("p4", 0, 8)])
    held = writers.in_partitions_of(spark.read.schema(schema).parquet(path), touched, ["m", "n"])
    assert values(held) == [(3, "p3", 0), (4, "p4", 1)] or values(held, "m", "n", "k") == [("p3", 0, 3), ("p4", 1, 4)]
    assert "PartitionFilters: [" in (plan := held._jdf.queryExecution().executedPlan().toString()) and "IN (p3,p4)" in plan


def test_gates_publish_only_what_passed(spark, frame, tmp_path):
    soft, hard = Expectation("v positive", "v > 0"), Expectation("k given", "k IS NOT NULL", fatal=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS gates")
    report = writers.write_gated(frame("k int, v int", [(1, 5), (2, None)]), f"{tmp_path}/g", "gates.t", [soft, hard])
    assert [(r["expectativa"], r["falhas"], r["linhas"]) for r in report] == [("v positive", 1, 2), ("k given", 0, 2)]
    with pytest.raises(QualityError, match="k given: 1 of 1") as raised:
        writers.write_gated(frame("k int, v int", [(None, 5)]), f"{tmp_path}/g", "gates.t", [soft, hard])
    assert raised.value.report[1]["falhas"] == 1 and spark.table("gates.t").count() == 2
    writers.write_gated(frame("k int, v int", [(7, 7)]), f"{tmp_path}/g", "gates.t", [hard])
    assert values(spark.table("gates.t")) == [(7, 7)]
    assert writers.write_gated(frame("k int, v int", []), f"{tmp_path}/g", "gates.t", [hard])[0]["linhas"] == 0


def test_bands_by_edges(frame):
    bands = frame("name string, lo decimal(10,2), hi decimal(10,2)", [("low", None, D("10.50")), ("mid", D("10.50"), D("20.00")), ("odd", D("15.00"), D("15.10")), ("top", D("100.00"), None)])
    got = with_band(frame("v double", [(-1e9,), (10.49,), (10.5,), (15.05,), (20.0,), (99.99,), (100.0,), (1e12,), (None,)]), "v", bands, "lo", "hi")
    assert values(got, "v", "name") == sorted([
        (-1e9, "low"), (10.49, "low"), (10.5, "mid"), (15.05, "mid"), (15.05, "odd"), (20.0, None), (99.99, None), (100.0, "top"), (1e12, "top"), (None, None)], key=repr)
    closed = with_band(frame("v int, name string", [(10, "own"), (11, "own"), (9, "own")]), "v", frame("lo int, hi int", [(10, 10)]), "lo", "hi", "inner", closed=True)
    assert values(closed, "v", "lo") == [(10, 10)]
    assert with_band(frame("v int", [(1,)]), "v", frame("lo int, hi int", []), "lo", "hi").count() == 1


def test_bands_against_plain_comparison(spark, frame):
    import random

    rng = random.Random(3)
    bands = [(i, *sorted((rng.uniform(0, 100), rng.uniform(0, 100)))) for i in range(30)]
    numbers = [(rng.uniform(-20, 120),) for _ in range(400)]
    got = with_band(frame("v double", numbers), "v", frame("i int, lo double, hi double", bands), "lo", "hi", "inner")
    assert values(got, "v", "i") == sorted(((v, i) for (v,) in numbers for i, lo, hi in bands if lo <= v < hi), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = with_band(frame("v double", numbers), "v", frame("i int, lo double, hi double", bands), "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "_bucket" in plan


def test_sql_functions_agree_with_the_columns(spark, frame):
    functions.register_functions(spark, "rules_in_sql")
    cpfs = [("529.982.247-25",), ("52998224725",), ("529.982.247-24",), ("111.111.111-11",), ("123",), ("",), (None,), ("000.000.001-91",)]
    rows = frame("c string", cpfs)
    assert values(rows.selectExpr("rules_in_sql.valida_cpf(c) AS a")) == values(rows.select(t.valid_cpf("c")))
    ceps = frame("c string", [("12345-678",), ("1234567",), (None,), ("a1b2c3d4e5f6g7h8",)])
    assert values(ceps.selectExpr("rules_in_sql.valida_cep(c) AS a")) == values(ceps.select(t.valid_cep("c")))
    scores = frame("s double", [(-1.0,), (0.0,), (300.0,), (300.5,), (301.0,), (1000.0,), (1001.0,), (None,)])
    assert values(scores.selectExpr("rules_in_sql.faixa_score(s) AS a")) == values(scores.select(rules.score_band("s")))
    births = frame("d string", [("2008-06-10",), ("2008-06-11",), ("1961-06-10",), ("2000-02-29",), (None,)])
    assert values(births.selectExpr("rules_in_sql.faixa_etaria(TRY_CAST(d AS DATE)) AS a")) == sorted([("18-24",), ("Menor de idade",), ("65+",), ("25-34",), ("Menor de idade",)])
    assert births.selectExpr("rules_in_sql.faixa_etaria(DATE'2000-02-29', DATE'2018-02-28') AS a").first().a == "Menor de idade"


def test_rejected_records(spark, tmp_path):
    text = '﻿a,b,c\n1,"x\n""y"", z",2\n3,4\n5,6,7,8\n9,"q",\n,,\n"open,1,2'
    (tmp_path / "f.csv").write_bytes(text.encode())
    rows, rejected = readers.read_with_rejects(spark, f"{tmp_path}/f.csv", ["a", "b", "c"], line_breaks=True)
    assert ("1", 'x\n"y", z', "2") in values(rows) and ("9", "q", None) in values(rows)
    found = {r.registro: (r.campos, r.motivo) for r in rejected.collect()}
    assert found["3,4"] == (2, "faltam campos") and found["5,6,7,8"] == (4, "sobram campos") and len(found) == 3
    assert rows.count() + rejected.count() == 6
    plain, broken = readers.read_with_rejects(spark, f"{tmp_path}/f.csv", ["a", "b", "c"])
    assert broken.count() == 4 and plain.columns == ["a", "b", "c"]


def test_tables_in_equal_buckets_are_joined_where_they_lie(spark, frame, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = (writers.save_bucketed(frame(f"k int, {c} int", [(i % 7, i) for i in range(50)]), f"buckets.{c}", f"{tmp_path}/{c}", "k", 4) for c in "xy")
        joined = a.join(b, "k").groupBy("k").agg(F.sum("x").alias("s"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 7
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert writers.buckets_for(0, 24, 8) == 8 and writers.buckets_for(10**9, 256) == 1908


def test_folded_names(frame):
    df = frame("n string", [("COMPRA CRÉDITO",), ("Depósito",), ("cafe",), (None,)])
    assert values(df, "n", rules.folded_channel_of("n").alias("c")) == sorted([("COMPRA CRÉDITO", "Compra Credito"), ("Depósito", "Deposito Especie"), ("cafe", "Outros"), (None, "Outros")], key=repr)
    assert values(df, rules.channel_of("n").alias("c")) == [("Outros",)] * 4


def test_variants_of_unknown_layout(frame):
    rows = [('{"id":1,"nome":"A","microrregiao":{"mesorregiao":{"UF":{"sigla":"X","nome":"Xis","regiao":{"sigla":"N"}}}}}',),
            ('{"id":2,"nome":"B","microrregiao":null,"regiao-imediata":{"regiao-intermediaria":{"UF":{"sigla":"Y","extra":[1]}}}}',), ("not json",), (None,), ('{"id":"z"}',)]
    got = values(cleaning.variant_places(frame("value string", rows)))
    assert got == sorted([(1, "A", "X", "Xis", "Norte", "N"), (2, "B", "Y", None, None, None), (None, None, None, None, None, None)], key=repr)
    answer = '[{"resultados":[{"series":[{"localidade":{"id":"7","nome":"P"},"serie":{"2020":"1","2021":"..."}}]},{"series":[]}]}]'
    assert values(cleaning.variant_series(frame("value string", [(answer,), ("[]",), ("{}",)]))) == [("7", "P", "2020", "1"), ("7", "P", "2021", "...")]
