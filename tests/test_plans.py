"""Shapes the physical plans must keep, with automatic broadcasts off so that nothing hides behind small data."""

import datetime as dt
import os

import pytest
from compare import DATA

from ledgerlake.operators import dimensions, facts, keys, marts
from ledgerlake.plans import catalog, warehouse
from ledgerlake.sources import writers

FOLDER = f"{DATA}/sf0.001"
catalog.load()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_no_query_multiplies_rows_or_runs_python(spark, no_auto_broadcast):
    for name, run in catalog.QUERIES.items():
        plan = physical(run(spark, FOLDER))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
            assert node not in plan, (name, node)


@pytest.fixture
def tx(frame):
    return frame("sk_tempo int, sk_cliente long, nome_transacao string, valor_transacao decimal(14,2)", [(1, 1, "Pix", None)])


def test_monthly_marts_reduce_the_fact_before_any_exchange(spark, tx, no_auto_broadcast):
    cal = dimensions.calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31)).withColumn("indice_ipca", marts.F.lit(1).cast("decimal(10,2)"))
    for df in (marts.mix_by_month(tx, cal), marts.deflated_volume(tx, cal)):
        plan = physical(df)
        # The tree is printed from the top: the fact's partial sums lie below the join with the calendar.
        assert plan.index("partial_sum(abs(valor_transacao") > plan.index("Join")


def test_latest_row_is_reduced_map_side(frame):
    plan = physical(keys.latest_per_key(frame("k int, at int, v int", [(1, 1, 1)]), ["k"], ["at"]))
    # The tree is printed from the top: the partial limit lies below the shuffle.
    assert plan.index("WindowGroupLimit", plan.index("Exchange hashpartitioning")) > 0 and "Partial" in plan


def test_latest_row_moves_each_column_once(frame):
    """Columns that settle ties are sorted as they are, not as a struct that repeats the row in sorts and shuffles."""
    rows = [(1, 1, "b", None), (1, 1, "b", 2), (1, 1, "a", 9), (2, None, "c", 1), (2, 0, None, 1), (None, 3, "d", 4)]
    latest = keys.latest_per_key(frame("k int, at int, name string, v int", rows), ["k"], ["at"])
    assert sorted(map(tuple, latest.collect()), key=repr) == [(1, 1, "b", 2), (2, 0, None, 1), (None, 3, "d", 4)]
    plan = physical(latest)
    assert "struct(" not in plan and "_w0" not in plan


def test_numbering_needs_no_one_task_window_over_rows(frame):
    numbered = keys.number_rows(frame("k int", [(3,), (1,)]), ["k"], "sk")
    plan = physical(numbered)
    assert plan.count("SinglePartition") == 1  # the per-partition counts
    assert "row_number" not in plan


def test_hot_lookup_reads_and_shuffles_the_rows_once(spark, tmp_path, frame, no_auto_broadcast):
    path = str(tmp_path / "fact")
    frame("k int, wide string", [(1, "x"), (1, "y"), (None, "z"), (2, "w")]).write.parquet(path)
    dim = frame("k int, name string", [(1, "a"), (2, "b")])
    joined = keys.lookup(spark.read.parquet(path), dim, "k", "left", 1)
    assert sorted(map(tuple, joined.collect()), key=repr) == [(1, "x", "a"), (1, "y", "a"), (2, "w", "b"), (None, "z", None)]
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("ReadSchema: struct<k:int,wide:string>") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path, frame):
    path = str(tmp_path / "contas")
    frame("sk_agencia long, num_conta int, saldo_total decimal(14,2), saldo_disponivel decimal(14,2), eh_conta_ativa boolean, other string",
          [(1, 1, None, None, True, "x")]).write.parquet(path)
    branches = frame("sk_agencia long, cod_agencia int", [(1, 7)])
    plan = physical(marts.balance_by_branch(spark.read.parquet(path), branches, labels=["cod_agencia"]))
    assert "EqualTo(eh_conta_ativa,true)" in plan
    assert "other" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_facts_store_no_raw_transactions(spark, monkeypatch):
    """Raw text is read once for the clean table, so it is not written first; the account shuffle moves keys only."""
    monkeypatch.setattr(catalog, "_LAYERS", {})
    bank = catalog.Bank(spark, FOLDER)
    gold = bank.gold["fato_transacoes"]
    assert gold.count() and "transacoes" in bank.silver._stored and "transacoes" not in bank.raw._stored
    clean = bank.silver["transacoes"]
    plan = physical(facts.fact_transactions(clean, bank.gold["dim_tempo"], bank.silver["contas"], bank.gold["dim_cliente"],
                                            bank.gold["dim_agencia"], bank.gold["dim_canal"]))
    assert plan.index("[num_conta") < plan.index("data_transacao")  # the day's key is there before rows move by account


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
@pytest.mark.parametrize("few", [False, True])
def test_the_fact_moves_by_month_without_what_is_computed_from_it(spark, monkeypatch, few):
    """Its measures and its stamp are added after the rows are dealt by month, whichever way they are dealt."""
    monkeypatch.setattr(catalog, "_LAYERS", {})
    monkeypatch.setattr(writers, "SORTED_ROWS", 100 if few else writers.SORTED_ROWS)
    bank, handed = catalog.Bank(spark, FOLDER), {}
    write = warehouse.overwrite

    def seen(df, path, *given, **named):
        handed[os.path.basename(path)] = (df, named)
        return write(df, path, *given, **named)

    monkeypatch.setattr(warehouse, "overwrite", seen)
    stored = bank.gold["fato_transacoes"]
    df, named = handed["fato_transacoes"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    above, dealt = physical(df).split("rangepartitioning(ano_mes" if few else "hashpartitioning(ano_mes", 1)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert named == {"placed": True} and "Exchange" not in above.rsplit("Exchange", 1)[0]
    for made in ("abs(valor_transacao", "_carga_ts"):
        assert made in above and made not in dealt
    plain = facts.fact_transactions(bank.silver["transacoes"], bank.gold["dim_tempo"], bank.silver["contas"], bank.gold["dim_cliente"],
                                    bank.gold["dim_agencia"], bank.gold["dim_canal"])
    assert stored.columns[:-2] == plain.columns
    assert stored.count() == plain.count() and stored.select(plain.columns).exceptAll(plain).isEmpty()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_facts_without_a_channel_read_no_transactions(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_LAYERS", {})
    bank = catalog.Bank(spark, FOLDER)
    assert bank.gold["fato_cartoes"].count()
    assert "dim_canal" not in bank.gold._stored and "transacoes" not in bank.silver._stored
    assert not {"cartoes", "transacoes"} & set(bank.raw._stored)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_channels_are_listed_without_storing_the_transactions(spark, monkeypatch):
    monkeypatch.setattr(catalog, "_LAYERS", {})
    bank = catalog.Bank(spark, FOLDER)
    listed = [r.nome_canal for r in bank.gold["dim_canal"].orderBy("sk_canal").collect()]
    assert "transacoes" not in bank.silver._stored and "transacoes" not in bank.raw._stored
    assert listed == [r.canal for r in bank.silver["transacoes"].select("canal").distinct().orderBy("canal").collect()]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_audits_read_each_table_once(spark):
    from ledgerlake.operators import findings, quality
    from ledgerlake.plans import queries_quality

    bank = catalog.Bank(spark, FOLDER)
    probes = [quality._probe(r) for r in quality.bank_rules()]
    checks = [quality._checked(c) for c in queries_quality._CHECKS]
    for tables, some in ((bank.raw, probes), (bank.silver, checks)):
        spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
        plan = physical(findings.findings(tables, some))
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        names = {p.table for p in some} | {p.parent for p in some if p.parent}
        for name in names:
            assert plan.count(f"/{name}]") == 1, name
        assert plan.count("Join") == 0 and plan.count("Exchange hashpartitioning") == 2
