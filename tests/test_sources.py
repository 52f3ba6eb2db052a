import os

import pytest
from compare import values
from pyspark.sql import functions as F

from ledgerlake.sources import readers, writers
from ledgerlake.sources.tables import bank_specs, layout


def test_registry():
    specs = bank_specs()
    assert len(specs) == len({s.table for s in specs}) == 35
    assert {s.group for s in specs} == {"original", "sintetico", "externo"}
    assert layout("contas_sinteticas") == layout("contas") + ("flag_ativa",)
    assert layout("fraudes")[:2] == ("id_fraude", "cod_cliente") and layout("elsewhere") is None
    assert len(bank_specs("original")) == 7


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_text_csv_keeps_texts_and_drops_surplus_by_position(spark, tmp_path):
    path = str(tmp_path / "a" / "x.csv")
    write(path, 'k,name,more\r\n01,"a,""b""",z\r\n2,,\r\n', "utf-8-sig")
    assert readers.header_of(spark, path) == ["k", "name", "more"]
    assert values(readers.read_text_csv(spark, path, ["id", "nome"])) == [("01", 'a,"b"'), ("2", None)]
    assert readers.read_text_csv(spark, path).columns == ["k", "name", "more"]
    with pytest.raises(ValueError):
        readers.read_text_csv(spark, path, ["a", "b", "c", "d"])


def test_group_loading_leaves_missing_tables_empty(spark, tmp_path):
    root = str(tmp_path)
    write(f"{root}/data/original/colaborador_agencia.csv", "cod_colaborador,cod_agencia\n1,2\n")
    tables, absent = readers.load_group(spark, root, bank_specs("original"))
    assert len(tables) == 7 and len(absent) == 6 and "colaborador_agencia" not in absent
    assert tables["contas"].columns == [*layout("contas"), "_fonte", "_carga_ts"] and tables["contas"].isEmpty()
    row = tables["colaborador_agencia"].first()
    assert (row.cod_colaborador, row._fonte) == ("1", "original") and row._carga_ts is not None
    assert values(readers.row_counts(tables).where("linhas > 0")) == [("colaborador_agencia", 1)]


def test_required_inputs(spark, tmp_path):
    here = str(tmp_path / "a.csv")
    write(here, "x\n")
    readers.require_inputs(spark, [here])
    with pytest.raises(FileNotFoundError, match="b.csv"):
        readers.require_inputs(spark, [here, str(tmp_path / "b.csv")])


def test_full_refresh_is_idempotent_and_may_change_the_schema(frame, tmp_path):
    path = str(tmp_path / "t")
    assert writers.overwrite(frame("a int", [(1,), (2,)]), path).count() == 2
    assert writers.overwrite(frame("a int", [(1,), (2,)]), path).count() == 2
    assert writers.overwrite(frame("a int, b string", [(1, "x")]), path).columns == ["a", "b"]
    assert writers.append(frame("a int, b string", [(2, "y")]), path).count() == 2


def test_partitioned_refresh_drops_old_partitions(frame, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite(frame("a int, m string", [(1, "x"), (2, "y")]), path, ["m"])
    again = writers.overwrite(frame("a int, m string", [(3, "x")]), path, ["m"])
    assert values(again, "a", "m") == [(3, "x")]


def test_a_busy_partition_is_sorted_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    """A task sorts by rows, not by what a session takes packed bytes to hold; the rows of one value are parted."""
    monkeypatch.setattr(writers, "SORTED_ROWS", 50)
    path, rows = str(tmp_path / "t"), spark.range(2000).selectExpr("id", "if(id % 10 = 0, 'y', 'x') as m", "-id as v")
    dealt = writers.laid_out(rows, ["m"], 2000, ["id"])
    again = writers.overwrite(dealt.withColumn("size", -dealt["v"]), path, ["m"], placed=True)
    assert again.where("size = id").groupBy("m").count().orderBy("m").collect() == [("x", 1800), ("y", 200)]
    assert again.count() == again.distinct().count() == 2000
    files = [f for f in os.listdir(f"{path}/m=x") if f.startswith("part-")]
    assert 25 <= len(files) <= 45
    per_task = [r[1] for r in again.groupBy(F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).alias("task")).count().collect()]
    assert max(per_task) <= 150


def test_catalog_tables_and_layers(spark, frame):
    names = writers.create_layers(spark, "t_", ["bronze"])
    writers.save_table(frame("a int", [(1,)]), "t_bronze.x")
    assert writers.save_table(frame("b string", [("q",)]), "t_bronze.x").columns == ["b"]
    for name in names:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_insert_absent(frame):
    old = frame("k int, v string", [(1, "a")])
    new = frame("k int, v string", [(1, "z"), (2, "b"), (2, "c")])
    assert values(writers.insert_absent(old, new, ["k"])) == [(1, "a"), (2, "c")]


def test_upsert_changes_only_the_named_columns(frame):
    old = frame("k int, a int, b int", [(1, 1, 1), (2, 2, 2)])
    new = frame("k int, a int, b int", [(2, 20, 20), (3, 30, 30)])
    assert values(writers.upsert(old, new, ["k"], ["a"])) == [(1, 1, 1), (2, 20, 2), (3, 30, 30)]
    nulls = frame("k int, a int, b int", [(1, None, 5)])
    assert (1, None, 1) in values(writers.upsert(old, nulls, ["k"], ["a"]))


def test_snapshots(spark, frame, tmp_path):
    folder = str(tmp_path / "h")
    for day, v in (("2024-01-01", 1), ("2024-02-01", 2)):
        writers.write_snapshot(frame("a int", [(v,)]), folder, day)
    assert readers.snapshot_days(spark, folder) == ["2024-01-01", "2024-02-01"]
    assert readers.read_snapshot(spark, folder, "2024-01-31").first().a == 1
    assert readers.read_snapshot(spark, folder).first().a == 2
    with pytest.raises(FileNotFoundError):
        readers.read_snapshot(spark, folder, "2023-12-31")


def test_compaction_and_json(spark, frame, tmp_path):
    many, few, answers = (str(tmp_path / n) for n in ("many", "few", "json"))
    frame("a int", [(i,) for i in range(50)]).repartition(10).write.parquet(many)
    assert writers.compact(spark, many, few).count() == 50
    files = [f for f in os.listdir(few) if f.endswith(".parquet")]
    assert len(files) < 10
    writers.write_json(frame("a int, b string", [(1, "é")]), answers)
    assert values(spark.read.schema("a int, b string").json(answers)) == [(1, "é")]


def test_views(spark, frame):
    writers.publish_view(frame("a int", [(4,)]), "v_test")
    assert spark.sql("select a from v_test").first().a == 4
