import importlib
import os

import pytest

import corpus_pipeline
from ledgerlake.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_planted_cases(spark, tmp_path, frame):
    calm = "the river runs under an old bridge and people walk there every day with their dogs while boats go by"
    passage = "seven quick wizards mixed nine odd potions behind twelve broken clocks near our village square"
    rows, labels = [], []
    for i in range(400):
        text = f"{calm} {i}. " + " ".join(f"w{i}x{k}" for k in range(40))
        toxic = i % 5 == 0
        rows.append((i, text + (" you dolt." if toxic else ""), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    rows += [
        (1000, rows[1][1] + " more", "en", "s", 0),
        (1001, "many more words stand before " + passage.upper() + " and after it there are others", "en", "s", 0),
        (1002, passage, "en", "s", 0),
        (1003, 'key token = "cb1a9fee807a05366fcb8b6c95c7c565ede51a72" end', "en", "s", 0),
        (1004, None, None, None, None),
    ]
    frame("doc_id long, text string, lang string, source string, n_chars long", rows).write.parquet(f"{tmp_path}/documents.parquet")
    frame("doc_id long, quality int, toxic int", labels).write.parquet(f"{tmp_path}/labels.parquet")
    frame("item_id long, text string", [(1, passage)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert docs.columns == columns
            docs.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
            kept[name] = {r.doc_id: r for r in docs.collect()}
    calm_ids = {i for i in range(400) if i % 5} | {1000, 1001, 1002, 1003, 1004}
    assert set(kept["toxicity"]) == calm_ids
    assert set(kept["near_dedup"]) == calm_ids - {1000}
    assert set(kept["decontamination"]) == calm_ids - {1000, 1002}
    assert kept["decontamination"][1001].text == "many more words stand before  and after it there are others"
    assert kept["decontamination"][1001].n_chars == 59
    assert kept["decontamination"][7].text == rows[7][1]
    assert kept["secrets"][1003].text == 'key [SECRET]" end' and kept["secrets"][1004].text is None
    sequences = docs.collect()
    assert {p.doc_id for r in sequences for p in r.pieces} == calm_ids - {1000, 1002}


def test_near_copies_under_shared_and_missing_ids(spark, frame):
    copy = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    lone = " ".join(f"u{k}" for k in range(60))
    rows = [(5, copy, "en")] * 3 + [(None, copy, "en"), (9, copy + " more", "en"), (None, other, "en"), (None, other + " more", "en"), (5, lone, "de"), (None, None, "fr"), (None, None, "fr")]
    got = corpus_pipeline.near_dedup(spark, frame("doc_id long, text string, lang string", rows), "").collect()
    kept = sorted((r.doc_id or 0, (r.text or "")[:2], r.lang) for r in got)
    assert kept == [(0, "", "fr"), (0, "", "fr"), (0, "v0", "en"), (5, "u0", "de"), (5, "w0", "en")]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_run_on_supplied_tables(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    assert all(len(r.ids) == 4096 for r in rows[:-1])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="supplied tables not found")
def test_every_query_is_registered_and_matches_its_sql(spark):
    import duckdb

    entry = importlib.import_module("__spark_entry__")
    names = [next(q for q in queries.QUERIES if q.startswith(f"op{n}_")) for n in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    for name, sql in queries.ANSWERS.items():
        df = queries.QUERIES[name](spark, FOLDER)
        cursor = connection.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert sorted(map(repr, cursor.fetchall())) == sorted(repr(tuple(r)) for r in df.select(columns).collect())
