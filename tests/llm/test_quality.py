import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import quality
from ledgerlake.llm.quality import Leader, Model, held_out, scored, scores, train, vectors
from ledgerlake.llm.text import text_bytes

GOOD = "the river runs under an old bridge and people walk there every day with their dogs".split()


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(GOOD) for _ in range(rng.randrange(4, 60))]
        kind = rng.choice(["", "", "", "", "shout", "marks", "again"])
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        elif kind == "marks":
            words = [w + rng.choice(["***", "$$$"]) for w in words]
        elif kind == "again":
            words = [w for w in words for _ in range(6)]
        docs.append((i, " ".join(words) + ".", "x"))
        labels.append((i, int(not kind), 0))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return d, marks, {i: q for i, q, _ in labels}, train(d, marks, ~held_out(F.col("doc_id")))


def test_held_out_documents(learnt):
    d, _, truth, model = learnt
    rows = scored(d, model).select("row.doc_id", F.col("score").alias("p"), "predicted").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert 100 < len(held) < 180 and all(0 <= r.p <= 1 and r.predicted == int(r.p >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def plain_counts(text):
    pieces = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff \t\n\v\f\r]+", text)
    signs = ["\0" if i and p == pieces[i - 1] else p for i, p in enumerate(pieces)]
    return Counter(tuple(signs[i : i + n]) for n in range(1, quality.ORDER + 1) for i in range(len(signs) - n + 1))


def test_vectors_against_plain_counting():
    rng = random.Random(3)
    made = [" ".join(rng.choice(["a", "a", "bb", "b!!", "***", "é", "x,y", "\n"]) for _ in range(rng.randrange(200))) for _ in range(40)]
    texts = ["", None, "  \n", "one", "a a a b!!! b !!", "é,é é", "x" * 50, "!!a", "a", "a", *made]
    text, place, value = vectors(*text_bytes(pa.array(texts)))
    for k, t in enumerate(texts):
        counts = plain_counts(t or "")
        own = sorted(value[text == k])
        raw = sorted(1 + math.log(c) for c in counts.values())
        assert np.allclose(own, [r / math.sqrt(sum(x * x for x in raw)) for r in raw])  # no collisions among so few
        assert len(set(place[text == k])) == len(counts)


def test_long_texts_in_steps_are_the_same():
    rng = random.Random(5)
    for seed in range(30):
        t = "".join(rng.choice(["a ", "a ", "b", " !! ", "\n", "cc dd ", "x" * 9]) for _ in range(rng.randrange(1, 300)))
        data, offsets = text_bytes(pa.array([t]))
        for step in (1, 7, 50):
            for a, b in zip(vectors(data, offsets), vectors(data, offsets, step), strict=True):
                assert np.allclose(a, b), (seed, step)


def test_ftrl_against_plain_updates():
    rng = np.random.default_rng(2)
    leader, z, n, w = Leader(np.zeros(6), np.zeros(6)), [0.0] * 6, [0.0] * 6, [0.0] * 6
    for _ in range(80):
        at, value, label = rng.choice(6, 3, replace=False), rng.random(3), int(rng.random() < 0.4)
        leader.learn(at, value, label)
        for i in at:
            w[i] = 0.0 if abs(z[i]) <= quality.L1 else -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at, value, strict=True))))
        for i, v in zip(at, value, strict=True):
            g = (p - label) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n) and np.any(leader.weights() != 0)


def test_scores_are_sparse_dot_products():
    rng = np.random.default_rng(4)
    model = Model(rng.normal(size=(1 << quality.BITS) + 1), shift=0.25)
    texts = ["the river", "", None, "THE RIVER!! !! !!"]
    got = scores(model, *text_bytes(pa.array(texts)))
    for k, t in enumerate(texts):
        _, place, value = vectors(*text_bytes(pa.array([t])))
        assert math.isclose(got[k], 1 / (1 + math.exp(-(float(model.weights[place] @ value) + model.weights[-1] + 0.25))))


def test_odd_rows(learnt, frame):
    _, _, _, model = learnt
    rows = [(None, None), (1, ""), (1, ""), (2, " \n"), (3, "the! " * 300_000), (4, "é")]
    got = scored(frame("doc_id long, text string", rows), model).select("row.doc_id", "score", "predicted").collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id in (None, 1, 2)}) == 1
    assert scored(frame("doc_id long, text string", []), model).count() == 0
    clash = frame("doc_id long, text string, row int, score string, predicted int, at int", [(1, "the river", 1, "s", 2, 3)])
    assert scored(clash, model).select("row.*").columns == clash.columns


def test_without_labels_of_both_kinds(frame):
    docs = frame("doc_id long, text string", [(1, "a"), (2, "b")])
    for labels, share in (([], 0.0), ([(1, None)], 0.0), ([(1, 1), (1, 0), (2, 1)], 1.0)):
        model = train(docs, frame("doc_id long, quality int", labels), F.lit(True))
        assert {r.score for r in scored(docs, model).collect()} == {share}


def test_the_model_depends_neither_on_partitions_nor_on_repeated_rows(learnt):
    d, marks, truth, model = learnt
    hot = d.filter(~held_out(F.col("doc_id"))).orderBy("doc_id").limit(1)
    again = d.unionByName(hot.crossJoin(d.sparkSession.range(300)).drop("id")).repartition(7)
    other = train(again, marks.repartition(3), ~held_out(F.col("doc_id")))
    assert np.array_equal(other.weights, model.weights) and other.shift == model.shift


def test_crc_split(frame):
    rows = frame("doc_id long", [(i,) for i in range(50)] + [(None,)]).select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
