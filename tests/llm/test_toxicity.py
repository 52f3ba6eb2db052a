import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import toxicity
from ledgerlake.llm.text import text_bytes
from ledgerlake.llm.toxicity import bags, held_out, scored, train

CALM = "the river runs under an old bridge and people walk there every day with their dogs".split()
RUDE = ["dolt", "dolts", "nitwit", "numpty"]


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(CALM) + rng.choice(["", "", "x"]) for _ in range(rng.randrange(3, 9))) for _ in range(rng.randrange(1, 12))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(RUDE).upper()
        docs.append((i, ". ".join(sentences) + ".", "x"))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    model = train(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), ~held_out(F.col("doc_id")))
    return d, {i: t for i, _, t in labels}, model


def test_held_out_documents(learnt):
    d, truth, model = learnt
    rows = scored(d, model).select("row.*", F.col("score").alias("p"), "predicted", "sentences", held_out(F.col("row.doc_id")).alias("held")).collect()
    held = [r for r in rows if r.held]
    assert 150 < len(held) < 250 and all(0 <= r.p <= 1 for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    for r in held:  # the offending sentence is the one with the insult
        if r.predicted and truth[r.doc_id]:
            assert any(any(w.upper() in r.text[s.start : s.end] for w in RUDE) for s in r.sentences)


def test_scores_are_a_plain_noisy_or(learnt):
    """Sentence by sentence, feature by feature, from the model's weights alone."""
    import math
    import re

    from ledgerlake.llm.text import fingerprints

    d, _, model = learnt
    weight = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))

    def key(text, more=0):
        data, offsets = text_bytes(pa.array([text]))
        return (int(fingerprints(data, offsets[:1], offsets[1:])[0]) + more) % 2**64

    def plain(text):
        none = 1.0
        for sentence in [s for s in re.split(r"[.!?\n]", text) if re.search(r"\w", s)] or [""]:
            keys = set()
            for word in re.findall(r"[0-9a-z]+", sentence.lower()):
                keys |= {key(word)} | {key(word[:n], n) for n in toxicity.BEGINNINGS if len(word) > n}
            none *= 1 - 1 / (1 + math.exp(-(model.bias + sum(weight.get(k, 0.0) for k in keys))))
        odds = math.log((1 - none) / none) + model.shift
        return 1 / (1 + math.exp(-odds))

    rows = scored(d.limit(150), model).select("row.text", F.col("score").alias("p"), "sentences").collect()
    assert all(math.isclose(r.p, plain(r.text), rel_tol=1e-6) for r in rows) and any(r.p > 0.7 for r in rows)


def test_odd_texts(learnt, frame):
    _, _, model = learnt
    rows = [(None, None), (1, ""), (1, ""), (2, "!!! ..."), (3, "dolt " * 20000), (4, "é" * 5 + " dolt ü.")]
    got = scored(frame("doc_id long, text string", rows), model).select("row.doc_id", "score", "predicted", "sentences").collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].predicted == by[2].predicted == by[None].predicted == 0 and by[3].predicted == 1
    assert by[4].sentences[0].start == 0 and by[4].sentences[0].end == 12
    assert scored(frame("doc_id long, text string", []), model).count() == 0


def test_without_labels_of_both_kinds(frame):
    docs = frame("doc_id long, text string", [(1, "a"), (2, "b")])
    for labels, share in (([], 0.0), ([(1, None)], 0.0), ([(1, 1), (1, 0), (2, 1)], 1.0)):
        model = train(docs, frame("doc_id long, toxic int", labels), F.lit(True))
        assert {r.score for r in scored(docs, model).collect()} == {share}


def test_sentences_against_plain_splitting():
    texts = ["One two. Three!? four\nfive", "", "...", "no end", "É a. b"]
    b = bags(*text_bytes(pa.array(texts)))
    plain = [max(1, sum(1 for s in __import__("re").split(r"[.!?\n]", t) if any(c.isalnum() for c in s))) for t in texts]
    assert list(np.bincount(b.text, minlength=len(texts))) == plain


def test_crc_split(frame):
    import zlib

    rows = frame("doc_id long", [(i,) for i in range(50)] + [(None,)]).select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert toxicity.THRESHOLD == 0.7


def test_repeated_rows_of_an_id_are_learnt_once(learnt, spark):
    d, truth, model = learnt
    hot = next(r for r in d.orderBy("doc_id").filter(~held_out(F.col("doc_id"))).collect() if truth[r.doc_id])
    again = d.unionByName(spark.createDataFrame([hot] * 300 + [(hot.doc_id, "~ a later text", "x")], d.schema))
    labels = spark.createDataFrame([(i, 1, t) for i, t in truth.items()], "doc_id long, quality int, toxic int")
    other = train(again, labels, ~held_out(F.col("doc_id")))
    assert np.array_equal(other.words, model.words) and np.array_equal(other.weights, model.weights) and other.bias == model.bias
