"""Toxicity by multiple-instance learning: sentences carry the evidence, only documents carry labels.

A sentence's probability is a logistic function of its words; a document's is their noisy-or, 1 - prod(1 - p). The
weights are learnt from document labels alone, by the gradient of the documents' log loss through the noisy-or, on a
bounded sample of labelled documents (SAMPLE; whole texts). Features are words and their beginnings, as endings vary;
Spark counts them over the sample, and those that go with label 1 beyond chance (EVIDENCE) get a weight. Scoring reads
every whole text once, without a shuffle, and also tells which sentences a document's score comes from.

Defined results: a null or empty text, or one without words, is one sentence without words; a null doc_id is scored but
never learnt from; a document's label is the largest of its non-null ones; of several rows of an id the smallest text is
learnt from, once; without labels of both kinds every score is
the share of label 1; repeated rows are scored each; other columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.storage import prepare, stored
from ledgerlake.llm.text import LOWER, Table, fingerprints, in_parts, runs, text_bytes

#: Labelled documents to learn from at most, the first by a hash of their id.
SAMPLE = 8000
#: Documents of the sample that must hold a feature for it to have a weight.
LEAST_DOCS = 5
#: Standard deviations by which a feature's documents must exceed the usual share of label 1.
EVIDENCE = 4.0
#: Features with a weight at most: those with the most evidence.
FEATURES = 50_000
#: Bytes of the beginnings of words that are features beside the words.
BEGINNINGS = (4, 5)

#: Where predictions begin.
THRESHOLD = 0.7
#: Where a sentence counts as offending.
OFFENDING = 0.5

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    words: np.ndarray  # fingerprints
    weights: np.ndarray
    bias: float
    shift: float = 0.0  # added to a document's log odds, so that the best cut lies at THRESHOLD
    constant: float | None = None  # the score of every document, where nothing could be learnt


@dataclass
class Bags:
    """Features of some texts: fingerprint and sentence of each; text of each sentence, and its bytes."""

    words: np.ndarray
    sentence: np.ndarray
    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def bags(data: np.ndarray, offsets: np.ndarray) -> Bags:
    lower = LOWER[data]
    starts, ends = runs(_WORD[lower], offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.concatenate([[0], np.cumsum(_BREAK[lower], dtype=np.int64)])[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts))[: len(first)] - 1
    sentence = np.cumsum(new) - 1
    begin, end, owner = starts[first], ends[last], text[first]
    words, sentences = [fingerprints(lower, starts, ends)], [sentence]
    for n in BEGINNINGS:
        long = np.flatnonzero(ends - starts > n)
        words.append(fingerprints(lower, starts[long], starts[long] + n) + np.uint64(n))
        sentences.append(sentence[long])
    # Texts without words get a sentence without words.
    bare = np.setdiff1d(np.arange(len(offsets) - 1), owner)
    if len(bare):
        owner = np.concatenate([owner, bare])
        begin, end = np.concatenate([begin, offsets[bare]]), np.concatenate([end, offsets[bare]])
    return Bags(np.concatenate(words), np.concatenate(sentences), owner, begin, end)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _log_odds(total: np.ndarray) -> np.ndarray:
    """Of 1 - exp(-total)."""
    return np.log(-np.expm1(-np.maximum(total, 1e-12))) + total


def fit(features: np.ndarray, start: np.ndarray, place: np.ndarray, sentence: np.ndarray, owner: np.ndarray, labels: np.ndarray, steps: int = 250, rate: float = 0.15, decay: float = 2e-5) -> Model:
    """place, sentence: feature and sentence of each occurrence; owner: document of each sentence; labels: of each document.

    Weights begin at `start`, the log odds that a feature's documents show: from zero, a rare feature would gain hardly
    any of the credit for its documents, which goes to the sentences that are likely already.
    """
    share = float(labels.mean())
    once = np.unique(place * np.int64(len(owner)) + sentence)  # a feature counts once in a sentence
    place, sentence = once // len(owner), once % len(owner)
    weights, n = np.append(start, 0.0), len(labels)
    weights[-1] = np.log(share * n / len(owner) + 1e-9)
    tune = np.arange(n) % 5 != 4  # the others find the cut
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        z = np.bincount(sentence, weights[place], len(owner)) + weights[-1]
        total = np.bincount(owner, _softplus(z), n)
        slope = np.where(labels == 1, -1 / np.maximum(np.expm1(np.minimum(total, 50)), 1e-6), 1.0) * tune
        by_sentence = slope[owner] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(place, by_sentence[sentence], len(features)), by_sentence.sum()) / n
        gradient[:-1] += decay * weights[:-1]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        weights -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    z = np.bincount(sentence, weights[place], len(owner)) + weights[-1]
    odds = _log_odds(np.bincount(owner, _softplus(z), n))
    return Model(features, weights[:-1], float(weights[-1]), shift=float(np.log(THRESHOLD / (1 - THRESHOLD)) - _best_cut(odds[~tune], labels[~tune])))


def _best_cut(odds: np.ndarray, labels: np.ndarray) -> float:
    """The log odds from which on predicting 1 gives the best F1; the middle of the gap there."""
    order = np.argsort(-odds, kind="stable")
    if not labels.any():
        return float(np.log(THRESHOLD / (1 - THRESHOLD)))
    hits = np.cumsum(labels[order])
    score = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    last = np.append(odds[order][:-1] > odds[order][1:], True)  # equal scores stay together
    best = int(np.argmax(np.where(last, score, -1)))
    after = odds[order][best + 1] if best + 1 < len(order) else odds[order][best] - 1
    return float((odds[order][best] + after) / 2)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each feature: documents that hold it, and those with label 1; summed over what a task has seen."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def summed() -> pa.RecordBatch:
        keys, place = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        n, k = (np.bincount(place, np.concatenate([h[i] for h in held])).astype(np.int64) for i in (1, 2))
        held.clear()
        return pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": n, "k": k})

    for batch in batches:
        for few in in_parts(batch):
            b, toxic = bags(*text_bytes(few.column("text"))), few.column("toxic").to_numpy()
            order = np.lexsort((b.words, b.text[b.sentence]))
            words, text = b.words[order], b.text[b.sentence][order]
            new = np.ones(len(words), bool)
            new[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
            keys, place = np.unique(words[new], return_inverse=True)
            held.append((keys, np.bincount(place, minlength=len(keys)), np.bincount(place, toxic[text[new]], len(keys))))
            if sum(len(h[0]) for h in held) > 1 << 20:
                yield summed()
    if held:
        yield summed()


def train(documents: DataFrame, labels: DataFrame, usable: F.Column, sample: int = SAMPLE) -> Model:
    """Learn from at most `sample` labelled documents whose id fulfils `usable` (an expression over doc_id)."""
    prepare(documents.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.filter("toxic is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = texts.join(F.broadcast(marks), "doc_id")  # at most `sample` rows of two numbers
    # One row an id, reduced before the shuffle: so many rows reach the driver at most, and no document weighs more than another.
    chosen = stored(labelled.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "labelled")
    n, share = chosen.agg(F.count("*"), F.avg("toxic")).first()
    if not n or share in (0.0, 1.0):
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, constant=share or 0.0)
    counts = chosen.select("text", "toxic").mapInArrow(_counted, "key long, n long, k long")
    excess = (F.col("k") - F.col("n") * share) / F.sqrt(F.col("n") * (share * (1 - share)))
    counts = counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("z", excess)
    best = counts.filter((F.col("n") >= LEAST_DOCS) & (F.col("z") >= EVIDENCE)).orderBy(F.desc("z"), "key").limit(FEATURES)
    best = best.select("key", "n", "k").toArrow().sort_by("key")
    features, docs, hits = best["key"].to_numpy().view(np.uint64), best["n"].to_numpy(), best["k"].to_numpy()
    start = np.log((hits + 0.5) / (docs - hits + 0.5)) - np.log(share / (1 - share))
    kept: list[Table] = []

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each document: its label, how many sentences it has, and which of the features, in which of them."""
        if not kept:
            kept.append(Table(len(features)))
            kept[0].add(features, np.arange(len(features)))
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                b = bags(*text_bytes(batch.column("text").slice(i, 1)))
                place = kept[0].get(b.words)
                some = np.flatnonzero(place >= 0)
                rows.append((batch.column("doc_id")[i].as_py(), batch.column("toxic")[i].as_py(), len(b.text), place[some], b.sentence[some]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "toxic", "n", "place", "sentence"])

    rows = chosen.mapInArrow(found, "doc_id long, toxic long, n long, place array<long>, sentence array<long>").toArrow()
    rows = rows.sort_by("doc_id").combine_chunks()  # the same model however the rows arrive
    sizes = rows["n"].to_numpy()
    place, sentence = (rows[c].combine_chunks() for c in ("place", "sentence"))
    before = np.repeat(np.cumsum(sizes) - sizes, place.value_lengths().to_numpy())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return fit(features, start, place.flatten().to_numpy(), sentence.flatten().to_numpy() + before, owner, rows["toxic"].to_numpy())


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.table = Table(len(model.words))
        self.table.add(model.words, np.arange(len(model.words)))
        self.weights = np.append(model.weights, 0.0)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[dict]]]:
        """The score of each text, and its offending sentences (in code points)."""
        n, model = len(offsets) - 1, self.model
        if model.constant is not None:
            return np.full(n, model.constant), [[] for _ in range(n)]
        b = bags(data, offsets)
        place = self.table.get(b.words)
        some = np.flatnonzero(place >= 0)
        once = np.unique(b.sentence[some] * np.int64(len(model.words)) + place[some]) if len(some) else np.zeros(0, np.int64)
        z = np.bincount(once // max(1, len(model.words)), self.weights[once % max(1, len(model.words))], len(b.text)) + model.bias
        odds = _log_odds(np.bincount(b.text, _softplus(z), n)) + model.shift
        places: list[list[dict]] = [[] for _ in range(n)]
        for s in np.flatnonzero(z > np.log(OFFENDING / (1 - OFFENDING))):
            k = b.text[s]
            before = data[offsets[k] : b.end[s]]
            characters = np.cumsum((before & 0xC0) != 0x80)
            first = int(b.begin[s] - offsets[k])
            places[k].append({"start": int(characters[first]) - 1 if len(before) else 0, "end": int(characters[-1]) if len(before) else 0, "score": float(1 / (1 + np.exp(-z[s])))})
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700))), places


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """Each row of documents as a struct `row`, with score, predicted and its offending sentences."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # words that LEAST_DOCS of the sample hold: bounded
    kept: list[Scorer] = []

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Scorer(shared.value))
        place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for batch in batches:
            for few in in_parts(batch):
                score, places = kept[0].score(*text_bytes(few.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [few.column("row"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32)), pa.array(places, place)],
                    names=["row", "score", "predicted", "sentences"],
                )

    rows = documents.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    more = StructType.fromDDL("score double, predicted int, sentences array<struct<start: long, end: long, score: double>>")
    kind = StructType(rows.schema.fields[:1] + more.fields)
    return rows.mapInArrow(make, kind)


def held_out(doc_id: F.Column) -> F.Column:
    """Whether a document is kept out of learning: one of three, by the checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
