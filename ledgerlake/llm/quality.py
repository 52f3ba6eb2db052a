"""Quality by logistic regression over hashed word n-grams, learnt by follow-the-regularised-leader updates.

A text is cut into words and runs of marks; a piece equal to the one before becomes a repeat sign, so that repetition shows in
n-grams like any other usage. N-grams of one to ORDER pieces are hashed into 2^BITS places; a text is the sparse vector of
1 + log(count) at those places, of length one, and its score is the sigmoid of the dot product with the weights.

Weights are learnt with per-coordinate FTRL-proximal updates, text by text, in SHARDS shards of a bounded sample of labelled
documents (SAMPLE; whole texts). After each of ROUNDS rounds the shards' states are averaged and sent out again, so that no task
sees more than its shard and the result depends neither on partitions nor on the order of arrival. One document in
five of the sample is not learnt from: it places the cut, which lies at THRESHOLD. Scoring reads every whole text once,
without a shuffle; weights that the regulariser leaves at zero cost nothing.

Defined results: a null or empty text, or one of white space, has the empty vector and the score of the bias; a null doc_id is scored
but never learnt from; a document's label is the largest of its non-null ones; of several rows of an id the smallest text
is learnt from, once; without labels of both kinds every score is the share of label 1; repeated rows are scored each; other
columns take no part, whatever their names. A long text is read in steps of STEP bytes, which give the same counts.
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
from ledgerlake.llm.text import fingerprints, in_parts, mix, runs, text_bytes, texts_of

#: Labelled documents to learn from at most, the first by a hash of their id.
SAMPLE = 8_000
#: Parts of the sample that learn side by side, and how often they meet.
SHARDS, ROUNDS = 8, 2
#: Pieces of an n-gram at most; places of the vectors, as a power of two.
ORDER, BITS = 2, 18
#: Learning rate, its offset, and the two regularisers.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
#: Where predictions begin.
THRESHOLD = 0.3
#: Bytes of a text that are read at once.
STEP = 1 << 20

_SPACE, _WORD, _MARK = range(3)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _KIND[128:] = _WORD
_AGAIN = np.uint64(0x9E3779B97F4A7C15)


def grams(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For n = 1, 2, ...: place of each n-gram, its text, and which piece of the text it begins with."""
    kind = _KIND[data]
    starts, ends = runs(kind > _SPACE, offsets)
    cuts = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > _SPACE) & (kind[:-1] > _SPACE)) + 1
    inner = np.searchsorted(starts, cuts, "right") - 1
    cuts = cuts[starts[inner] < cuts] if len(starts) else cuts[:0]  # not where one text meets the next
    starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    piece = fingerprints(data, starts, ends)
    begins = texts_of(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    place = np.arange(len(piece)) - begins[text] if len(piece) else np.zeros(0, np.int64)
    same = np.zeros(len(piece), bool)
    same[1:] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    piece = np.where(same, _AGAIN, piece)
    out, key = [], np.zeros(len(piece), np.uint64)
    for n in range(1, ORDER + 1):
        key = mix(key[: len(piece) - n + 1] + np.uint64(n)) ^ piece[n - 1 :] if len(piece) >= n else key[:0]
        within = text[: len(key)] == text[n - 1 :][: len(key)]
        out.append(((mix(key[within]) >> np.uint64(64 - BITS)).astype(np.int64), text[: len(key)][within], place[: len(key)][within]))
    return out


def _vectors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and value of the entries of all texts' vectors."""
    found = grams(data, offsets)
    some, count = np.unique(np.concatenate([(text << BITS) | key for key, text, _ in found]), return_counts=True)
    return _valued(some >> BITS, some & ((1 << BITS) - 1), count, len(offsets) - 1)


def _valued(text: np.ndarray, place: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    value = 1 + np.log(count)
    length = np.sqrt(np.bincount(text, value * value, n))
    return text, place, value / length[text]


def _long_vector(data: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one long text, in steps of whole words; each also sees the ORDER words before it, so that repeats and n-grams over a cut are told."""
    filled = _KIND[data] > _SPACE
    filled[1:] &= ~filled[:-1]
    words = np.append(np.flatnonzero(filled), len(data))
    counts = np.zeros(1 << BITS, np.int64)
    i = 0
    while i < len(words) - 1:
        j = max(i + 1, int(np.searchsorted(words, words[i] + step, "right")) - 1)
        known = data[words[max(0, i - ORDER)] : words[i]]
        part = data[words[max(0, i - ORDER)] : words[j]]
        back = len(grams(known, np.array([0, len(known)]))[0][0])
        for n, (key, _, place) in enumerate(grams(part, np.array([0, len(part)])), 1):
            counts += np.bincount(key[place + n > back], minlength=1 << BITS)  # those that end beyond the known pieces
        i = j
    place = np.flatnonzero(counts)
    return _valued(np.zeros(len(place), np.int64), place, counts[place], 1)


def vectors(data: np.ndarray, offsets: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and value of the entries of all texts' vectors, by text; one text where it is longer than a step."""
    return _long_vector(data, step) if len(offsets) == 2 and len(data) > step else _vectors(data, offsets)


@dataclass
class Model:
    weights: np.ndarray  # of each place, the bias last
    shift: float = 0.0  # added to the log odds, so that the best cut lies at THRESHOLD
    constant: float | None = None  # the score of every document, where nothing could be learnt


@dataclass
class Leader:
    """What FTRL-proximal knows of each coordinate: z and the sum of squared gradients."""

    z: np.ndarray
    n: np.ndarray

    @staticmethod
    def empty() -> Leader:
        return Leader(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        step = (BETA + np.sqrt(n)) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / step)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One text: its entries (the bias among them) and label."""
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(n) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = n


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each labelled text: places (with the bias) and values as bytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            _, place, value = vectors(*text_bytes(one.column("text")))
            at, value = np.append(place, 1 << BITS).astype(np.int32), np.append(value, 1.0).astype(np.float32)
            columns = [*(one.column(c) for c in ("shard", "tune", "turn", "doc_id", "label")), pa.array([at.tobytes()], pa.binary()), pa.array([value.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "tune", "turn", "doc_id", "label", "at", "value"])


def _learnt(start: Leader):
    """What each shard adds to the leader's state when it goes through its texts, in their order."""

    def changes(shard: int, now: Leader) -> pa.RecordBatch:
        at = np.flatnonzero((now.z != start.z) | (now.n != start.n))
        columns = [np.full(len(at), shard, np.int32), at, now.z[at] - start.z[at], now.n[at] - start.n[at]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shard", "at", "z", "n"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = None, start
        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("shard", "label", "at", "value")), strict=True)
            for k, label, at, value in own:
                if k != shard:
                    if shard is not None:
                        yield changes(shard, now)
                    shard, now = k, Leader(start.z.copy(), start.n.copy())
                now.learn(np.frombuffer(at, np.int32), np.frombuffer(value, np.float32).astype(np.float64), label)
        if shard is not None:
            yield changes(shard, now)

    return make


def _best_cut(odds: np.ndarray, labels: np.ndarray) -> float:
    """The log odds from which on predicting 1 is right most often, both labels weighing the same; the middle of the gap there."""
    order = np.argsort(odds, kind="stable")
    odds, labels = odds[order], labels[order]
    below_0, below_1 = np.append(0, np.cumsum(labels == 0)), np.append(0, np.cumsum(labels == 1))
    right = below_0 / max(1, below_0[-1]) + 1 - below_1 / max(1, below_1[-1])  # with the cut before place k
    apart = np.append(True, odds[1:] > odds[:-1])
    k = int(np.argmax(np.where(apart, right[:-1], -1)))
    return float((odds[k] + odds[k - 1]) / 2) if k else float(odds[0])


def train(documents: DataFrame, labels: DataFrame, usable: F.Column, sample: int = SAMPLE) -> Model:
    """Learn from at most `sample` labelled documents whose id fulfils `usable` (an expression over doc_id)."""
    spark = documents.sparkSession
    prepare(spark)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marks = marks.filter(F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.max("label").alias("label"))
    marks = marks.filter("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = texts.join(F.broadcast(marks), "doc_id")  # at most `sample` rows of two numbers
    chosen = labelled.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    turn = F.xxhash64("doc_id", F.lit("turn"))
    parts = chosen.select(F.pmod(turn, F.lit(SHARDS)).cast("int").alias("shard"), (F.pmod(F.shiftright(turn, 16), F.lit(5)) == 4).alias("tune"), turn.alias("turn"), "doc_id", "label", "text")
    kind = "shard int, tune boolean, turn long, doc_id long, label int, at binary, value binary"
    rows = stored(parts.mapInArrow(_entries, kind), "vectors", long_rows=True)
    n, share = rows.agg(F.count("*"), F.avg("label")).first()
    if not n or share in (0.0, 1.0):
        return Model(Leader.empty().weights(), constant=share or 0.0)
    order = ["shard", "turn", "doc_id"]
    leader = Leader.empty()
    for _ in range(ROUNDS):
        shards = rows.filter("not tune").select(*order, "label", "at", "value").repartition(SHARDS, "shard").sortWithinPartitions(*order)
        moved = shards.mapInArrow(_learnt(leader), "shard int, at long, z double, n double")
        moved = moved.groupBy("at").agg(*(F.array_sort(F.collect_list(F.struct("shard", c))).alias(c) for c in ("z", "n")))
        mean = lambda c: (F.aggregate(c, F.lit(0.0), lambda t, x: t + x[c]) / SHARDS).alias(c)
        change = moved.select("at", mean("z"), mean("n")).toArrow()  # a row for each place at most: 2^BITS + 1
        at = change["at"].to_numpy()
        leader.z[at] += change["z"].to_numpy()
        leader.n[at] += change["n"].to_numpy()
    model = Model(leader.weights())
    tuned = rows.filter("tune").select("doc_id", "label", "at", "value").mapInArrow(_odds(model), "doc_id long, label int, odds double").toArrow().sort_by("doc_id")
    odds, truth = tuned["odds"].to_numpy(), tuned["label"].to_numpy()
    if len(set(truth)) == 2:
        model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - _best_cut(odds, truth))
    return model


def _odds(model: Model):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("at").to_pylist(), batch.column("value").to_pylist(), strict=True)
            odds = [float(model.weights[np.frombuffer(a, np.int32)] @ np.frombuffer(v, np.float32).astype(np.float64)) for a, v in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(odds, pa.float64())], names=["doc_id", "label", "odds"])

    return make


def scores(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if model.constant is not None:
        return np.full(n, model.constant)
    text, place, value = vectors(data, offsets)
    odds = np.bincount(text, model.weights[place] * value, n) + model.weights[-1] + model.shift
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """Each row of documents as a struct `row`, with score and predicted."""
    prepare(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2^BITS + 1 weights

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in in_parts(batch):
                score = scores(shared.value, *text_bytes(few.column("text")))
                yield pa.RecordBatch.from_arrays([few.column("row"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], names=["row", "score", "predicted"])

    rows = documents.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    kind = StructType(rows.schema.fields[:1] + StructType.fromDDL("score double, predicted int").fields)
    return rows.mapInArrow(make, kind)


def held_out(doc_id: F.Column) -> F.Column:
    """Whether a document is kept out of learning: one of five, by the checksum of its id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))
