"""Hard negatives by a residue-number-system product: exact integer scores from float32 matrix multiplication.

Components become integers, floor(SCALE * x). Each matrix is held as its residues modulo a few primes, each between minus and plus
half the prime; products are multiplied in float32 over at most DEPTH components at a time, whose sums stay below 2^24 and so are
exact, and are reduced modulo the prime again. As many primes are taken as the largest possible score needs, and mixed-radix
Chinese remaindering puts the signed 64-bit scores together.

Anchors are a stated query set against all rows, in blocks: at most ANCHOR_BYTES of anchors are sent to every task at once, and
each task keeps the few best rows of each anchor. Two passes. The first finds an anchor's positives. The second counts, for each
positive, rows of other labels whose score lies in the window that the positive's score opens, and keeps the first ones.
Rows that share vector and label are told apart by id alone, so only as many of them as an answer could hold are compared.

Defined results: rows without id or label, with a null vector, or with null or non-finite components take no part; nor do vectors
with a sum of squares of 2^61 or more after scaling, as their scores need not fit 64 bits; an empty or a zero vector takes part; vectors of different
lengths have no score and are neither positive nor negative for each other; of several rows of an id the one with the smallest
label, then the smallest integer vector counts; an anchor without positives, or a positive without rows in its window, has no
result rows; ties go to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.storage import prepare, stored

SCALE = 256
#: Components that are multiplied at once: 256 * 254 * 254 is below 2^24.
DEPTH = 256
#: Bytes of anchors that are sent to every task at once.
ANCHOR_BYTES = 1 << 24
#: Anchors and rows whose scores are held at once.
ANCHOR_ROWS, ROWS = 512, 4096


def _primes(below: int, n: int) -> list[int]:
    """The n largest odd primes below a limit."""
    found = [p for p in range(3, below, 2) if all(p % q for q in range(3, int(p**0.5) + 1, 2))]
    return found[: -n - 1 : -1]


#: Their product is over 2^64: the scores of any vectors that take part.
PRIMES = _primes(510, 8)


def primes_for(most: int) -> list[int]:
    """As many primes as tell all integers from -most to most apart."""
    product, out = 1, []
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * most + 1:
            return out
    raise ValueError(f"scores up to {most} need more primes")


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo p, between minus and plus half of p; exact for float32 integers below 2^24."""
    p32 = np.float32(p)
    x = x - p32 * np.rint(x / p32)
    return x - p32 * np.rint(x / p32)  # the first quotient may be rounded to the neighbour


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Of an integer matrix, modulo each prime, as float32."""
    out = []
    for p in primes:
        r = (matrix % p).astype(np.float32)
        out.append(np.where(r > p // 2, r - np.float32(p), r))
    return out


def product(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """left @ right.T of the integer matrices behind the residues, exact in 64 bits."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        total = np.zeros((len(left[k]), len(right[k])), np.float32)
        for at in range(0, left[k].shape[1], DEPTH):
            total += _balanced(left[k][:, at : at + DEPTH] @ right[k][:, at : at + DEPTH].T, p)
        # Mixed radix: what the digits so far leave, divided by the product of their primes.
        rest = _balanced(total, p)
        for q, digit in zip(primes, digits, strict=False):
            rest = _balanced(_balanced(rest - digit, p) * np.float32(_inverse(q, p)), p)
        digits.append(rest)
    score = np.zeros(digits[0].shape, np.int64)
    for p, digit in zip(reversed(primes), reversed(digits), strict=True):
        score = score * p + digit.astype(np.int64)
    return score


def _inverse(q: int, p: int) -> int:
    """Of q modulo p, between minus and plus half of p."""
    r = pow(q, -1, p)
    return r - p if r > p // 2 else r


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and q (the integer vector) of the rows that take part, one for each id."""
    e = F.col("embedding")
    whole = F.transform(e, lambda x: F.floor(x.cast("double") * SCALE))
    scaled = F.aggregate(e, F.lit(0.0), lambda t, x: t + (x.cast("double") * SCALE) * (x.cast("double") * SCALE))
    # A missing component makes the sum null, NaN or infinity make it no number below the limit.
    fine = e.isNotNull() & F.coalesce((scaled < 2.0**61) & ~F.isnan(scaled), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.when(fine, whole).alias("q"))
    rows = rows.filter("vec_id is not null and label is not null and q is not null")
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("least")).select("vec_id", "least.label", "least.q")


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), np.int64)


class Best:
    """For each query the k best (score, id) so far: higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.held = np.zeros((n, k), bool)

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates of some queries; what could not enter should be left out before."""
        if not len(query):
            return
        k = self.score.shape[1]
        some = np.unique(query)
        query = np.concatenate([query, np.repeat(some, k)])
        score, ids = np.concatenate([score, self.score[some].ravel()]), np.concatenate([ids, self.id[some].ravel()])
        held = np.concatenate([np.ones(len(query) - len(some) * k, bool), self.held[some].ravel()])
        query, score, ids = query[held], score[held], ids[held]
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        begin = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        place = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
        query, score, ids, place = (x[place < k] for x in (query, score, ids, place))
        self.score[query, place], self.id[query, place], self.held[query, place] = score, ids, True

    def least(self) -> np.ndarray:
        """Of each query the score that a candidate must reach."""
        return np.where(self.held[:, -1], self.score[:, -1], np.iinfo(np.int64).min)


class Asked:
    """A block of anchors of one vector length, in order of their ids."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, q: np.ndarray, primes: list[int]):
        self.ids, self.label, self.primes = ids, label, primes
        self.residues = residues(q, primes)

    def scores(self, some: slice, rows: list[np.ndarray]) -> np.ndarray:
        return product([r[some] for r in self.residues], rows, self.primes)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and vectors of the rows of one vector length, ROWS at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            some = batch.slice(at, ROWS)
            yield some.column("vec_id").to_numpy(), some.column("label").to_numpy(), _matrix(some.column("q"))


def _positives(asked, k: int):
    """Each anchor's k best rows of its label that a task sees."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = asked.value
        best = Best(len(a.ids), k)
        for ids, label, q in _blocks(batches):
            rows = residues(q, a.primes)
            for at in range(0, len(a.ids), ANCHOR_ROWS):
                some = slice(at, at + ANCHOR_ROWS)
                score = a.scores(some, rows)
                fits = (label == a.label[some, None]) & (ids != a.ids[some, None]) & (score >= best.least()[some, None])
                x, y = np.nonzero(fits)
                best.offer(x + at, score[x, y], ids[y])
        x, y = np.nonzero(best.held)
        yield pa.RecordBatch.from_arrays([pa.array(a.ids[x]), pa.array(best.id[x, y]), pa.array(best.score[x, y])], names=["anchor_id", "vec_id", "score"])

    return make


def _negatives(asked, k: int):
    """Of each (anchor, window), the k best rows of other labels in the window that a task sees."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, owner, low, high = asked.value
        best = Best(len(owner), k)
        first = np.searchsorted(owner, np.arange(len(a.ids) + 1))
        for ids, label, q in _blocks(batches):
            rows = residues(q, a.primes)
            for at in range(0, len(a.ids), ANCHOR_ROWS):
                some = slice(at, at + ANCHOR_ROWS)
                score = a.scores(some, rows)
                other = label != a.label[some, None]
                turns = int(np.diff(first[at : at + ANCHOR_ROWS + 1]).max(initial=0))
                for turn in range(turns):  # the first window of every anchor, then the second ...
                    window = first[at : at + ANCHOR_ROWS + 1][:-1] + turn
                    there = np.flatnonzero(window < first[at + 1 : at + ANCHOR_ROWS + 1])
                    window = window[there]
                    bound = np.maximum(low[window], best.least()[window])
                    x, y = np.nonzero(other[there] & (score[there] >= bound[:, None]) & (score[there] <= high[window, None]))
                    best.offer(window[x], score[there[x], y], ids[y])
        x, y = np.nonzero(best.held)
        columns = [a.ids[owner[x]], low[x], high[x], best.id[x, y], best.score[x, y]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "low", "high", "negative_id", "negative_score"])

    return make


def _first(rows: DataFrame, by: list[str], score: str, ids: str, k: int) -> DataFrame:
    """The k best rows of each group, ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), ids)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, asks: Column, label: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, anchor_bytes: int = ANCHOR_BYTES
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `asks` (over vec_id) tells anchors, `label` gives a row's label. Negatives have between low and high percent of the positive's score.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = stored(usable(vectors, label), "vectors")
    # Of rows that share vector and label no answer needs more than these, the anchor itself included. Ranks are limited before the shuffle.
    place = F.row_number().over(Window.partitionBy("q", "label").orderBy("vec_id"))
    candidates = stored(rows.withColumn("place", place).filter(F.col("place") <= max(positives + 1, negatives)).drop("place"), "candidates")
    asking = rows.filter(F.coalesce(asks, F.lit(False)))
    lengths = F.aggregate("q", F.lit(0).cast("long"), lambda t, x: t + x * x)
    shapes = asking.groupBy(F.size("q").alias("size")).agg(F.max(lengths).alias("longest")).orderBy("size").collect()  # a row for each vector length
    out = None
    for shape in shapes:
        size = shape["size"]
        alike = candidates.filter(F.size("q") == size)
        anchors = asking.filter(F.size("q") == size)
        # Every score is at most the product of the two lengths.
        longest = max(shape["longest"], alike.agg(F.max(lengths)).first()[0] or 0)
        primes, most = primes_for(longest), max(1, anchor_bytes // (8 * max(1, size)))
        last = None
        while True:
            block = (anchors if last is None else anchors.filter(F.col("vec_id") > last)).orderBy("vec_id").limit(most).toArrow().combine_chunks()
            if not block.num_rows:
                break
            found = _of_block(spark, block, alike, primes, positives, negatives, low, high)
            out = found if out is None else out.unionByName(found)
            last = block["vec_id"][-1].as_py()
            if block.num_rows < most:
                break
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out


def _of_block(spark, block: pa.Table, rows: DataFrame, primes: list[int], positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The result for a block of anchors of one vector length."""
    asked = Asked(block["vec_id"].to_numpy(), block["label"].to_numpy(), _matrix(block["q"].chunk(0)), primes)
    sent = spark.sparkContext.broadcast(asked)  # at most ANCHOR_BYTES of vectors
    near = rows.mapInArrow(_positives(sent, positives), "anchor_id long, vec_id long, score long")
    near = stored(_first(near, ["anchor_id"], "score", "vec_id", positives).select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # low * positive <= 100 * negative <= high * positive, as bounds on the negative's score; in wide numbers, as scores may fill 64 bits.
    wide = F.col("positive_score").cast("decimal(25,0)")
    least, most = F.ceil(wide * low / 100).cast("decimal(20,0)"), F.floor(wide * high / 100).cast("decimal(20,0)")
    near = near.withColumn("low", least.cast("long")).withColumn("high", most.cast("long"))
    windows = near.filter("low <= high").select("anchor_id", "low", "high").distinct().orderBy("anchor_id", "low", "high").toArrow()  # at most `positives` an anchor
    owner = np.searchsorted(asked.ids, windows["anchor_id"].to_numpy())
    bounds = spark.sparkContext.broadcast((asked, owner, windows["low"].to_numpy(), windows["high"].to_numpy()))
    far = rows.mapInArrow(_negatives(bounds, negatives), "anchor_id long, low long, high long, negative_id long, negative_score long")
    far = _first(far, ["anchor_id", "low", "high"], "negative_score", "negative_id", negatives)
    return near.join(far, ["anchor_id", "low", "high"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
