"""Approximate nearest neighbours by a permutation index.

Pivots are a bounded sample of the vectors. A vector is represented by the order of the pivots by nearness, and posted in the
inverted files of the POSTED nearest. A query looks into the files of its PROBED nearest pivots, ranks what is posted there
by the footrule distance of the two orders (the sum of how far each pivot is from its place in the other), and scores
the CANDIDATES best of each file exactly, on the original vectors, which are posted with the orders.

Equal vectors are one class, posted once with their smallest ids, so any number of copies of one vector costs no more than
one. A long file is cut into blocks, as are the queries that look into it; block meets block in a task, which gives back
only the few best. Pivots grow with the square root of the number of vectors up to PIVOTS, so files grow slower than the table; the
files a query looks into grow with the square root of the pivots, so that recall does not sink as the files get narrower.

Defined results: vectors that are null, zero, empty, without id, or hold null or non-finite components take no part; vectors of
different lengths have no cosine and are searched apart, length by length; a repeated row counts once; of several vectors under
one id the best counts; ties go to the smaller id; a query without candidates has no rows; other columns are not read. Before they
are multiplied vectors are scaled by a power of two, which changes no cosine by a bit and keeps tiny and huge ones in range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.storage import prepare, stored
from ledgerlake.llm.text import text_bytes

#: Pivots: this many times the square root of the classes, between a least and a most.
PIVOTS_PER_ROOT, LEAST_PIVOTS, PIVOTS = 1.0, 64, 4096
#: Files a vector is posted in; files a query looks into where there are PROBED_AT pivots or fewer; candidates scored in a block of a file.
POSTED, PROBED, PROBED_AT, CANDIDATES = 8, 32, 100, 300
#: Rows of a file, and queries, that meet in one task at once.
FILE_BLOCK, QUERY_BLOCK = 8192, 1024


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part, each once."""
    e = F.col("embedding")
    fine = F.forall(e, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return rows.filter(F.col("vec_id").isNotNull() & e.isNotNull() & F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to between a half and one."""
    power = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1] if x.size else np.zeros((len(x), 1), int)
    return np.ldexp(x, -power)


def _ordered(pivots: np.ndarray, first_ones: int):
    """The place of each pivot in the order of a vector's pivots, and the nearest ones, nearest first."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _unit(_matrix(batch.column("embedding"))) @ pivots.T
            order = np.argsort(-near, axis=1, kind="stable")
            place = np.empty(order.shape, np.int16)
            np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
            columns = [batch.column(c) for c in ("class", "embedding", "ids", "asked")]
            places = pa.array([p.tobytes() for p in place], pa.binary())
            first = pa.array(list(order[:, :first_ones].astype(np.int32)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*columns, places, first], names=["class", "embedding", "ids", "asked", "places", "nearest"])

    return make


def _meet(k: int, candidates: int, posted: int):
    """Of each query in the block, the k best of the file's block among the candidates nearest by footrule distance."""
    kinds = {"query": pa.int64(), "ids": pa.list_(pa.int64()), "score": pa.float64()}

    def meet(file: pa.Table, asking: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in kinds}
        if file.num_rows and asking.num_rows:
            theirs = np.frombuffer(text_bytes(file["places"])[0], np.int16).reshape(file.num_rows, -1)
            mine = np.frombuffer(text_bytes(asking["own_places"])[0], np.int16).reshape(asking.num_rows, -1)
            x, y = _scaled(_matrix(file["embedding"])), _scaled(_matrix(asking["own"]))
            lengths, ids = np.sqrt(np.einsum("ij,ij->i", x, x)), file["ids"].to_pylist()
            smallest = np.array([i[0] for i in ids])
            pivot = asking["file"][0].as_py()
            for q, query in enumerate(asking["query"].to_pylist()):
                # Files that the query looks into before this one have shown it some of the vectors.
                before = np.flatnonzero(mine[q] < mine[q][pivot])
                new = np.flatnonzero(~(theirs[:, before] < posted).any(axis=1))
                distance = np.abs(theirs[new] - mine[q]).sum(axis=1, dtype=np.int64)
                best = new[np.lexsort((smallest[new], distance))[:candidates]]
                score = np.einsum("ij,j->i", x[best], y[q]) / (lengths[best] * np.sqrt(np.einsum("i,i->", y[q], y[q])))
                for i in np.lexsort((smallest[best], -score))[:k]:
                    out["query"].append(query)
                    out["ids"].append(ids[best[i]])
                    out["score"].append(score[i])
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    return meet


def nearest(vectors: DataFrame, asks: F.Column, k: int = 5, candidates: int = CANDIDATES, probed: int | None = None, posted: int = POSTED) -> DataFrame:
    """For each vec_id that fulfils `asks`: the k nearest others by cosine: query_id, rank, vec_id, score.

    `probed` is the number of files that a query looks into, by default PROBED, more where there are many pivots.
    """
    prepare(vectors.sparkSession)
    rows = usable(vectors)
    sizes = [r["n"] for r in rows.groupBy(F.size("embedding").alias("n")).count().orderBy("n").collect()]  # a row for each length
    if len(sizes) <= 1:
        return _nearest(rows, asks, k, candidates, probed, posted)
    found = [_nearest(rows.filter(F.size("embedding") == n), asks, k, candidates, probed, posted) for n in sizes]
    every = found[0]
    for one in found[1:]:
        every = every.unionByName(one)
    # An id may have vectors of several lengths; ids are listed once, with their best score.
    every = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, asks: F.Column, k: int, candidates: int, probed: int | None, posted: int) -> DataFrame:
    """The same for usable vectors of one length."""
    # Of each class the k + 1 smallest ids: no answer needs more. Ranks are limited before the shuffle.
    once = rows.groupBy("embedding", "vec_id").agg(F.max(asks).alias("asks"))
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    small = once.withColumn("place", place).filter(F.col("place") <= k + 1)
    ids = small.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    asked = once.filter("asks").select("embedding").distinct().withColumn("asked", F.lit(True))
    classes = ids.join(asked, "embedding", "left").select(F.monotonically_increasing_id().alias("class"), "embedding", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    classes = stored(classes, "vector_classes")
    n = classes.count()
    n_pivots = max(1, min(n, PIVOTS, max(LEAST_PIVOTS, int(PIVOTS_PER_ROOT * n**0.5))))
    probed = probed or int(PROBED * max(1.0, n_pivots / PROBED_AT) ** 0.5)
    sample = classes.orderBy(F.xxhash64("embedding"), "class").limit(n_pivots).select("class", "embedding").toArrow().sort_by("class")
    points = _unit(_matrix(sample["embedding"])) if n else np.zeros((0, 0))
    kind = f"class long, embedding {classes.schema['embedding'].dataType.simpleString()}, ids array<long>, asked boolean, places binary, nearest array<int>"
    orders = stored(classes.select("class", "embedding", "ids", "asked").mapInArrow(_ordered(points, max(posted, probed)), kind), "orders")

    files = orders.select("class", "ids", "embedding", "places", F.explode(F.slice("nearest", 1, posted)).alias("pivot"))
    asking = orders.filter("asked").select("class", "embedding", "places", F.explode(F.slice("nearest", 1, probed)).alias("pivot"))
    blocks = lambda df, size, name: df.groupBy("pivot").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = blocks(files, FILE_BLOCK, "file_blocks").join(blocks(asking, QUERY_BLOCK, "query_blocks"), "pivot")  # at most a row for each pivot
    one_of = lambda name: F.pmod(F.xxhash64("class"), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    files = files.join(F.broadcast(sizes), "pivot").select("pivot", "ids", "embedding", "places", one_of("file_blocks").alias("x"), every("query_blocks").alias("y"))
    asking = asking.join(F.broadcast(sizes), "pivot").select(
        "pivot", F.col("pivot").alias("file"), F.col("class").alias("query"), F.col("embedding").alias("own"), F.col("places").alias("own_places"), every("file_blocks").alias("x"), one_of("query_blocks").alias("y")
    )
    meet = _meet(k + 1, candidates, posted)
    scored = files.groupBy("pivot", "x", "y").cogroup(asking.groupBy("pivot", "x", "y")).applyInArrow(meet, "query long, ids array<long>, score double")
    near = scored.select("query", "score", F.explode("ids").alias("vec_id")).groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    answers = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "score"))).alias("near"))
    # Back to every row that asks: a class may be asked for by very many.
    asks_for = once.filter("asks").join(classes.select("class", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), F.col("class").alias("query"))
    out = asks_for.join(answers, "query").select("query_id", F.explode("near").alias("n")).filter("n.vec_id <> query_id")
    out = out.groupBy("query_id", "n.vec_id").agg(F.max("n.score").alias("score"))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
