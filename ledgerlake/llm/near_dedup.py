"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document's set of word shingles has a signature of SYMBOLS b-bit MinHash values. Two sets of similarity 0.8 differ
in a fifth of them on average; pairs that differ in at most DISTANCE symbols are candidates. By pigeonhole such a pair
has a chunk of CHUNK symbols with at most one error, as DISTANCE < 2 * SYMBOLS / CHUNK; so each signature is posted
once for each symbol under its chunk without that symbol, and every such pair meets in some bucket. At similarity 0.8 the distance
is over the limit with a probability of about one in a million. Every link is confirmed on the full sets.

Equal sets are one class first. Buckets are not expanded into all pairs: each member is compared with the smallest of its
bucket. Buckets that still hold several components then form families (nodes tied by such buckets), and the nodes outside
a family's largest component are compared with all the others there whose signatures allow a link: sets of bounded blocks of the
family meet in a task, which gives back only links that join components. So no link between components is lost, no pairs
are sent around, and a large family is spread over many tasks.

Defined results: a null or empty text has an empty set and is linked with nothing; with fewer words than a shingle has,
the whole sequence is the only shingle; a null doc_id is never linked, its component is null and it is kept; rows that
share a doc_id are one document (linked with each other, one result row each); an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.storage import prepare, stored
from ledgerlake.llm.text import LOWER, fingerprints, in_parts, mix, runs, text_bytes, texts_of

SYMBOLS, CHUNK, BITS = 52, 4, 16
#: Bytes of sets in a block of a family.
BLOCK = 1 << 23
DISTANCE = 2 * SYMBOLS // CHUNK - 1

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all shingles, repeated ones too, and where each text's begin."""
    lower = LOWER[data]
    starts, ends = runs(_WORD[lower], offsets)
    word = fingerprints(lower, starts, ends)
    begins = texts_of(starts, offsets)
    count = np.diff(begins)
    sums = np.zeros(len(word), np.uint64)
    for i in range(words):
        sums[: len(word) - i if i else None] += mix(word[i:] + np.uint64(i)) * _FACTORS[i]
    kept = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    places = np.concatenate([[0], np.cumsum(kept)])
    take = np.repeat(begins[:-1] - places[:-1], kept) + np.arange(places[-1])
    out = sums[take] if len(word) else sums[:0]
    for k in np.flatnonzero((count > 0) & (count < words)):
        own = word[begins[k] : begins[k + 1]]
        out[places[k]] = np.sum(mix(own + np.arange(len(own), dtype=np.uint64)) * _FACTORS[: len(own)]) + np.uint64(len(own))
    return mix(out), places


def _signatures(words: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in in_parts(batch):
                all_of, places = shingles(*text_bytes(few.column("text")), words)
                full = np.flatnonzero(np.diff(places))
                symbols = np.zeros((len(full), SYMBOLS), np.uint16)
                if len(full):
                    for i in range(SYMBOLS):
                        symbols[:, i] = mix(np.minimum.reduceat(all_of * _FACTORS[i], places[full])) & np.uint64((1 << BITS) - 1)
                n, mark, signature = [], [], [None] * few.num_rows
                for k in range(few.num_rows):
                    own = np.unique(all_of[places[k] : places[k + 1]])
                    n.append(len(own))
                    mark.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                for k, s in zip(full, symbols, strict=True):
                    signature[k] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(n, pa.int64()), pa.array(mark, pa.binary()), pa.array(signature, pa.binary())],
                    names=["doc_id", "n_shingles", "mark", "signature"],
                )

    return make


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each signature: a chunk without one of its symbols, with the place of that symbol."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column("signature"))
        symbols = np.frombuffer(text_bytes(batch.column("signature"))[0], np.uint16).reshape(len(offsets) - 1, SYMBOLS).astype(np.int64)
        keys = np.empty(symbols.shape, np.int64)
        for i in range(SYMBOLS):
            chunk = i - i % CHUNK
            keys[:, i] = i
            for j in range(chunk, chunk + CHUNK):
                if j != i:
                    keys[:, i] = (keys[:, i] << BITS) | symbols[:, j]
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column("node").to_numpy(), SYMBOLS))], names=["key", "node"])


def _sets(words: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in in_parts(batch):
                all_of, places = shingles(*text_bytes(few.column("text")), words)
                own = [np.unique(all_of[places[k] : places[k + 1]]).tobytes() for k in range(few.num_rows)]
                yield pa.RecordBatch.from_arrays([few.column("doc_id"), pa.array(own, pa.binary())], names=["node", "own"])

    return make


def _linked(percent: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for x, y in zip(batch.column("own_a"), batch.column("own_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                hit.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return make


def _confirmed(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those that the signatures allow and the full sets confirm."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("symbols").alias(f"s_{side}")), side)
    errors = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.when(x == y, 0).otherwise(1)), F.lit(0), lambda t, x: t + x)
    pairs = pairs.filter(errors <= DISTANCE).select("a", "b").distinct()
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("own").alias(f"own_{side}")), side)
    return stored(pairs.select("a", "b", "own_a", "own_b").mapInArrow(_linked(percent), "a long, b long"), "confirmed")


def _divided(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (key, node) of the buckets that still hold more than one component, with their component."""
    of = components(links)
    members = members.select("key", "node").join(of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return stored(members.join(several.select("key"), "key", "left_semi"), "divided")


def _joined(percent: int):
    """Links between the rows of two blocks of a family (or within one), as many as join components."""

    def meet(rows: pa.Table) -> pa.Table:
        node, side = rows["node"].to_numpy(), rows["side"].to_numpy()
        _, label = np.unique(rows["component"].to_numpy(), return_inverse=True)
        signature = np.frombuffer(text_bytes(rows["signature"])[0], np.uint16).reshape(len(node), SYMBOLS)
        data, offsets = text_bytes(rows["own"])
        values, offsets = np.frombuffer(data.tobytes(), np.uint64), offsets // 8
        size = np.diff(offsets)
        within = side.max(initial=0) == 0  # one block with itself
        others = np.flatnonzero(side == 1) if not within else np.arange(len(node))
        found = []
        for u in np.flatnonzero(side == 0):
            near = others[(label[others] != label[u]) & ((others > u) | (not within))]
            near = near[(signature[near] != signature[u]).sum(axis=1) <= DISTANCE]
            own = values[offsets[u] : offsets[u + 1]]
            steps = np.cumsum(size[near]) // (1 << 20)
            for some in np.split(near, np.flatnonzero(np.diff(steps)) + 1):
                if not len(some):
                    continue
                begins = np.cumsum(size[some]) - size[some]
                theirs = values[np.repeat(offsets[some] - begins, size[some]) + np.arange(int(size[some].sum()))]
                at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
                common = np.add.reduceat(own[at] == theirs, begins, dtype=np.int64)
                linked = some[100 * common >= percent * (size[u] + size[some] - common)]
                for v in linked:
                    if label[v] != label[u]:
                        found.append((node[u], node[v]))
                        label[label == label[v]] = label[u]
        return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate("ab")})

    return meet


def _within_families(left: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """left (key, node, component): links between different components of a bucket, enough to join those that are linked."""
    first = left.groupBy("key").agg(F.min("node").alias("first"))
    ties = left.join(first, "key").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    family = components(ties).select("node", F.col("component").alias("family"))
    rows = stored(family.join(left.select("node", "component").distinct(), "node").join(sets, "node"), "families")
    parts = rows.groupBy("family", "component").agg(F.count("*").alias("n"), F.sum(F.octet_length("own")).alias("bytes"))
    shape = parts.groupBy("family").agg(F.max(F.struct("n", "component", "bytes")).alias("main"), F.sum("bytes").alias("bytes"))
    blocks = lambda x: F.greatest(F.lit(1), F.ceil(x / BLOCK)).cast("int")
    shape = shape.select("family", F.col("main.component").alias("main"), blocks(F.col("main.bytes")).alias("m"), blocks(F.col("bytes") - F.col("main.bytes")).alias("r"))
    rows = rows.join(shape, "family").join(classes.select("node", "signature"), "node")
    # Blocks 0..r-1 hold the nodes outside the main component, r..r+m-1 those inside; block x meets block y for x < r, x <= y.
    outside = F.col("component") != F.col("main")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.when(outside, F.col("r")).otherwise(F.col("m"))).cast("int"))
    meeting = lambda x, y, side: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), F.lit(side).alias("side"))
    as_first = F.transform(F.sequence(F.col("block"), F.col("r") + F.col("m") - 1), lambda y: meeting(F.col("block"), y, 0))
    as_second = F.when(F.col("block") > 0, F.transform(F.sequence(F.lit(0), F.col("block") - 1), lambda x: meeting(x, F.col("block"), 1)))
    inside = F.transform(F.sequence(F.lit(0), F.col("r") - 1), lambda x: meeting(x, F.col("r") + F.col("block"), 1))
    none = F.array().cast("array<struct<x: int, y: int, side: int>>")
    spread = rows.withColumn("at", F.explode(F.when(outside, F.concat(as_first, F.coalesce(as_second, none))).otherwise(inside)))
    spread = spread.select("family", "at.x", "at.y", "at.side", "node", "component", "signature", "own")
    return stored(spread.groupBy("family", "x", "y").applyInArrow(_joined(percent), "a long, b long"), "family_links")


def near_duplicates(documents: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept; one row for each of documents."""
    prepare(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(texts.mapInArrow(_signatures(words), "doc_id long, n_shingles long, mark binary, signature binary"), "signatures")
    usable = rows.filter("mark is not null and doc_id is not null")
    classes = usable.groupBy("mark").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature"))
    classes = stored(classes, "classes")
    # Rows that share an id but not a set have one node each, linked through the id.
    node_of = usable.select("doc_id", "mark").join(classes.select("mark", "node"), "mark")
    by_id = node_of.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    posted = classes.select("node", "signature").mapInArrow(_posted, "key long, node long")
    full = posted.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).filter("first < last")
    members = stored(posted.join(full.select("key", "first"), "key"), "members")
    wanted = members.select("node").distinct()
    symbols = F.transform(F.sequence(F.lit(0), F.lit(SYMBOLS - 1)), lambda i: F.substring(F.hex("signature"), i * (BITS // 4) + 1, F.lit(BITS // 4)))
    nodes = classes.select("node", symbols.alias("symbols")).join(wanted, "node", "left_semi")
    chosen = texts.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
    sets = stored(chosen.mapInArrow(_sets(words), "node long, own binary"), "sets")

    # One comparison a member, with the smallest of its bucket.
    links = _confirmed(members.filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct(), nodes, sets, percent)
    left = _divided(members, links)
    if not left.isEmpty():
        links = links.unionByName(_within_families(left, classes, sets, percent))
    of = components(links.unionByName(by_id))
    tied = rows.join(classes.select("mark", "node"), "mark", "left").join(of, "node", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "node", "doc_id"))
    return tied.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
