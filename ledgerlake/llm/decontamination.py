"""Benchmark decontamination by an FM-index of each shard of documents.

A shard is a slice of a task's documents of about SHARD bytes. Its words become numbers of the benchmark's vocabulary; where
two neighbours never follow each other in a benchmark item, no window can lie across, so the sequence is cut there,
and what is too short for any window is left out. What stays is indexed (suffix array, Burrows-Wheeler transform,
wavelet tree, sampled positions); all windows are searched backwards at once, their occurrences are located, and
the words they cover are merged into spans to remove. Documents are read once and not shuffled.

The benchmark is collected in blocks of about BLOCK_WORDS words, each its own pass over the documents; one block is the
usual case. Blocks are cut by running word totals over rows, and longer items into pieces that overlap by a window less one word, so a block is
bounded however the rows share their ids. Its patterns are what is broadcast.

Defined results: a null text has no words, in documents and items; a null item_id counts as the empty string; items that
share an id are one item; rows of documents are judged one by one, repeated or not, whatever their id; other columns
take no part, whatever their names; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.fm_index import FMIndex
from ledgerlake.llm.storage import prepare, stored
from ledgerlake.llm.text import LOWER, Table, in_parts, mix, quick_fingerprints, runs, same_slices, text_bytes, texts_of

#: Words of a window.
WINDOW = 10
SHARD = 1 << 22
#: Words of the benchmark that are searched for in one pass.
BLOCK_WORDS = 2_000_000

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, starts and ends of all words, and where each text's begin."""
    lower = LOWER[data]
    starts, ends = runs(_WORD[lower], offsets)
    return quick_fingerprints(lower, starts, ends), starts, ends, texts_of(starts, offsets)


@dataclass
class Patterns:
    """The windows of some benchmark items, by length; a word's number is its place among the words, from 1."""

    words: list[bytes]
    keys: np.ndarray  # their fingerprints
    windows: list[np.ndarray]  # of one length each, one window in a row
    items: list[np.ndarray]  # of each window: the item numbers, one window after the other
    begins: list[np.ndarray]
    names: list[str]


def patterns(texts: pa.Array, item_ids: list, window: int = WINDOW) -> Patterns:
    data, offsets = text_bytes(texts)
    keys, starts, ends, begins = _words(data, offsets)
    lower = LOWER[data].tobytes()
    # Words are told apart by their bytes; a fingerprint only finds them.
    numbers: dict[bytes, int] = {}
    number = np.fromiter((numbers.setdefault(lower[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts))
    own_keys = np.zeros(len(numbers), np.uint64)
    own_keys[number] = keys
    names = sorted({"" if i is None else str(i) for i in item_ids})
    place = {name: k for k, name in enumerate(names)}
    by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
    for k, item in enumerate(item_ids):
        own = number[begins[k] : begins[k + 1]] + 1
        if len(own):
            n = min(window, len(own))
            by_length.setdefault(n, []).append((np.lib.stride_tricks.sliding_window_view(own, n), place["" if item is None else str(item)]))
    out = Patterns(list(numbers), own_keys, [], [], [], names)
    for n in sorted(by_length):
        rows = np.concatenate([w for w, _ in by_length[n]])
        owner = np.concatenate([np.full(len(w), k) for w, k in by_length[n]])
        some, which = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(which.ravel().astype(np.int64) * len(names) + owner)
        out.windows.append(some)
        out.items.append(pairs % len(names))
        out.begins.append(np.searchsorted(pairs // len(names), np.arange(len(some) + 1)))
    return out


class Searcher:
    def __init__(self, own: Patterns):
        self.own = own
        some, first = np.unique(own.keys, return_index=True)
        self.vocabulary = Table(len(some))
        self.vocabulary.add(some, first)
        self.bytes = np.frombuffer(b"".join(own.words), np.uint8)
        self.lengths = np.fromiter(map(len, own.words), np.int64, len(own.words))
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.by_bytes: dict[bytes, int] = {}
        longer = [w for w in own.windows if w.shape[1] > 1]
        pairs = np.concatenate([self._pair(w[:, :-1].ravel(), w[:, 1:].ravel()) for w in longer]) if longer else np.zeros(0, np.uint64)
        pairs = np.unique(pairs)
        self.pairs = Table(len(pairs))
        self.pairs.add(pairs, np.arange(len(pairs)))
        self.least = min((w.shape[1] for w in longer), default=1 << 30)
        self.single = np.zeros(len(own.words) + 1, bool)
        for w in own.windows:
            if w.shape[1] == 1:
                self.single[w.ravel()] = True

    def numbers(self, lower: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word in the vocabulary, from 1, else 0: found by fingerprint, told by bytes."""
        number = self.vocabulary.get(keys)
        there = np.flatnonzero(number >= 0)
        lengths, own = ends[there] - starts[there], number[there]
        same = lengths == self.lengths[own]
        alike = np.flatnonzero(same)
        same[alike] = same_slices(lower, starts[there[alike]], self.bytes, self.begins[own[alike]], lengths[alike])
        for k in there[~same]:
            self.by_bytes = self.by_bytes or {w: i for i, w in enumerate(self.own.words)}
            number[k] = self.by_bytes.get(lower[starts[k] : ends[k]].tobytes(), -1)
        return number + 1

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64))

    def sequence(self, number: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What of the words any window could lie in, with ends between, and the word of each place."""
        n = len(number)
        tied = np.zeros(n, bool)  # to the word before
        maybe = np.flatnonzero((number[1:] > 0) & (number[:-1] > 0)) + 1
        tied[maybe] = self.pairs.get(self._pair(number[maybe - 1], number[maybe])) >= 0
        tied[begins[:-1][begins[:-1] < n]] = False
        first = np.flatnonzero(~tied)
        length = np.diff(np.append(first, n))
        alone = np.add.reduceat(self.single[number], first) > 0 if n else np.zeros(0, bool)
        chosen = np.flatnonzero((length >= self.least) | alone)
        length, first = length[chosen], first[chosen]
        at = np.cumsum(length + 1) - length - 1
        word = np.repeat(first - at, length + 1) + np.arange(int((length + 1).sum()))
        text = number[np.minimum(word, n - 1)] if n else number
        text[at + length] = 0
        return text, word

    def search(self, data: np.ndarray, offsets: np.ndarray):
        """Of each text: words, hit words, items; and of the hit words, starts and ends as runs of neighbours."""
        keys, starts, ends, begins = _words(data, offsets)
        n_texts = len(offsets) - 1
        text, word = self.sequence(self.numbers(LOWER[data], keys, starts, ends), begins)
        cover = np.zeros(len(keys) + 1, np.int64)
        owner = np.searchsorted(begins, np.arange(len(keys)), "right") - 1 if len(text) else np.zeros(0, np.int64)
        found: list[np.ndarray] = []
        if len(text):
            index = FMIndex(text)
            for windows, items, first in zip(self.own.windows, self.own.items, self.own.begins, strict=True):
                low, high = index.search(windows)
                which = np.repeat(np.arange(len(windows)), high - low)
                rows = np.arange(len(which)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[which]
                at = word[index.locate(rows)]
                np.add.at(cover, at, 1)
                np.add.at(cover, at + windows.shape[1], -1)
                once = np.unique(owner[at] * np.int64(len(windows)) + which)
                document, which = once // len(windows), once % len(windows)
                count = first[which + 1] - first[which]
                take = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[which], count)
                found.append(np.unique(np.repeat(document, count) * np.int64(len(self.own.names)) + items[take]))
        hit = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(hit)])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        edges = np.searchsorted(pairs // max(1, len(self.own.names)), np.arange(n_texts + 1))
        names = [[self.own.names[i] for i in pairs[a:b] % len(self.own.names)] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return np.diff(begins), np.diff(total[begins]), names, self._spans(data, offsets, starts, ends, begins, hit)

    @staticmethod
    def _spans(data, offsets, starts, ends, begins, hit) -> list[list[dict]]:
        """Neighbouring hit words as one span, in code points of their text."""
        out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
        a, b = runs(hit, begins)
        owner = np.searchsorted(begins, a, "right") - 1
        for k in np.unique(owner):
            characters = np.concatenate([[0], np.cumsum((data[offsets[k] : offsets[k + 1]] & 0xC0) != 0x80)])
            for i in np.flatnonzero(owner == k):
                out[k].append({"start": int(characters[starts[a[i]] - offsets[k]]), "end": int(characters[ends[b[i] - 1] - offsets[k]])})
        return out


_MORE = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


def _searched(rows: DataFrame, own: Patterns) -> DataFrame:
    prepare(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(own)  # at most BLOCK_WORDS words
    kept: list[Searcher] = []

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not kept:
            kept.append(Searcher(shared.value))
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        for batch in batches:
            for few in in_parts(batch, SHARD):
                found = kept[0].search(*text_bytes(few.column("text")))
                columns = [pa.array(f, k) for f, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([few.column("row"), *columns], names=["row", "n_words", "n_hit", "items", "spans"])

    kind = StructType([f for f in rows.schema.fields if f.name == "row"] + StructType.fromDDL(_MORE).fields)
    return rows.select("row", "text").mapInArrow(make, kind)


def _item_pieces(window: int, most: int):
    """Items in pieces of at most so many words, each with its partition and the words before it there."""
    names = ["part", "start", "n", "item_id", "text"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows = []
            for k, item in enumerate(batch.column("item_id").to_pylist()):
                data, offsets = text_bytes(batch.column("text").slice(k, 1))
                _, starts, ends, _ = _words(data, offsets)
                for a in range(0, max(1, len(starts) - window + 1), most - window + 1):
                    n = min(most, len(starts) - a)
                    rows.append((part, before, n, item, data[starts[a] : ends[a + n - 1]].tobytes().decode() if n else ""))
                    before += n
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return make


def _item_blocks(items: DataFrame, window: int, block_words: int) -> tuple[DataFrame, int]:
    """The items' pieces with the number of their block, and how many blocks there are."""
    most = max(2 * window, block_words // 8)
    pieces = stored(items.mapInArrow(_item_pieces(window, most), "part int, start long, n long, item_id string, text string"), "benchmark")
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    totals = pieces.groupBy("part").agg(F.sum("n").alias("total")).select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    blocks = pieces.join(F.broadcast(totals), "part").select("item_id", "text", F.expr(f"(base + start) div {block_words}").alias("block"))
    return blocks, int(blocks.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0]) + 1


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each row of documents as a struct `row`, with n_words, n_hit, items (their ids, sorted) and spans to remove."""
    prepare(documents.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    # A word has at least one byte and one between: a bound of the words, without counting them.
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    rows = documents.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    pieces, blocks = _item_blocks(items, window, block_words) if size > block_words else (items, 1)
    if blocks > 1:
        rows = stored(rows.select(F.struct(F.monotonically_increasing_id().alias("place"), "row").alias("row"), "text"), "documents", long_rows=True)
    found = None
    for k in range(blocks):
        part = pieces.filter(F.col("block") == k) if blocks > 1 else pieces
        held = part.select("item_id", "text").toArrow().combine_chunks()
        text = held["text"].combine_chunks() if isinstance(held["text"], pa.ChunkedArray) else held["text"]
        one = _searched(rows, patterns(text, held["item_id"].to_pylist(), window))
        found = one if found is None else found.unionByName(one)
    if blocks == 1:
        return found
    hits = found.filter("n_hit > 0").groupBy("row.place").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    whole = rows.select("row", "text").join(hits, F.col("row.place") == hits["place"], "left")
    return _counted(whole)


def _counted(rows: DataFrame) -> DataFrame:
    """Words, and words inside the merged spans, of documents searched in several passes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, hit, merged = [], [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                data, offsets = text_bytes(batch.column("text").slice(i, 1))
                _, starts, ends, begins = _words(data, offsets)
                at = (np.cumsum((data & 0xC0) != 0x80) - 1)[starts]
                cover = np.zeros(len(starts) + 1, np.int64)
                for s in spans:
                    cover[np.searchsorted(at, s["start"])] += 1
                    cover[np.searchsorted(at, s["end"])] -= 1
                covered = np.cumsum(cover[:-1]) > 0
                n.append(len(starts))
                hit.append(int(covered.sum()))
                merged += Searcher._spans(data, offsets, starts, ends, begins, covered)
            kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(n, pa.int64()), pa.array(hit, pa.int64()), batch.column("items"), pa.array(merged, kinds)], names=["row", "n_words", "n_hit", "items", "spans"])

    kind = StructType([f for f in rows.schema.fields if f.name == "row"] + StructType.fromDDL(_MORE).fields)
    empty = lambda c, k: F.coalesce(c, F.array().cast(k))
    rows = rows.select("row", "text", empty(F.col("items"), "array<string>").alias("items"), empty(F.col("spans"), "array<struct<start: long, end: long>>").alias("spans"))
    return rows.mapInArrow(make, kind).select("row.row", "n_words", "n_hit", "items", "spans")


def without(text: F.Column, spans: F.Column) -> F.Column:
    """The text with the spans (in code points, in order) cut out."""
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda t, s: F.struct(F.concat(t["kept"], F.substring(text, (t["at"] + 1).cast("int"), (s["start"] - t["at"]).cast("int"))).alias("kept"), s["end"].alias("at")),
        lambda t: F.concat(t["kept"], F.substring(text, (t["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)
