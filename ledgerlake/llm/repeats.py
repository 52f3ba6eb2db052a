"""Suffix-array dedup: every byte inside a long string that also starts anywhere else, in this or another document.

Which suffixes are sorted. Every window of `length` bytes has an anchor: the first place in it of the smallest fingerprint of
`GRAM` bytes, which depends on the window's bytes alone. So two equal windows have their anchors at the same offset, and it is enough
to order the suffixes that start at anchors: about one in 150 bytes. Of those, only anchors whose bytes occur more than once
are kept, and one of each set of anchors with equal surroundings (all the windows around the anchor), with its count.

The merge. Each task sorts its suffixes into runs, and sends them front-coded: what a suffix shares with the one before is only
a number. A task of the next stage gets the runs of some anchors and merges them with a loser tree that keeps, for
every contender, how many bytes it shares with the last winner: two of them are compared from there on, and not at all if the numbers differ.
The merge yields each suffix with its common prefix with the one before, as a suffix array does. A window that starts o bytes
before its anchor is repeated when another suffix lies in the same interval of prefixes of length - o bytes, and in the same interval
of the o bytes before the anchor, which are ordered likewise, backwards.

Windows around one anchor overlap, so what they cover together is one span. An anchor with more than HOT different
surroundings (a string in a great many documents) is not merged in one task: its windows are counted one by one by digest.

Defined results: texts are their UTF-8 bytes; a null text has none; matches do not cross documents; each row is a document
of its own, whatever its id, so repeated rows repeat each other; an empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.storage import prepare, stored, stored_by
from ledgerlake.llm.text import _BYTE_VALUES, _down, _up, in_parts, mix, slices, text_bytes

LENGTH = 400
#: Bytes of an anchor.
GRAM = 96
#: Different surroundings of one anchor that one task may merge.
HOT = 1 << 16
#: Bytes of surroundings in a sorted run, and in the part that one task merges (on average).
RUN, PART = 1 << 23, 1 << 22
#: Longer documents are looked at in stretches of so many windows.
STRETCH = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)

_ANCHORS = "gram long, around long, place long, at long, most int, least int"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: document, place in it, offsets in its first and last window, fingerprints of gram and surroundings."""
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= length)
    if not len(long):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _up(n), out=total[1:])
    back = _down(n + 1)
    grams = mix((total[gram:] - total[:-gram]) * back[: n - gram + 1])
    least = _sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
    count = sizes[long] - length + 1
    window = np.repeat(offsets[long] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    at = (least[window] & _PLACE).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = window[begin], window[np.append(begin[1:], len(window)) - 1]
    at = at[begin]
    around = slices(data, first, last + length)
    owner = np.searchsorted(offsets, first, "right") - 1
    return owner, at - offsets[owner], at - first, at - last, grams[at], around


def _find(length: int, gram: int):
    names = ["gram", "around", "place", "at", "most", "least"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for few in in_parts(batch):
                data, offsets = text_bytes(few.column("text"))
                place = few.column("place").to_numpy()
                stretches = [(data, offsets, 0)]
                if len(data) > 2 * STRETCH:  # one document, then
                    stretches = [(s := data[c : c + STRETCH + length - 1], np.array([0, len(s)]), c) for c in range(0, max(1, len(data) - length + 1), STRETCH)]
                for part, own, before in stretches:
                    owner, at, most, least, grams, around = anchors(part, own, length, gram)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grams.view(np.int64)), pa.array(around.view(np.int64)), pa.array(place[owner]), pa.array(at + before), pa.array(most.astype(np.int32)), pa.array(least.astype(np.int32))],
                        names=names,
                    )

    return make


def common(a: bytes, b: bytes, known: int) -> int:
    """Bytes that two strings share at their beginning, of which `known` are known."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


class LoserTree:
    """Merge of sorted runs of (shared with the one before, string, what goes with it).

    Iterating yields the strings in order: (shared with the last one, string, what goes with it). A contender's count of
    bytes shared with the last winner is always known; contenders with different counts are not compared, those with
    equal ones only beyond it.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, object]]]):
        self.runs = runs
        self.size = 1 << max(0, len(runs) - 1).bit_length()
        self.heads: list = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.shared = [0] * self.size
        self.losers = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, loser = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.losers[node] = loser
        return winner

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's count becomes that with the winner, who will be the next to leave."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        n = common(x[1], y[1], self.shared[a])
        if x[1][n:] <= y[1][n:]:
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes, object]]:
        while self.heads[self.winner] is not None:
            w = self.winner
            _, key, more = self.heads[w]
            yield self.shared[w], key, more
            self.heads[w] = head = next(self.runs[w], None)
            self.shared[w] = head[0] if head is not None else 0
            node = (w + self.size) >> 1
            while node:
                w, self.losers[node] = self._play(w, self.losers[node])
                node >>= 1
            self.winner = w


def front_coded(entries: list[tuple[bytes, object]]) -> bytes:
    """A sorted run, each string without what it shares with the one before."""
    shared, rest, before = [], [], b""
    for key, _ in entries:
        n = common(before, key, 0)
        shared.append(n)
        rest.append(key[n:])
        before = key
    return pickle.dumps((shared, rest, [more for _, more in entries]), protocol=5)


def decoded(run: bytes) -> Iterator[tuple[int, bytes, object]]:
    before = b""
    for n, rest, more in zip(*pickle.loads(run), strict=True):
        before = before[:n] + rest
        yield n, before, more


def _runs(length: int, parts: int):
    """Sorted runs of the suffixes at the wanted anchors, one for each part, front-coded."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes, tuple]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            held.sort(key=lambda e: e[:2])
            by_part: dict[int, list] = {}
            for part, key, more in held:
                by_part.setdefault(part, []).append((key, more))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(by_part), pa.int64()), pa.array([front_coded(e) for e in by_part.values()], pa.binary())], names=["part", "run"])

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_buffer()
                text = memoryview(text) if text is not None else b""
                for x in batch.column("wanted")[i].as_py():
                    at, most, least = x["at"], x["most"], x["least"]
                    suffix, before = bytes(text[at : at + length - least]), bytes(text[at - most : at])
                    held.append((x["gram"] % parts, suffix, (before, x["gram"], x["around"], x["n"])))
                    size += len(suffix) + len(before) + 100
                    if size > RUN:
                        yield flush()
                        size = 0
        if held:
            yield flush()

    return make


def repeated_offsets(shared: np.ndarray, suffixes: list[bytes], befores: list[bytes], counts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in order (whole sets of anchors): the largest and smallest offset of a repeated window, -1 without."""
    n = len(suffixes)
    most = np.fromiter(map(len, befores), np.int64, n)
    least = length - np.fromiter(map(len, suffixes), np.int64, n)
    same = np.cumsum(shared < gram)  # number of the anchor
    # The bytes before the anchors, backwards: order, and what neighbours in it share.
    flipped = [b[::-1] for b in befores]
    order = np.array(sorted(range(n), key=lambda i: (same[i], flipped[i])))
    behind = np.zeros(n, np.int64)
    for i in range(1, n):
        a, b = order[i - 1], order[i]
        behind[i] = common(flipped[a], flipped[b], 0) if same[a] == same[b] else -1
    high, low = np.full(n, -1), np.full(n, -1)
    group = np.empty(n, np.int64)
    for o in range(int(least.min()), int(most.max()) + 1):
        own = np.flatnonzero((least <= o) & (o <= most))
        if not len(own):
            continue
        right = np.cumsum(shared < length - o)
        group[order] = np.cumsum(behind < o)
        key = right[own] * np.int64(n + 1) + group[own]
        _, which = np.unique(key, return_inverse=True)
        again = own[np.bincount(which, counts[own])[which] >= 2]
        high[again] = o
        low[again] = np.where(low[again] < 0, o, low[again])
    return high, low


def _merged(length: int, gram: int, together: int = 1 << 14):
    """The runs of each part, merged: of each anchor's surroundings, the offsets of its outermost repeated windows."""

    def extents(rows: list) -> pa.RecordBatch:
        shared, suffixes, more = zip(*rows, strict=True)
        befores, grams, around, counts = zip(*more, strict=True)
        high, low = repeated_offsets(np.array(shared), list(suffixes), list(befores), np.array(counts), length, gram)
        found = np.flatnonzero(high >= 0)
        pick = lambda values: pa.array(np.array(values, np.int64)[found])
        return pa.RecordBatch.from_arrays([pick(grams), pick(around), pick(high), pick(low)], names=["gram", "around", "high", "low"])

    def merge(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        for shared, suffix, more in LoserTree([decoded(r) for r in runs]):
            if shared < gram and len(rows) >= together:
                yield extents(rows)
                rows = []
            rows.append((shared if rows else 0, suffix, more))
        if rows:
            yield extents(rows)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = None, []
        for batch in batches:
            for p, run in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist(), strict=True):
                if p != part and runs:
                    yield from merge(runs)
                    runs = []
                part = p
                runs.append(run)
        if runs:
            yield from merge(runs)

    return make


def _windows(length: int):
    """Every window of the wanted anchors by digest."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = memoryview(batch.column("text")[i].as_buffer())
                for x in batch.column("wanted")[i].as_py():
                    offsets = range(x["least"], x["most"] + 1)
                    digests = [hashlib.blake2b(text[x["at"] - o : x["at"] - o + length], digest_size=16).digest() for o in offsets]
                    k = len(digests)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x["gram"]] * k, pa.int64()), pa.array([x["around"]] * k, pa.int64()), pa.array([x["n"]] * k, pa.int64()), pa.array(list(offsets), pa.int64()), pa.array(digests, pa.binary())],
                        names=["gram", "around", "n", "offset", "digest"],
                    )

    return make


_EXTENT = "gram long, around long, high long, low long"


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """texts (place, text) -> place, spans: the maximal runs of its bytes that lie in repeated strings, as (start, end), in order."""
    prepare(texts.sparkSession)
    found = stored(texts.select("place", "text").mapInArrow(_find(length, gram), _ANCHORS), "anchors")
    often = found.groupBy("gram").agg(F.count("*").alias("total")).filter("total > 1").select("gram")
    often = often.select(F.bitwise_not("gram").alias("key"))
    found = stored(found.withColumn("key", F.bitwise_not("gram")).join(often, "key", "left_semi").drop("key"), "repeated_anchors")
    around = found.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(F.struct("place", "at", "most", "least")).alias("one"))
    around = around.select("gram", "around", "n", "one.*")
    # The join goes by the complement of the gram, which the count's shuffle does not serve: so the rows of a very common gram can be split.
    different = around.groupBy("gram").agg(F.count("*").alias("different")).select(F.bitwise_not("gram").alias("key"), "different")
    wanted = stored(around.withColumn("key", F.bitwise_not("gram")).join(different, "key").drop("key"), "surroundings")
    some, hottest = wanted.agg(F.count("*"), F.max("different")).first()
    parts = max(1, int(-(-some * 2 * length // PART)))

    def at_hand(rows: DataFrame) -> DataFrame:
        lists = rows.groupBy("place").agg(F.collect_list(F.struct("gram", "around", "n", "at", "most", "least")).alias("wanted"))
        return texts.select("place", "text").join(lists, "place").select(F.col("text").cast("binary").alias("text"), "wanted")

    runs = at_hand(wanted.filter(F.col("different") <= hot)).mapInArrow(_runs(length, parts), "part long, run binary")
    merged = runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_merged(length, gram), _EXTENT)
    if (hottest or 0) > hot:
        windows = at_hand(wanted.filter(F.col("different") > hot)).mapInArrow(_windows(length), "gram long, around long, n long, offset long, digest binary")
        again = windows.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 1").select("digest")
        counted = windows.join(again, "digest").groupBy("gram", "around").agg(F.max("offset").alias("high"), F.min("offset").alias("low"))
        merged = merged.unionByName(counted)
    spans = found.join(merged, ["gram", "around"]).select("place", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"))
    # Spans that touch are one: a span begins one where it lies behind all before it.
    ordered = Window.partitionBy("place").orderBy("start", "end")
    before = F.max("end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    runs_of = spans.withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("run", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    merged_spans = runs_of.groupBy("place", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged_spans.groupBy("place").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))


def repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Each row of documents as a struct `row`, with the maximal runs of its bytes that lie in repeated strings: spans."""
    # Texts move once, into buckets; both joins with them then move only numbers.
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = stored_by(documents.select(F.monotonically_increasing_id().alias("place"), F.struct("*").alias("row")), "place", "rows", size)
    found = repeated_spans(rows.select("place", F.col("row.text").alias("text")), length, gram, hot)

    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return rows.select("place", "row").join(found, "place", "left").select("row", F.coalesce("spans", none).alias("spans"))


def kept_bytes(rows: DataFrame) -> DataFrame:
    """Rows of repeats() with the bytes that stay: row, spans, kept."""
    prepare(rows.sparkSession)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, spans in zip(batch.column("row").field("text").cast(pa.binary()), batch.column("spans").to_pylist(), strict=True):
                text = text.as_py() or b""
                edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("spans"), pa.array(kept, pa.binary())], names=["row", "spans", "kept"])

    return rows.mapInArrow(make, StructType(rows.schema.fields + StructType.fromDDL("kept binary").fields))
