"""Packing: token ids of all documents, concatenated and cut into windows of one length.

Two passes. The first turns every text into ids, and writes them in blocks with the place of each block among its
partition's tokens. Sums over partitions then give every block its place in the whole stream. The second pass cuts each
block on its own: windows that lie inside the block are complete; what it has of the windows at its two ends travels
as boundary records, which are put together by window. Only those records are shuffled.

Defined results: a null or empty text is the end id alone; a null doc_id is kept as null; repeated rows are documents of
their own; an empty table has no sequences; other columns are not read. A document may be longer than any window or block.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.storage import prepare, stored
from ledgerlake.llm.text import LOWER, Table, in_parts, quick_fingerprints, runs, same_slices, text_bytes, texts_of

LENGTH = 4096
END_ID = 2
#: Tokens in a block; a whole number of windows is not needed. Rows of a few hundred KB are easy on executors.
BLOCK = 1 << 16
#: Pieces whose ids a worker remembers; beyond it, those not met again are forgotten, and if that is not half, all.
REMEMBERED = 3 << 16

# Classes of bytes: white space, letter, digit, other ASCII; and what may join its neighbours into one token.
_SPACE, _LETTER, _DIGIT, _OTHER, _JOINS = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[128:] = _JOINS
_CLASS[ord("'")] = _JOINS


def _gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of values that begin at `starts`, one after the other."""
    at = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))]


class Encoder:
    """Ids of whole texts under a tokenizer that lower-cases, drops white space and never joins over it.

    Texts are cut at white space and, in words of plain ASCII, between letters, digits and marks, where this tokenizer
    never makes one token; equal pieces are encoded once: they are found by fingerprint, and their bytes compared. Words with
    apostrophes, other scripts or the look of a special token are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._empty()

    def _empty(self) -> None:
        self.table = Table(REMEMBERED // 2)
        self.keys = np.zeros(1 << 14, np.uint64)
        self.starts = np.zeros(1 << 14, np.int64)
        self.counts = np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)
        self.ids = np.zeros(1 << 16, np.int32)
        self.text = np.zeros(1 << 17, np.uint8)
        self.begins = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.known = self.used = self.written = 0

    def _forget(self) -> None:
        """Keep what has been met again since the last time."""
        met = np.flatnonzero(self.again[: self.known])
        keys, counts, lengths = self.keys[met], self.counts[met], self.lengths[met]
        ids, text = _gathered(self.ids, self.starts[met], counts), _gathered(self.text, self.begins[met], lengths)
        self._empty()
        if len(met) <= REMEMBERED // 2:
            self._put(keys, counts, ids, lengths, text)

    def _put(self, keys: np.ndarray, counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> None:
        n, used, written = self.known + len(keys), self.used + len(ids), self.written + len(text)
        if n > len(self.keys):
            self.keys, self.starts, self.counts, self.again, self.begins, self.lengths = (
                np.concatenate([x, np.zeros(n, x.dtype)]) for x in (self.keys, self.starts, self.counts, self.again, self.begins, self.lengths)
            )
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(used, np.int32)])
        if written > len(self.text):
            self.text = np.concatenate([self.text, np.zeros(written, np.uint8)])
        self.keys[self.known : n], self.counts[self.known : n], self.lengths[self.known : n] = keys, counts, lengths
        self.starts[self.known : n] = self.used + np.cumsum(counts) - counts
        self.begins[self.known : n] = self.written + np.cumsum(lengths) - lengths
        self.ids[self.used : used] = ids
        self.text[self.written : written] = text
        self.table.add(keys, np.arange(self.known, n))
        self.known, self.used, self.written = n, used, written

    def _ids(self, pieces: list[bytes], simple: np.ndarray) -> list:
        model, whole = self.tokenizer.model, self.tokenizer.encode_batch_fast
        found: list = [None] * len(pieces)
        rest = []
        for i, piece in enumerate(pieces):
            if simple[i]:
                found[i] = [t.id for t in model.tokenize(piece.decode())]
            else:
                rest.append(i)
        for i, e in zip(rest, whole([pieces[i].decode() for i in rest], add_special_tokens=False), strict=True):
            found[i] = e.ids
        return found

    def _learn(self, keys: np.ndarray, pieces: list[bytes], simple: np.ndarray) -> None:
        found = self._ids(pieces, simple)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self._put(keys, counts, np.fromiter((t for f in found for t in f), np.int32, int(counts.sum())), lengths, np.frombuffer(b"".join(pieces), np.uint8))

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes to look up, starts and ends of the pieces, and which are of one class of plain ASCII letters."""
        kind = _CLASS[data]
        starts, ends = runs(kind > _SPACE, offsets)
        odd = kind == _JOINS
        odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        total = np.concatenate([[0], np.cumsum(odd)])
        whole = total[ends] > total[starts]
        cuts = np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] > _SPACE) & (kind[:-1] > _SPACE)) + 1
        word = np.searchsorted(starts, cuts, "right") - 1
        cuts = cuts[~whole[word] & (starts[word] < cuts)]
        lower = LOWER[data]
        if whole.any():  # as they are: special tokens are told by their case
            step = np.zeros(len(data) + 1, np.int8)
            step[starts[whole]] += 1
            step[ends[whole]] -= 1
            lower = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, data, lower)
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
        simple = (kind[starts] == _LETTER) & (total[ends] == total[starts])
        return lower, starts, ends, simple

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's begin."""
        if self.known > REMEMBERED:
            self._forget()
        data, starts, ends, simple = self.pieces(data, offsets)
        keys = quick_fingerprints(data, starts, ends)
        slots = self.table.get(keys)
        if len(new := np.flatnonzero(slots < 0)):
            some, first = np.unique(keys[new], return_index=True)
            first = new[first]
            self._learn(some, [data[a:b].tobytes() for a, b in zip(starts[first], ends[first], strict=True)], simple[first] & self._alone(data, starts[first], ends[first]))
            known = slots[slots >= 0]
            slots[new] = self.table.get(keys[new])
        else:
            known = slots
        self.again[known] = True
        counts = self.counts[slots]
        other = self._other(data, starts, ends, slots)
        if len(other):
            return self._one_by_one(data, starts, ends, simple, slots, other, offsets)
        at = np.concatenate([[0], np.cumsum(counts)])
        return _gathered(self.ids, self.starts[slots], counts), at[texts_of(starts, offsets)]

    def _other(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Pieces that share a fingerprint with what is remembered in their slot, but not the bytes."""
        lengths = ends - starts
        same = lengths == self.lengths[slots]
        alike = np.flatnonzero(same)
        same[alike] = same_slices(data, starts[alike], self.text, self.begins[slots[alike]], lengths[alike])
        return np.flatnonzero(~same)

    def _one_by_one(self, data, starts, ends, simple, slots, other, offsets) -> tuple[np.ndarray, np.ndarray]:
        """What encode() gives, where some pieces are not those remembered: these are encoded anew."""
        found = self._ids([data[a:b].tobytes() for a, b in zip(starts[other], ends[other], strict=True)], simple[other] & self._alone(data, starts[other], ends[other]))
        ids = [self.ids[a : a + n] for a, n in zip(self.starts[slots], self.counts[slots], strict=True)]
        for k, own in zip(other, found, strict=True):
            ids[k] = np.array(own, np.int32)
        at = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        return np.concatenate(ids), at[texts_of(starts, offsets)]

    @staticmethod
    def _alone(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether a piece's last byte is a letter too: a word that is kept whole may only begin like one."""
        return _CLASS[data[ends - 1]] == _LETTER


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which keeps what it has learnt between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_BLOCKS = (
    "part int, block long, start long, n long, docs array<struct<doc_id: long, start: long, n: long, doc_tokens: long>>,"
    " ids binary, head binary, tail binary"
)


def _blocks(path: str, length: int, end_id: int, size: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, own = TaskContext.get().partitionId(), encoder(path)
        held: list[np.ndarray] = []
        docs: list[dict] = []
        state = {"n": 0, "block": 0, "start": 0}

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held).astype("<u4")
            row = {
                "part": part, "block": state["block"], "start": state["start"], "n": len(ids), "docs": list(docs),
                "ids": ids.tobytes(), "head": ids[:length].tobytes(), "tail": ids[-length:].tobytes(),
            }
            state.update(n=0, block=state["block"] + 1, start=state["start"] + len(ids))
            held.clear()
            docs.clear()
            return pa.RecordBatch.from_pylist([row], schema=schema)

        kind = pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("doc_tokens", pa.int64())])
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]
            + [("docs", pa.list_(kind))]
            + [(c, pa.binary()) for c in ("ids", "head", "tail")]
        )
        for batch in batches:
            for few in in_parts(batch):
                ids, begins = own.encode(*text_bytes(few.column("text")))
                for k, doc_id in enumerate(few.column("doc_id").to_pylist()):
                    own_ids = np.append(ids[begins[k] : begins[k + 1]], np.int32(end_id))
                    done = 0
                    while done < len(own_ids):
                        n = min(len(own_ids) - done, size - state["n"])
                        held.append(own_ids[done : done + n])
                        docs.append({"doc_id": doc_id, "start": done, "n": n, "doc_tokens": len(own_ids)})
                        done += n
                        state["n"] += n
                        if state["n"] == size:
                            yield flush()
        if state["n"]:
            yield flush()

    return make


_PIECE = "struct<doc_id: long, start: long, length: long, doc_tokens: long, offset: long, ids_crc32: long>"
_PIECES = f"array<{_PIECE}>"


def _pieces(docs: list[dict], ids: memoryview, at: int) -> list[dict]:
    """The pieces that documents have of some ids, which stand in a window from `at` on."""
    out, a = [], 0
    for d in docs:
        b = min(len(ids) // 4, a + d["n"])
        out.append({"doc_id": d["doc_id"], "start": d["start"], "length": b - a, "doc_tokens": d["doc_tokens"], "offset": at + a, "ids_crc32": zlib.crc32(ids[4 * a : 4 * b])})
        a = b
    return out


def _split(docs: list[dict], cuts: list[tuple[int, int]]) -> Iterator[list[dict]]:
    """The documents of each of the successive token ranges, in one walk."""
    places = np.cumsum([0] + [d["n"] for d in docs])
    for begin, end in cuts:
        i = int(np.searchsorted(places, begin, "right")) - 1
        j = int(np.searchsorted(places, end, "left"))
        yield [docs[i] | {"start": docs[i]["start"] + begin - int(places[i]), "n": docs[i]["n"] - (begin - int(places[i]))}, *docs[i + 1 : j]]


def _cut(length: int, whole: bool):
    """Windows inside the blocks, or what the blocks have of the windows at their ends."""
    piece = pa.struct([(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "offset", "ids_crc32")])
    schema = pa.schema([("sequence_id", pa.int64()), ("place", pa.int64()), ("pieces", pa.list_(piece)), ("ids", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("start", "n", "docs")}
                g, n = row["start"], row["n"]
                first, last = -(-g // length), (g + n) // length  # windows first..last-1 are complete
                if whole:
                    ids = np.frombuffer(batch.column("ids")[i].as_buffer(), "<u4")
                    places = [(w * length - g, (w + 1) * length - g) for w in range(first, last)]
                elif last < first:  # inside one window
                    ids, places = np.frombuffer(batch.column("head")[i].as_buffer(), "<u4"), [(0, n)]
                else:
                    places = [(a, b) for a, b in ((0, first * length - g), (last * length - g, n)) if a < b]
                rows = []
                for (a, b), docs in zip(places, _split(row["docs"], places), strict=True):
                    if not whole and last >= first:
                        tail = np.frombuffer(batch.column("tail")[i].as_buffer(), "<u4")
                        own = np.frombuffer(batch.column("head")[i].as_buffer(), "<u4")[:b] if a == 0 and b <= length and b < n else tail[len(tail) - (n - a) :]
                    else:
                        own = ids[a:b]
                    at = (g + a) % length
                    rows.append({"sequence_id": (g + a) // length, "place": at, "pieces": _pieces(docs, memoryview(data := own.tobytes()), at), "ids": data})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return make


def token_blocks(documents: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """First pass: the ids of all documents in blocks, written, each with its place in the whole stream."""
    blocks = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(_blocks(tokenizer, length, end_id, block), _BLOCKS), "token_blocks", long_rows=True)
    # One row of two numbers for each partition of the first pass: it fits everywhere.
    totals = blocks.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return blocks.join(F.broadcast(places), "part").withColumn("start", F.col("start") + F.col("base")).drop("base")


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """Sequences of `length` tokens (the last may have fewer): sequence_id, ids (unsigned 32-bit, little-endian), pieces.

    pieces: what each document has there, in order: doc_id, start among the document's ids, length, doc_tokens, offset,
    and the checksum of its ids.
    """
    if length > block:
        raise ValueError("a block must hold a window")
    prepare(documents.sparkSession)
    blocks = token_blocks(documents, tokenizer, length, end_id, block)
    kind = f"sequence_id long, place long, pieces {_PIECES}, ids binary"
    inside = blocks.select("start", "n", "docs", "ids").mapInArrow(_cut(length, True), kind)
    ends = blocks.select("start", "n", "docs", "head", "tail").mapInArrow(_cut(length, False), kind)
    parts = F.sort_array(F.collect_list(F.struct("place", "pieces", "ids")))  # of at most `length` tokens
    joined = ends.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.flatten("p.pieces").alias("pieces"),
        F.aggregate("p.ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)).alias("ids"),
    )
    return inside.select("sequence_id", "pieces", "ids").unionByName(joined)


def padded(sequences: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """Sequences as arrays of ids, filled up to `length`, but for one whose number of ids is a power of two."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("ids").to_pylist():
                ids = np.frombuffer(x, "<u4").astype(np.int32)
                full = len(ids) & (len(ids) - 1) == 0
                out.append(ids if full else np.concatenate([ids, np.full(length - len(ids), pad_id, np.int32)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), batch.column("pieces"), pa.array(out, pa.list_(pa.int32()))], names=["sequence_id", "pieces", "ids"]
            )

    prepare(sequences.sparkSession)
    return sequences.select("sequence_id", "pieces", "ids").mapInArrow(make, f"sequence_id long, pieces {_PIECES}, ids array<int>")


def piece_rows(sequences: DataFrame) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = sequences.select("sequence_id", F.explode("pieces").alias("p"))
    return rows.select(*(F.col(f"p.{c}") for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), "sequence_id", "p.offset")
