"""Chat formatting: conversations as budgeted, turn-aligned windows with a loss mask.

A conversation's turns are written one after the other; running sums of their tokens tell where a window must end, always
between turns. Every later window repeats the system turn and the last turns before it, up to HISTORY tokens. The mask
covers the assistant texts that a window has first; what is repeated is outside, so each text is learnt from once.

Control strings inside texts get a backslash after their first character (one more, if they have some already), which is
undone exactly when a window is read back. Roles are written on one line.

A conversation is a chain, as each window depends on the turns before; its rows stream through one task in order, and
memory is bounded by a window and the longest turn, not by the conversation.

Defined results: null texts and roles are empty; turns are ordered by turn (nulls first), role and text, repeated rows stay; rows
without conv_id are one conversation; a turn that does not fit is a window of its own, marked over_budget, never cut;
only a conversation's first turn is its system turn; an empty table gives no windows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.packing import encoder
from ledgerlake.llm.storage import prepare
from ledgerlake.llm.text import text_bytes

#: Tokens of a window, and of the turns that it repeats.
BUDGET, HISTORY = 2048, 256
#: Tokens that a turn's marks count for.
MARKS = 4

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Strings that steer chat models.
CONTROL = [BEGIN, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_RAW = re.compile("|".join(rf"{re.escape(c[0])}\\*{re.escape(c[1:])}" for c in CONTROL))
_ESCAPED = re.compile("|".join(rf"{re.escape(c[0])}\\+{re.escape(c[1:])}" for c in CONTROL))
_TURN = re.compile(rf"{re.escape(BEGIN)}(.*?)\n(.*?){re.escape(END)}\n", re.S)


def escaped(text: str) -> str:
    return _RAW.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


def _role(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_back(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role), flags=re.S)


def _written(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text lies in it."""
    head, body = f"{BEGIN}{_role(role)}\n", escaped(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


class _Conversation:
    """The windows of one conversation, turn by turn."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple[str, int] | None = None
        self.recent: deque[tuple[str, int]] = deque()
        self.total = self.number = self.turns = 0
        self._begin(first=True)

    def _begin(self, first: bool) -> None:
        repeated = [] if first or self.system is None else [self.system]
        repeated += [] if first else list(self.recent)
        self.parts = [p for p, _ in repeated]
        self.chars = self.new_from = sum(map(len, self.parts))
        self.start = self.total - sum(t for _, t in repeated)  # the window's tokens are total - start
        self.mask: list[dict] = []
        self.new = 0

    def _end(self) -> dict:
        row = {
            "conv_id": self.conv_id, "window": self.number, "text": "".join(self.parts), "new_from": self.new_from,
            "n_turns": self.new, "n_tokens": self.total - self.start, "mask": self.mask, "over_budget": self.total - self.start > self.budget,
        }
        self.number += 1
        return row

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """The window that this turn ends, if it does not fit there."""
        done = None
        if self.new and self.total + tokens - self.start > self.budget:
            done = self._end()
            self._begin(first=False)
            if self.total + tokens - self.start > self.budget:  # room for the turn rather than for history
                self.recent.clear()
                self._begin(first=False)
        turn, a, b = _written(role, text)
        if role == "assistant":
            self.mask.append({"start": self.chars + a, "end": self.chars + b})
        self.parts.append(turn)
        self.chars += len(turn)
        self.total += tokens
        self.new += 1
        if self.turns == 0 and role == "system":
            self.system = (turn, tokens)
        else:
            self.recent.append((turn, tokens))
            while sum(t for _, t in self.recent) > self.history:
                self.recent.popleft()
        self.turns += 1
        return done

    def last(self) -> dict:
        return self._end()


_WINDOW = (
    "conv_id long, window long, text string, new_from long, n_turns long, n_tokens long,"
    " mask array<struct<start: long, end: long>>, over_budget boolean"
)
_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("new_from", pa.int64()), ("n_turns", pa.int64()), ("n_tokens", pa.int64())]
    + [("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("over_budget", pa.bool_())]
)


def formatted(conversations: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> windows: text, mask (code points), new_from: where new turns begin."""
    prepare(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            out = []
            data, offsets = text_bytes(batch.column("text"))
            tokens = np.diff(encoder(tokenizer).encode(data, offsets)[1]) + MARKS
            for conv_id, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), tokens.tolist(), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        out.append(now.last())
                    now = _Conversation(conv_id, budget, history)
                if (done := now.add(role, text, n)) is not None:
                    out.append(done)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.last()], schema=_SCHEMA)

    return rows.mapInArrow(make, _WINDOW)


def read_back(text: str, new_from: int) -> list[tuple[str, str]]:
    """The new turns (role, text) of a window."""
    return [(_role_back(m[1]), unescaped(m[2])) for m in _TURN.finditer(text, new_from)]


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def digests(windows: DataFrame) -> DataFrame:
    """What reading the windows back gives for each conversation, as counts and digests."""
    prepare(windows.sparkSession)
    rows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window").select("conv_id", "text", "new_from", "mask")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict | None = None
        done: list[dict] = []

        def close() -> None:
            done.append(now | {"turns_sha256": now["turns_sha256"].hexdigest(), "loss_sha256": now["loss_sha256"].hexdigest()})

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [c.split()[0] for c in _DIGEST.split(", ")]
            found = pa.RecordBatch.from_pylist(done, schema=pa.schema(list(zip(names, kinds, strict=True))))
            done.clear()
            return found

        for batch in batches:
            for conv_id, text, new_from, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "new_from", "mask")), strict=True):
                if now is None or now["conv_id"] != conv_id:
                    if now is not None:
                        close()
                    now = {"conv_id": conv_id, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(), "formatted_chars": 0, "n_windows": 0}
                for role, own in read_back(text, new_from):
                    now["n_turns"] += 1
                    now["turns_sha256"].update(f"{role}\n{own}\n".encode())
                for span in mask:
                    own = unescaped(text[span["start"] : span["end"]])
                    now["loss_chars"] += len(own)
                    now["loss_sha256"].update(own.encode())
                now["formatted_chars"] += len(text)
                now["n_windows"] += 1
            if done:
                yield batch_of()
        if now is not None:
            close()
            yield batch_of()

    return rows.mapInArrow(make, _DIGEST)
