"""Strings as bytes: runs of characters, their 64-bit fingerprints, and a table keyed by them, all in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_FACTOR = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a bijection on 64 bits)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(_FACTOR))
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(base: int):
    kept = [np.ones(1, np.uint64)]

    def first(n: int) -> np.ndarray:
        if len(kept[0]) < n:
            grown = np.full(max(n, 2 * len(kept[0])), base, np.uint64)
            grown[0] = 1
            kept[0] = np.multiply.accumulate(grown)
        return kept[0][:n]

    return first


_up, _down = _powers(_FACTOR), _powers(_INVERSE)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins (one more at the end).

    A null text has no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def in_parts(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of about so many bytes; a longer row is a slice of its own."""
    sizes = np.diff(text_bytes(batch.column("text"))[1])
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = total[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values; no run crosses a text boundary."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last[begins[1:] - 1] = inside[begins[1:] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


#: Two polynomials over the prime 2^31 - 1, each with a base and byte values of its own.
_PRIME = (1 << 31) - 1
_BASES = (0x2545F491, 0x5851F42D)
_VALUES = [mix((np.arange(256, dtype=np.uint64) + np.uint64(256 * k + 1)) * np.uint64(_FACTOR)) % np.uint64(_PRIME - 1) + np.uint64(1) for k in range(2)]


def _fold(x: np.ndarray) -> np.ndarray:
    """The same modulo the prime, below 2^32 where x is below 2^62."""
    return (x & np.uint64(_PRIME)) + (x >> np.uint64(31))


def _residue(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= np.uint64(_PRIME), x - np.uint64(_PRIME), x)


def _prime_powers(base: int):
    kept = [np.ones(1, np.uint64)]

    def first(n: int) -> np.ndarray:
        while len(kept[0]) < n:
            kept[0] = np.concatenate([kept[0], _residue(kept[0] * np.uint64(pow(base, len(kept[0]), _PRIME)))])
        return kept[0][:n]

    return first


_RISING = [_prime_powers(b) for b in _BASES]
_FALLING = [_prime_powers(pow(b, -1, _PRIME)) for b in _BASES]


def _sealed(both: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(both + lengths.astype(np.uint64) * np.uint64(_FACTOR))


def slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same fingerprint of any slices, which may overlap, of bytes that are all summed at once."""
    both = np.zeros(len(starts), np.uint64)
    for k in range(2):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_fold(_VALUES[k][data] * _RISING[k](len(data))), out=total[1:])
        both += _residue(_residue(total[ends] - total[starts]) * _FALLING[k](len(data) + 1)[starts]) << np.uint64(31 * k)
    return _sealed(both, ends - starts)


def fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """A 64-bit fingerprint of each slice; slices are in order and do not overlap.

    It mixes two polynomials over a prime with the length. Equal slices have equal fingerprints; different ones may too, with
    a chance of about length^2 / 2^62, so whoever needs certainty compares bytes.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + block, "right")))
        part = data[base : int(ends[j - 1])]
        a, b = starts[i:j] - base, ends[i:j] - base
        if len(part) <= 2 * block:
            out[i:j] = slices(part, a, b)
            i = j
            continue
        both = 0
        for k in range(2):  # one very long slice, in steps
            sums, up = 0, _RISING[k](block)
            for at in range(0, len(part), block):
                step = part[at : at + block]
                sums += int(_residue(np.sum(_fold(_VALUES[k][step] * up[: len(step)]), keepdims=True))[0]) * pow(_BASES[k], at, _PRIME)
            both += (sums % _PRIME) << (31 * k)
        out[i] = _sealed(np.array([both], np.uint64), b - a)[0]
        i = j
    return out


def quick_fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 19) -> np.ndarray:
    """Fingerprints of a third of the work, for who compares bytes anyway: texts can be made whose words share one."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + block, "right")))
        part = data[base : int(ends[j - 1])]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[part] * _up(len(part)), out=total[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[b] - total[a]) * _down(len(part) + 1)[a]
        i = j
    return mix(out)


def same_slices(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Whether each slice of a has the bytes of its slice of b."""
    out = np.zeros(len(lengths), bool)
    total, i = np.cumsum(lengths), 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + block, "right")))
        n = lengths[i:j]
        first = np.cumsum(n) - n
        inner = np.arange(int(n.sum())) - np.repeat(first, n)
        apart = np.concatenate([[0], np.cumsum(a[np.repeat(a_starts[i:j], n) + inner] != b[np.repeat(b_starts[i:j], n) + inner])])
        out[i:j] = apart[first + n] == apart[first]
        i = j
    return out


def texts_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the starts lie before each text's begin: slice i:j of text k is [k] to [k + 1]."""
    return np.searchsorted(starts, offsets, "left")


class Table:
    """Fingerprint -> small number, looked up for whole arrays at a time (open addressing)."""

    def __init__(self, expected: int = 1 << 10):
        self._size(max(16, 1 << int(4 * expected).bit_length()))

    def _size(self, slots: int) -> None:
        self.mask = np.uint64(slots - 1)
        self.keys = np.zeros(slots, np.uint64)
        self.values = np.full(slots, -1, np.int64)
        self.count = 0

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = (keys & self.mask).astype(np.int64)
        out = self.values[at]
        left = np.flatnonzero((self.keys[at] != keys) & (out >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & int(self.mask)
            found = self.values[at]
            out[left] = found
            again = (self.keys[at] != keys[left]) & (found >= 0)
            at, left = at[again], left[again]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            held = self.values >= 0
            old = self.keys[held], self.values[held]
            self._size(4 * max(len(self.keys), 1 << int(len(keys)).bit_length()))
            self._place(*old)
        self._place(keys, values)

    def _place(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.count += len(keys)
        at = (keys & self.mask).astype(np.int64)
        while len(keys):
            free = self.values[at] < 0
            _, chosen = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            chosen = chosen[free[chosen]]
            self.keys[at[chosen]], self.values[at[chosen]] = keys[chosen], values[chosen]
            rest = np.ones(len(keys), bool)
            rest[chosen] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & int(self.mask)
