"""Words whose sums of powers modulo 2^64 are equal: the Thue-Morse word over a, b and its mirror image."""

import random

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from ledgerlake.llm.decontamination import contamination
from ledgerlake.llm.near_dedup import near_duplicates
from ledgerlake.llm.packing import Encoder
from ledgerlake.llm.repeats import kept_bytes, repeats
from ledgerlake.llm.text import fingerprints, quick_fingerprints, same_slices, slices, text_bytes
from ledgerlake.llm.toxicity import bags


def morse(n):
    s = "a"
    while len(s) < n:
        s += s.translate(str.maketrans("ab", "ba"))
    return s, s.translate(str.maketrans("ab", "ba"))


A, B = morse(1024)


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_fingerprints_differ(n):
    data, offsets = text_bytes(pa.array(morse(n)))
    quick = quick_fingerprints(data, offsets[:-1], offsets[1:])
    assert n == 512 or quick[0] == quick[1]  # what the others are held against
    own = fingerprints(data, offsets[:-1], offsets[1:])
    assert own[0] != own[1]
    assert len({*fingerprints(np.concatenate([data, data]), *(np.arange(0, 3 * n, n) + k for k in (0, n))).tolist()}) == 2


def test_fingerprints_of_long_slices():
    data = np.random.default_rng(1).integers(0, 256, 3_000_000).astype(np.uint8)
    starts, ends = np.array([0, 5, 2_500_000]), np.array([5, 2_400_000, 2_999_990])
    assert (fingerprints(data, starts, ends) == slices(data, starts, ends)).all()
    moved = np.concatenate([data[7:12], data[5:2_400_000]])
    assert fingerprints(moved, np.array([5]), np.array([len(moved)]))[0] == fingerprints(data, starts, ends)[1]


def test_same_slices():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 2, 4000).astype(np.uint8) for _ in range(2))
    lengths = rng.integers(0, 6, 700)
    x, y = (np.array([rng.integers(0, 4000 - n) for n in lengths]) for _ in range(2))
    for block in (1, 50, 1 << 20):
        got = same_slices(a, x, b, y, lengths, block)
        assert got.tolist() == [bytes(a[i : i + n]) == bytes(b[j : j + n]) for i, j, n in zip(x, y, lengths, strict=True)]


def test_packing():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, own = Tokenizer.from_file(path), Encoder(path)
    for texts in ([A, B], [f"x {B} y", f"{A} {A}", "", f"z {B}"], ["don't " + A, B + "'s", B]):
        ids, begins = own.encode(*text_bytes(pa.array(texts)))
        assert [list(ids[begins[i] : begins[i + 1]]) for i in range(len(texts))] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_decontamination(frame):
    docs = frame("doc_id long, text string", [(1, A), (2, B), (3, f"one {A} two"), (4, f"one {B} two"), (5, f"{A} {B}")])
    found = lambda items: {r.doc_id: (r.n_hit, r["items"]) for r in contamination(docs, frame("item_id string, text string", items)).select("row.doc_id", "n_hit", "items").collect()}
    assert found([("i", A)]) == {1: (1, ["i"]), 2: (0, []), 3: (1, ["i"]), 4: (0, []), 5: (1, ["i"])}
    assert found([("i", A), ("j", B)]) == {1: (1, ["i"]), 2: (1, ["j"]), 3: (1, ["i"]), 4: (1, ["j"]), 5: (2, ["i", "j"])}


def test_near_duplicates(frame):
    rows = [(1, A), (2, B), (3, f"{A} x y z"), (4, f"{B} x y z"), (5, f"{A} x y z")]
    assert {r.doc_id: r.component_id for r in near_duplicates(frame("doc_id long, text string", rows)).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 3}


def test_suffix_dedup(frame):
    from test_repeats import plain

    rng = random.Random(2)
    some = lambda n: "".join(rng.choice("cdefg ") for _ in range(n))
    rows = [(1, some(500) + A + some(500)), (2, some(500) + B + some(500)), (3, A), (4, B + some(10))]
    got = kept_bytes(repeats(frame("doc_id long, text string", rows))).select("row.doc_id", "spans", "kept").collect()
    assert sorted(((r.doc_id, len(r.spans), bytes(r.kept)) for r in got), key=repr) == plain(rows, 400)


def test_toxicity_features():
    words = [set(bags(*text_bytes(pa.array([t]))).words.tolist()) for t in (A, B)]
    assert not words[0] & words[1]
