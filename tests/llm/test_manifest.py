import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import manifest as M
from ledgerlake.llm.manifest import manifest, packed, ranks, unpacked

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
NAMES = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """All levels of a tree over the nodes, two at a time."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def proof(tree, place):
    out = []
    for nodes in tree[:-1]:
        out.append(("", "".join(nodes[place + 1 : place + 2])) if place % 2 == 0 else (nodes[place - 1], ""))
        place //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]])
    top = climb([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for place, r in enumerate(groups[g]):
            path = proof(trees[g], place) + proof(top, at)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf((*r[:3], r[3] + 1 if bad and r[3] is not None else r[3], *r[4:]))
            for left, right in path:
                node = sha(left, node, right)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha(*(x for p in path for x in p)), node, node == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    more = [F.col(c) for c in NAMES]
    more[3] = F.col("n_chars").cast("decimal(20,0)") + 1
    rows = manifest(df, F.col("doc_id"), F.col("lang"), [F.col(c) for c in NAMES], more, F.crc32(F.col("doc_id").cast("string")) % 7 == 0)
    return sorted((tuple(r) for r in rows.select("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def row(rng, i, langs=("en", "de", None, "é", "zz")):
    return i, rng.choice(["a", None]), rng.choice(langs), rng.choice([None, 0, 7, 2**63 - 1]), rng.choice([None, "", "é|x", f"text {i}"])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 200])
def test_against_plain_trees(frame, n, monkeypatch):
    rng = random.Random(n)
    rows = [row(rng, i) for i in rng.sample([*range(500), -1, -70000, -(2**63), 2**63 - 1, 2**40, 2**40 + 1, 70000, 65535, 65536], n)]
    got = found(frame(SCHEMA, rows).repartition(3))
    assert got == brute(rows)
    assert n < 64 or {r[-1] for r in got} == {True, False}


def test_trees_over_several_blocks(frame):
    rng = random.Random(2)
    rows = [row(rng, i * 3, ["en", "en", "de"]) for i in range(2 * M.SLOTS + 1700)]
    assert found(frame(SCHEMA, rows).repartition(5)) == brute(rows)


def test_repeated_and_missing_ids(frame, monkeypatch):
    monkeypatch.setattr(M, "COPIES", 4)
    rng = random.Random(3)
    rows = [row(rng, i, ["en", None]) for i in range(60)]
    rows += rows[:9] + [rows[11]] * 23  # equal rows
    rows += [row(rng, rng.choice([3, 5, 11]), ["en", None]) for _ in range(40)]  # other rows under an id
    rows += [(None, "a", rng.choice(["en", None]), 1, rng.choice(["x", "y", None])) for _ in range(20)]
    rows += [(None, "a", "only null ids", 1, "x")] * 3
    assert found(frame(SCHEMA, rows).repartition(4)) == brute(rows)


def test_small_and_empty_tables(frame):
    assert found(frame(SCHEMA, [])) == []
    one = [(5, None, None, None, None)]
    assert found(frame(SCHEMA, one)) == brute(one)
    two = [(5, "s", "b", 1, "x"), (5, "s", "a", 1, "x")]
    assert found(frame(SCHEMA, two)) == brute(two)


def test_clashing_columns_and_long_texts(frame):
    rows = [(i, "s", "en", 1, "x" * (3_000_000 if i == 2 else 3)) for i in range(5)]
    df = frame(SCHEMA + ", leaf string, tree int, place int, none int, id string, size long, slots int", [(*r, "q", 1, 2, 3, "i", 4, 5) for r in rows])
    assert found(df) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 100, 4095, 4096, 30000, 65536])
def test_bitmap_ranks(n):
    low = np.sort(np.random.default_rng(n).choice(65536, n, replace=False))
    data = packed(low)
    assert (unpacked(data) == low).all() and len(data) <= 8192
    asked = np.arange(0, 65536, 7)
    assert (ranks(data, asked) == np.searchsorted(low, asked)).all()


def test_levels_and_folds():
    nodes = [sha(str(i)) for i in range(11)]
    tree = M.levels(nodes, M.height(11))
    assert len(tree[-1]) == 1 and tree[-1] == climb(nodes)[-1]
    assert all(M.folded(x, M.beside(tree, i)) == tree[-1][0] for i, x in enumerate(nodes))
    assert [M.height(n) for n in (1, 2, 3, 4, 5, 1024, 1025)] == [0, 1, 2, 2, 3, 10, 11]
