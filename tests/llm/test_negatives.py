import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import negatives
from ledgerlake.llm.negatives import PRIMES, hard_negatives, primes_for, product, residues

SCHEMA = "vec_id long, embedding array<double>, label int"


def mined(df, **more):
    return hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), **more)


def brute(rows, positives=5, k=3, low=50, high=95):
    """rows of (vec_id, embedding, label): plain integers, all pairs, sorting."""
    fine = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        if sum(x * 256 * (x * 256) for x in e) >= 2.0**61:
            continue
        own = (label, [math.floor(x * 256) for x in e])
        fine[i] = min(fine.get(i, own), own)
    out = set()
    for a, (label, q) in fine.items():
        if a % 5:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, r, strict=True)), i, m) for i, (m, r) in fine.items() if i != a and len(r) == len(q))
        for s, i, _ in [x for x in scores if x[2] == label][:positives]:
            fits = [x for x in scores if x[2] != label and low * -s <= 100 * -x[0] <= high * -s][:k]
            out |= {(a, i, n, x[1], -s, -x[0]) for n, x in enumerate(fits, 1)}
    return out


def found(df):
    rows = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize(("depth", "most"), [(0, 1), (1, 5), (7, 300), (64, 2**15), (700, 2**15), (300, 2**25), (3, 2**29)])
def test_products_are_exact(depth, most):
    rng = np.random.default_rng(depth)
    a, b = rng.integers(-most, most + 1, (9, depth)), rng.integers(-most, most + 1, (11, depth))
    if depth:
        a[0], b[0] = most, -most
        a[1], b[1] = -most, -most
    longest = max(int((x.astype(object) ** 2).sum(axis=1).max()) for x in (a, b)) if depth else 0
    primes = primes_for(longest)
    got = product(residues(a, primes), residues(b, primes), primes)
    assert (got.astype(object) == a.astype(object) @ b.astype(object).T).all()


def test_primes():
    assert all(p < 510 and all(p % q for q in range(2, p)) for p in PRIMES) and len(set(PRIMES)) == len(PRIMES)
    assert math.prod(PRIMES) > 2**64 and negatives.DEPTH * 254**2 < 2**24
    for most in (0, 1, 254, 10**5, 2**62):
        assert math.prod(primes_for(most)) > 2 * most + 1


def made(n, seed, dims=6, labels=4):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-0.6, 1.0) for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("anchor_bytes", [1, 400, 1 << 24])
def test_against_brute_force_in_blocks(frame, anchor_bytes, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 16)
    rows = made(70, 1)
    if anchor_bytes == 1:
        rows = rows[:30]  # each anchor is a block of its own
    want = brute(rows)
    assert want and found(mined(frame(SCHEMA, rows).repartition(3), anchor_bytes=anchor_bytes)) == want


def test_ties_copies_and_repeated_rows(frame):
    rng = random.Random(7)
    few = [[rng.choice([0.25, 0.5, 1.0]) for _ in range(3)] for _ in range(6)]
    rows = [(i, rng.choice(few), rng.randrange(3)) for i in range(120)]  # a third and more share vector and label
    rows += [(i, few[0], 0) for i in range(120, 200)]
    rows += rows[:20] + [(3, few[1], 2), (5, few[2], 0)]  # repeated rows, and ids with several vectors
    want = brute(rows)
    assert want and found(mined(frame(SCHEMA, rows))) == want


def test_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    odd = [(None, [1.0, 1.0], 1), (10, None, 1), (15, [1.0, None], 1), (20, [nan, 1.0], 1), (25, [1.0, inf], 2), (30, [1.0, 1.0], None), (35, [1e300, 1.0], 1), (40, [1e7, 1.0], 1), (45, [0.0, 0.0], 1)]
    odd += [(50, [], 1), (51, [], 1), (52, [], 2), (55, [1.0, 2.0, 3.0], 1), (56, [1.0, 2.0, 2.9], 1), (57, [1.0, 1.5, 2.0], 2), (60, [-1.0, 0.0], 9), (61, [1.0, 0.0], 9)]
    rows = made(40, 3, dims=2) + [(i + 100 if i else i, e, m) for i, e, m in odd]
    want = brute(rows)
    got = found(mined(frame(SCHEMA, rows)))
    assert want and got == want
    assert any(r[0] == 150 for r in want) and any(r[0] == 155 for r in want)  # empty vectors, and those of another length
    assert found(mined(frame(SCHEMA, []))) == set()


def test_clashing_columns(frame):
    rows = [(*r, 1, 2, 3, "x") for r in made(30, 5)]
    df = frame(SCHEMA + ", q int, place int, score int, anchor_id string", rows)
    assert found(mined(df)) == brute([r[:3] for r in rows])
