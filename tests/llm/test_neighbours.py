import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm.neighbours import nearest


def plain(rows, k, every):
    ids = np.array([i for i, _ in rows])
    x = np.array([np.float32(v) for _, v in rows], dtype=np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for q in sorted({i for i in ids if i % every == 0}):
        best = {}
        for a in np.flatnonzero(ids == q):
            for i, s in zip(ids, x @ x[a] / (norm * norm[a]), strict=True):
                if i != q:
                    best[i] = max(best.get(i, -9), s)
        out[q] = sorted(best.items(), key=lambda e: (-round(e[1], 9), e[0]))[:k]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


def vectors(n, seed, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, 16))
    x = (centers[rng.integers(0, 5, n)] + 0.7 * rng.normal(size=(n, 16))).astype(np.float32)
    x[n - copies :] = x[0]
    return [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("n,copies", [(3, 0), (40, 10), (600, 200)])
def test_small_tables_are_exact(frame, n, copies):
    rows = vectors(n, n, copies)
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [float("inf")] + [1.0] * 15), (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, []), (None, rows[0][1]), rows[1], rows[1]]
    df = frame("vec_id long, embedding array<float>, score string", [(i, v, "x") for i, v in rows + odd])
    got, wanted = by_query(nearest(df, F.col("vec_id") % 10 == 0)), plain(rows, 5, 10)
    assert set(got) == set(wanted)
    hits = 0
    for q, near in wanted.items():
        assert len(got[q]) == len(near)
        assert got[q] == sorted(got[q], key=lambda e: (-e[1], e[0]))
        hits += len({i for i, _ in got[q]} & {i for i, _ in near})
    assert hits >= 0.99 * sum(map(len, wanted.values()))


def test_recall_of_larger_table(frame):
    rows = vectors(5000, 2)
    df = frame("vec_id long, embedding array<float>", rows)
    got, wanted = by_query(nearest(df, F.col("vec_id") % 50 == 0)), plain(rows, 5, 50)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in near}) / 5 for q, near in wanted.items()]) >= 0.9
    for q, near in got.items():
        exact = dict(plain([rows[q]] + [rows[i] for i, _ in near], 5, 50)[q]) if q % 50 == 0 else {}
        assert all(abs(s - exact[i]) < 1e-12 for i, s in near if i in exact)


def test_copies_of_the_query_come_first(frame):
    rows = vectors(300, 5, 150)
    got = by_query(nearest(frame("vec_id long, embedding array<float>", rows), F.col("vec_id") % 50 == 0))
    assert [i for i, _ in got[200]] == [0, 150, 151, 152, 153] and [i for i, _ in got[150]] == [0, 151, 152, 153, 154]


def test_empty_table(frame):
    assert nearest(frame("vec_id long, embedding array<float>", []), F.lit(True)).count() == 0


def test_doubles_at_the_edges(frame):
    """Tiny and huge components give the cosines of the same vectors in common sizes, bit for bit."""
    rng = np.random.default_rng(8)
    usual = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(12)]
    want = by_query(nearest(frame("vec_id long, embedding array<double>", usual), F.lit(True)))
    for power in (-1000, 900):
        rows = [(i, [float(np.ldexp(x, power)) for x in v]) for i, v in usual]
        assert by_query(nearest(frame("vec_id long, embedding array<double>", rows), F.lit(True))) == want
    mixed = [(0, [1e-200, 2e-200]), (1, [1e200, 2e200]), (2, [5e-324, 0.0]), (3, [1.7e308, -1.7e308])]
    got = by_query(nearest(frame("vec_id long, embedding array<double>", mixed), F.lit(True)))
    assert abs(dict(got[0])[1] - 1) < 1e-12 and abs(dict(got[2])[3] - 0.5**0.5) < 1e-12


def test_lengths_are_searched_apart(frame):
    short, long = vectors(30, 3), [(100 + i, v + [1.0]) for i, v in vectors(25, 4)]
    both = [(3, [1.0] * 17), *short, *long]  # id 3 has vectors of two lengths
    got = by_query(nearest(frame("vec_id long, embedding array<float>", both), F.col("vec_id") % 5 == 0))
    alone = by_query(nearest(frame("vec_id long, embedding array<float>", short), F.col("vec_id") % 5 == 0))
    apart = by_query(nearest(frame("vec_id long, embedding array<float>", [both[0], *long]), F.col("vec_id") % 5 == 0))
    assert got == alone | apart
