import random

import pytest

from ledgerlake.llm.repeats import LoserTree, decoded, front_coded, kept_bytes, repeats


def plain(rows, length):
    seen = {}
    texts = [(t or "").encode() for _, t in rows]
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen.setdefault(t[i : i + length], []).append((k, i))
    cover = [bytearray(len(t)) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                cover[k][i : i + length] = b"\1" * length
    out = []
    for (d, _), t, c in zip(rows, texts, cover, strict=True):
        spans = sum(1 for i in range(len(c)) if c[i] and (not i or not c[i - 1]))
        out.append((d, spans, bytes(x for x, y in zip(t, c, strict=True) if not y)))
    return sorted(out, key=repr)


def corpus(seed, length):
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    passages = [some(rng.randrange(length // 2, 3 * length)) for _ in range(8)] + [some(length - 1), some(length), "xy" * length]
    rows = [(0, None), (1, ""), (2, "q" * (length - 1)), (3, "q" * length), (4, "z" * (3 * length)), (5, "abab" * length), (None, some(2 * length))]
    for d in range(6, 60):
        rows.append((d, some(rng.randrange(0, 2 * length)).join(rng.choice(passages) for _ in range(rng.randrange(0, 4)))))
    for _ in range(15):  # cut out of a longer text at any place
        t = rng.choice(rows)[1] or ""
        a = rng.randrange(len(t) + 1)
        rows.append((rng.randrange(60), some(rng.randrange(30)) + t[a : a + rng.randrange(3 * length)] + some(rng.randrange(30))))
    return rows + rows[-3:]


@pytest.mark.parametrize("length,gram,hot", [(40, 10, 1 << 16), (40, 10, 3), (25, 25, 1 << 16), (60, 7, 1 << 16)])
def test_against_every_window(frame, length, gram, hot):
    rows = corpus(length + gram, length)
    df = frame("doc_id long, text string, spans string", [(d, t, "x") for d, t in rows]).repartition(4)
    got = kept_bytes(repeats(df, length, gram, hot)).select("row.doc_id", "spans", "kept").collect()
    assert sorted(((r.doc_id, len(r.spans), bytes(r.kept)) for r in got), key=repr) == plain(rows, length)


def test_production_length(frame):
    rng = random.Random(9)
    some = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "délta"]) + str(rng.randrange(1000)) for _ in range(n))
    shared = [some(60), some(45), some(200)]
    rows = [(d, f"{some(30)} {shared[d % 3]} {some(50)}") for d in range(30)] + [(90, some(4000)), (91, "line of text\n" * 500)]
    got = kept_bytes(repeats(frame("doc_id long, text string", rows))).select("row.doc_id", "spans", "kept").collect()
    assert sorted(((r.doc_id, len(r.spans), bytes(r.kept)) for r in got), key=repr) == plain(rows, 400)


def test_empty_table(frame):
    assert kept_bytes(repeats(frame("doc_id long, text string", []))).count() == 0


def test_merge_of_runs():
    rng = random.Random(4)
    for _ in range(50):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(1, 7))]
        got = list(LoserTree([decoded(front_coded([(k, None) for k in r])) for r in runs]))
        assert [k for _, k, _ in got] == sorted(k for r in runs for k in r)
        for (_, a, _), (n, b, _) in zip(got, got[1:], strict=False):
            assert n == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
