import random
import re

import pytest

from ledgerlake.llm import near_dedup
from ledgerlake.llm.near_dedup import near_duplicates


def plain(rows, words, percent):
    """Every pair, on sets of word tuples."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[j][0] is not None
            if same and sets[i] and sets[j] and (100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) or rows[i][0] == rows[j][0]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def corpus(seed, groups):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(400)]
    texts = []
    for size, edits, length in groups:
        base = [rng.choice(vocabulary) for _ in range(length)]
        texts.append(" ".join(base))
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts, 10))


ODD = [(500, None), (501, ""), (502, " \t"), (503, "one two"), (504, "ONE two"), (505, "one"), (None, "one two"), (None, None), (506, "a b c d"), (506, "a b c d"), (507, "x y z q"), (507, "a b c d e"), (508, "u " * 5000)]


@pytest.mark.parametrize("words", [4, 5])
def test_against_every_pair(frame, words):
    rows = corpus(words, [(12, 6, 120), (30, 9, 160), (5, 0, 40), (1, 1, 300), (8, 14, 200)] + [(0, 0, 60)] * 20) + ODD
    df = frame("doc_id long, text string, kept string", [(d, t, "x") for d, t in rows])
    got = near_duplicates(df, words=words).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain(rows, words, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_center_that_links_to_few(frame):
    """Copies far from each other are tied by one text that is near to all, with a large id."""
    rng = random.Random(5)
    base = [f"v{i}" for i in range(400)]
    rows = []
    for d in range(25):
        copy = list(base)
        for k in rng.sample(range(400), 10):
            copy[k] = f"n{d}x{k}"
        rows.append((d, " ".join(copy)))
    rows.append((99, " ".join(base)))
    got = near_duplicates(frame("doc_id long, text string", rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain(rows, 4, 80)


def test_empty_table(frame):
    assert near_duplicates(frame("doc_id long, text string", [])).count() == 0


def test_pigeonhole_holds():
    assert near_dedup.SYMBOLS % near_dedup.CHUNK == 0 and near_dedup.DISTANCE < 2 * near_dedup.SYMBOLS // near_dedup.CHUNK
