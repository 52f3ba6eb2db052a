import random
import re

import numpy as np
import pytest

from ledgerlake.llm.decontamination import contamination, without
from ledgerlake.llm.fm_index import FMIndex, suffix_array

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def plain(docs, items, window):
    windows = {}
    for name, text in items:
        w = WORD.findall(lowered(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if name is None else str(name))
    out = []
    for d, text in docs:
        matches = list(WORD.finditer(lowered(text)))
        w, hit, names = [m[0] for m in matches], set(), set()
        for v, own in windows.items():
            for i in range(len(w) - len(v) + 1):
                if tuple(w[i : i + len(v)]) == v:
                    hit.update(range(i, i + len(v)))
                    names |= own
        keep, at = [], 0
        for k, m in enumerate(matches):
            if k in hit:
                if k - 1 not in hit:
                    keep.append(text[at : m.start()])
                at = m.end()
        out.append((d, len(w), len(hit), tuple(sorted(names)), "".join(keep) + (text or "")[at:]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,blocks", [(10, 10**6), (4, 10**6), (4, 60)])
def test_against_plain_search(frame, window, blocks):
    rng = random.Random(window)
    vocabulary = ["a", "be", "É", "d4", "wörd", "the", "x"]
    some = lambda n: rng.choice([" ", "-", ".\n"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, some(rng.randrange(3, 25))) for i in range(12)] + [(3, some(9)), (None, some(12)), (90, None), (91, ""), (92, "Solo"), (93, "!?")]
    docs = [(i, some(rng.randrange(0, 60))) for i in range(40)]
    docs += [(100 + i, f"{some(5)} {rng.choice(items[:14])[1].upper()}! {some(3)}") for i in range(20)]
    docs += [(7, items[0][1]), (7, items[0][1]), (None, items[1][1]), (200, None), (201, ""), (202, "solo SOLO é"), (203, ("q " * 3000) + items[2][1])]
    got = contamination(frame("doc_id long, text string, n_hit string", [(d, t, "x") for d, t in docs]), frame("item_id long, text string", items), window, blocks)
    got = got.select("row.doc_id", "n_words", "n_hit", "items", without(got["row.text"], got["spans"]).alias("rest")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.rest or "") for r in got), key=repr) == plain(docs, items, window)


def test_empty_tables(frame):
    docs, none = frame("doc_id long, text string", [(1, "a b")]), frame("item_id long, text string", [])
    assert [(r.n_words, r.n_hit) for r in contamination(docs, none).collect()] == [(2, 0)]
    assert contamination(frame("doc_id long, text string", []), none).count() == 0


def test_index_finds_every_place():
    rng = np.random.default_rng(1)
    for _ in range(60):
        values, n = int(rng.integers(1, 6)), int(rng.integers(1, 80))
        text = np.append(rng.integers(0, values + 1, n), 0)

        def key(i, text=text):
            j = i + int(np.flatnonzero(text[i:] == 0)[0])
            return [(1, int(v)) for v in text[i:j]] + [(0, j)]

        assert list(suffix_array(text)) == sorted(range(len(text)), key=key)
        index = FMIndex(text, int(rng.integers(1, 5)))
        for m in (1, 2, 3):
            wanted = rng.integers(1, values + 3, (20, m))
            for p, a, b in zip(wanted, *index.search(wanted), strict=True):
                assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(text) - m + 1) if list(text[i : i + m]) == list(p)]


def test_hot_and_missing_item_ids(frame):
    """Blocks are cut by words, not by ids: a third of all rows may share one id, or have none."""
    from pyspark.sql import functions as F

    from ledgerlake.llm.decontamination import _item_blocks

    rng = random.Random(6)
    some = lambda n: " ".join(rng.choice(["a", "be", "é", "d4", "wörd", "the", "x"]) for _ in range(n))
    items = [(None, some(rng.randrange(30))) for _ in range(14)] + [("hot", some(rng.randrange(30))) for _ in range(14)] + [("long", some(400)), ("z", some(12))]
    docs = [(i, some(rng.randrange(60)) + " " + items[i][1]) for i in range(len(items))]
    benchmark = frame("item_id string, text string, block int, n long, part int, start string", [(i, t, 1, 2, 3, "s") for i, t in items])
    blocks, n = _item_blocks(benchmark.select("item_id", "text"), 5, 60)
    sizes = [r.n for r in blocks.groupBy("block").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()]
    assert n > 10 and max(sizes) <= 60 + 10
    got = contamination(frame("doc_id long, text string, items string, spans int, place int", [(*d, "i", 1, 2) for d in docs]), benchmark, 5, 60)
    got = got.select("row.doc_id", "n_words", "n_hit", "items", without(got["row.text"], got["spans"]).alias("rest")).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.rest) for r in got), key=repr) == plain(docs, items, 5)
