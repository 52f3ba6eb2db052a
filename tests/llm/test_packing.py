import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from ledgerlake.llm.packing import Encoder, pack, padded, piece_rows
from ledgerlake.llm.text import text_bytes

PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    letters = list("aAbBzZ'’ 129é́<|>.!\n\tΣİ$") + ["<|endoftext|>", "日本", "'ll", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["", "don't 'tis", "<|startoftext|>x<|ENDOFTEXT|>", "x" * 3000, "a\u0085b c"]
    ids, begins = Encoder(PATH).encode(*text_bytes(pa.array(texts)))
    assert [list(ids[begins[i] : begins[i + 1]]) for i in range(len(texts))] == plain_ids(texts)


@pytest.mark.parametrize("length,block", [(16, 64), (16, 16), (64, 100), (4096, 1 << 18)])
def test_pieces_cover_the_stream(frame, length, block):
    rng = random.Random(length)
    texts = [None, "", "one"] + [" ".join(rng.choice("alpha beta gamma, delta! 12".split()) for _ in range(rng.choice([1, 5, 40, 300]))) for _ in range(40)]
    rows = [(i if i != 7 else None, x, "extra") for i, x in enumerate(texts)] + [(3, texts[3], "again")]
    df = frame("doc_id long, text string, start string", rows).repartition(5)
    sequences = pack(df, PATH, length=length, block=block)
    got = sorted(sequences.collect(), key=lambda r: r.sequence_id)
    expected = {i: ids + [2] for i, ids in enumerate(plain_ids([r[1] for r in rows]))}
    assert [r.sequence_id for r in got] == list(range(len(got)))
    assert all(len(r.ids) == 4 * length for r in got[:-1]) and len(got[-1].ids) <= 4 * length
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    assert len(stream) == sum(map(len, expected.values()))
    by_doc: dict = {}
    for r in got:
        at = 0
        for p in r.pieces:
            assert p.offset == at and p.length > 0
            at += p.length
            by_doc.setdefault(p.doc_id, []).append((p.start, list(np.frombuffer(r.ids, "<u4")[p.offset : at]), p.doc_tokens))
        assert 4 * at == len(r.ids)
    for doc_id, pieces in by_doc.items():
        wanted = expected[doc_id if doc_id is not None else 7]
        if doc_id == 3:  # two equal rows
            wanted = wanted * 2
            pieces.sort()
            assert sum(len(p[1]) for p in pieces) == len(wanted)
            continue
        joined = [x for p in sorted(pieces) for x in p[1]]
        assert joined == wanted and all(p[2] == len(wanted) for p in pieces)
    rows = piece_rows(sequences).collect()
    assert sum(r.length for r in rows) == len(stream)
    r = next(r for r in rows if r.doc_id == 5 and r.start == 0)
    assert r.ids_crc32 == zlib.crc32(np.array(expected[5][: r.length], "<u4").tobytes())
    full = padded(sequences, length).collect()
    assert all(len(r.ids) == length or len(r.ids) & (len(r.ids) - 1) == 0 for r in full)


def test_empty_table(frame):
    df = frame("doc_id long, text string", [])
    assert pack(df, PATH).count() == 0
