import hashlib
import random

import public_tokenizers
import pytest

from ledgerlake.llm.chat import BEGIN, CONTROL, digests, escaped, formatted, read_back, unescaped

PATH = public_tokenizers.path("word_bpe_49k.json")


def corpus():
    rng = random.Random(3)
    bits = [*CONTROL, "\\", "<", "|im_end|>", "hello ", "é", "\n", "[INST", "<\\s>", "[\\\\INST]"]
    rows = []
    for c in range(30):
        for t in range(rng.randrange(1, 25)):
            role = "system" if t == 0 and c % 2 else rng.choice(["user", "assistant", "assistant", "tool\nx", "sys\\n<s>"])
            rows.append((c, t, role, "".join(rng.choice(bits) for _ in range(rng.randrange(60)))))
    rows += [(50, None, "user", None), (50, 1, None, "a"), (50, 1, None, "a"), (50, 2, "assistant", None), (None, 0, "assistant", "x"), (None, 1, "user", "y"), (51, 0, "assistant", "w " * 3000), (52, 0, "system", "only")]
    return rows


def plain(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        out[c] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(60, 20), (400, 0), (2048, 256)])
def test_round_trip(frame, budget, history):
    rows = corpus()
    random.Random(1).shuffle(rows)
    windows = formatted(frame("conv_id long, turn long, role string, text string, mask string", [(*r, "x") for r in rows]), PATH, budget, history)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in digests(windows).collect()}
    assert got == plain(rows)
    kept = windows.collect()
    for w in kept:
        assert w.n_turns >= 1 and w.n_turns == len(read_back(w.text, w.new_from))
        assert w.over_budget == (w.n_tokens > budget)
        assert all(s.start >= w.new_from for s in w["mask"])
        if w.window and w.conv_id is not None and w.conv_id < 30 and w.conv_id % 2:
            assert w.text.startswith(f"{BEGIN}system\n")
        if w.over_budget:  # one turn beside the system turn
            assert w.n_turns <= 2
    assert budget > 2000 or any(w.window and w.new_from for w in kept)


def test_escapes_are_undone():
    rng = random.Random(8)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "s", ">", "/", "\\", "[", "INST]", "<s>", "|", "im_end", "<<SYS", ">>"]) for _ in range(rng.randrange(12)))
        hidden = escaped(text)
        assert unescaped(hidden) == text and not any(c in hidden for c in CONTROL)


def test_empty_table(frame):
    assert digests(formatted(frame("conv_id long, turn long, role string, text string", []), PATH)).count() == 0
