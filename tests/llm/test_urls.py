import random

import pytest

from ledgerlake.llm.urls import judged

RULES = [("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es/", "allow"), ("a.b", "", "block"), ("b", "/x/pre", "block"), ("b", "/x/", "allow"), (None, "/", "block"), ("org", None, "block"), ("org", "no", "block")]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        end = min([rest.find(c, cut) for c in "?#" if c in rest[cut:]], default=len(rest))
        path = rest[cut:end]
    best = None
    for h, p, v in rules:
        if h is None or p is None or not host:
            continue
        h = h.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1, -1), (len(h), len(p), v == "block", h + p, v))
    return host, path, best[3] if best else None, best[4] if best else default


def urls():
    rng = random.Random(1)
    fixed = [None, "", "x.com/en/", "http://EXAMPLE.com", "http://example.com/en/1?x=/a", "https://www.example.com/en/a#b", "http://.com/", "http://a..com/q/", "://b/x/prefix", "ftp://a.b", "http://a.b?x", "http://é.b/x/é", "a://b://c/d", "http://net/es/", "http://x\ny.com/a\nb", "http://" + "a." * 500 + "com" + "/p" * 3000]
    for _ in range(200):
        host = ".".join(rng.choice(["www", "example", "com", "net", "a", "b", "Example"]) for _ in range(rng.randrange(1, 5)))
        fixed.append(f"http://{host}{rng.choice(['', '/', '/en/', '/es/1', '/x/pre', '/x/prefix/y', '/x/p', '/en'])}{rng.choice(['', '?q=/en/', '#z'])}")
    return fixed


@pytest.mark.parametrize("rules", [RULES, [], RULES[:5]])
def test_against_plain_rules(frame, rules):
    rows = list(enumerate(urls())) + [(None, "http://a.com/"), (3, "http://EXAMPLE.com")]
    got = judged(frame("page_id long, url string, host string", [(i, u, "x") for i, u in rows]), frame("host string, path string, verdict string", rules)).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=repr) == sorted(((i, *plain(u, rules)) for i, u in rows), key=repr)


def test_empty_table(frame):
    assert judged(frame("page_id long, url string", []), frame("host string, path string, verdict string", RULES)).count() == 0
