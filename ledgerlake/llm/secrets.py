"""Secret scans in DataFrame functions alone: fixed kinds by pattern, others by the entropy of sliding windows.

Base kinds: an assignment of a value to a name like password, an access key, a long run of hexadecimal digits. Besides,
every run of 20 or more characters of keys and encodings is a candidate: a window slides over it, and the window's
Shannon entropy follows from counts that change by the one character that enters and the one that leaves. Windows at
or above the limit of the run's character class and of their width are merged into `entropy` spans. Runs on the allow-list
are suppressed. A name, a separator or a neighbour can widen a candidate's class beyond that of the key inside, so its parts
of fewer kinds of characters (PARTS) are judged by their own class as well and give merged `part` spans.

No row leaves its task: nothing is shuffled, so neither sources nor copies nor long texts can be hot.

Defined results: a null or empty text has no spans; rows are scanned one by one, repeated or not; positions are code
points, ends exclusive; an empty table gives no rows; other columns take no part, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, and their patterns. An access key of 20 or more characters and a
# run of 24 or more hexadecimal digits always lie inside a candidate.
KINDS = ["assign", "access", "hex", "entropy", "part"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
LEAST_VALUE = 6
#: Characters in a window; a shorter candidate is one window.
WINDOW = 24
#: Characters in a candidate, and so in a part or a window, at least.
LEAST = 20
#: Characters of a class, and the entropy in bits from which a window of 20, 21, 22, 23 and 24 characters counts: what at most
#: one in about 200 random strings of that width falls below (for letters of one case and digits, strings over 32 symbols).
#: Other mixtures keep the share of the largest entropy that 4.0 bits are of 24 characters.
_LIMITS = [
    (r"[0-9]", [2.4, 2.45, 2.5, 2.5, 2.55]),
    (r"[0-9a-f]", [2.8, 2.85, 2.9, 2.9, 2.95]),
    (r"[0-9A-F]", [2.8, 2.85, 2.9, 2.9, 2.95]),
    (r"(?=.*[0-9])[A-Z0-9]", [3.25, 3.3, 3.35, 3.4, 3.45]),
    (r"(?=.*[0-9].*[a-z].*[0-9])[a-z0-9]", [3.25, 3.3, 3.35, 3.4, 3.45]),  # not a long word and its number
    (r"(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])[A-Za-z0-9+/_=-]", [3.55, 3.65, 3.7, 3.75, 3.8]),
    (r"[A-Za-z0-9+/_=-]", [3.74, 3.81, 3.87, 3.94, 4.0]),
]
#: Character classes by width, the first that fits a candidate or a part holds, and the entropy in bits from which a window counts.
CLASSES = [(rf"^{of}{{{LEAST + k}}}$" if LEAST + k < WINDOW else rf"^{of}+$", bits) for of, limits in _LIMITS for k, bits in enumerate(limits)]
#: Parts of a candidate that are judged by themselves.
PARTS = [r"[0-9]{20,}", r"[0-9a-f]{20,}", r"[0-9A-F]{20,}", r"[A-Z0-9]{20,}", r"[a-z0-9]{20,}", r"[A-Za-z0-9]{20,}"]
#: Candidates that look random but are none: words, identifiers and paths of words, UUIDs, digests, samples, one character.
ALLOWED = [
    r"^[A-Za-z]+$",
    r"^/?([A-Za-z]+[/_-]+)+[A-Za-z]*$",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^sha(1|256|384|512)-",
    r"EXAMPLE",
    r"^(.)\1+$",
]

_SPAN = "array<struct<start: bigint, kind: int, end: bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _before(lengths: Column, block: int = 256) -> Column:
    """Of each length, the sum of those before it; block by block, so that its time stays in proportion."""
    zero = F.array(F.lit(0).cast("long"))
    sums = lambda x: F.aggregate(x, zero, lambda t, v: F.concat(t, F.array(F.element_at(t, -1) + v)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / block).cast("int")), lambda b: sums(F.slice(lengths, b * block + 1, F.lit(block))))
    whole = _let(
        blocks,
        lambda rows: _let(
            sums(F.transform(rows, lambda r: F.element_at(r, -1))),
            lambda base: F.flatten(F.transform(rows, lambda r, i: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda v: v + base[i]))),
        ),
    )
    return F.when(F.size(lengths) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _long(x: Column) -> Column:
    return F.length(x).cast("long")


def _places(text: Column, pattern: str) -> Column:
    """All matches, left to right without overlap: array of (start, match)."""
    found = lambda all_of: _let(
        F.split(text, pattern, -1),
        lambda rest: _let(
            _before(F.zip_with(F.slice(rest, F.lit(1), F.size(all_of)), all_of, lambda gap, m: _long(gap) + _long(m))),
            lambda at: F.transform(all_of, lambda m, i: F.struct((at[i] + _long(rest[i])).alias("start"), m.alias("match"))),
        ),
    )
    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda all_of: F.when(F.size(all_of) > 0, found(all_of)).otherwise(F.array().cast("array<struct<start: bigint, match: string>>")))


def _span(start: Column, kind: str, end: Column) -> Column:
    return F.struct(start.cast("long").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.cast("long").alias("end"))


def _none() -> Column:
    return F.array().cast(_SPAN)


def _entropy(chars: Column, limit: Column, start: Column, kind: str) -> Column:
    """Merged windows of a candidate or a part whose entropy reaches the limit."""
    n = F.size(chars)
    width = F.least(n, F.lit(WINDOW))
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])  # c log c of a count c
    count = lambda part, c: F.size(part) - F.size(F.array_remove(part, c))
    first = F.slice(chars, F.lit(1), width)
    total = F.aggregate(F.array_distinct(first), F.lit(0.0), lambda t, c: t + weight[count(first, c)])
    reached = lambda s: (F.log2(width.cast("double")) - s / width) >= limit - 1e-9
    # State: the sum of c log c, the open span and the closed ones (places in the candidate).
    state = lambda s, a, b, done: F.struct(s.alias("s"), a.cast("int").alias("a"), b.cast("int").alias("b"), done.alias("done"))
    nothing = F.array().cast("array<struct<a: int, b: int>>")
    closed = lambda t: F.when(t["b"] > 0, F.concat(t["done"], F.array(F.struct(t["a"].alias("a"), t["b"].alias("b"))))).otherwise(t["done"])

    def step(t: Column, i: Column) -> Column:  # the window now ends after i characters
        part = F.slice(chars, i - width + 1, width - 1)  # what the two windows share
        enters, leaves = count(part, chars[i - 1]), count(part, chars[i - width - 1])
        s = t["s"] + weight[leaves] - weight[leaves + 1] + weight[enters + 1] - weight[enters]

        def moved(s: Column) -> Column:
            joins = t["b"] >= i - width
            hit = state(s, F.when(joins & (t["b"] > 0), t["a"]).otherwise(i - width), i, F.when(joins, t["done"]).otherwise(closed(t)))
            return F.when(reached(s), hit).otherwise(state(s, t["a"], t["b"], t["done"]))

        return _let(s, moved)

    begin = F.when(reached(total), state(total, F.lit(0), width, nothing)).otherwise(state(total, F.lit(0), F.lit(0), nothing))
    spans = F.when(
        n > width, F.aggregate(F.sequence(width + 1, n), begin, step, closed)
    ).otherwise(_let(begin, closed))
    return F.transform(spans, lambda x: _span(start + x["a"], kind, start + x["b"]))


def _merged(spans: Column) -> Column:
    """Spans of one kind, those that touch or overlap as one."""
    last = lambda t: F.element_at(t, -1)
    joined = lambda t, x: F.concat(F.slice(t, F.lit(1), F.size(t) - 1), F.array(last(t).withField("end", F.greatest(last(t)["end"], x["end"]))))
    return F.aggregate(F.array_sort(spans), _none(), lambda t, x: F.when(F.size(t) == 0, F.array(x)).when(F.try_element_at(t, F.lit(-1))["end"] >= x["start"], joined(t, x)).otherwise(F.concat(t, F.array(x))))


def _windows(start: Column, run: Column, kind: str) -> Column:
    """The spans of high entropy in a candidate or a part."""
    limit = F.lit(None).cast("double")
    for pattern, bits in reversed(CLASSES):
        limit = F.when(run.rlike(pattern), F.lit(bits)).otherwise(limit)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | run.rlike(pattern)
    judged = _let(F.struct(F.split(run, "").alias("chars"), limit.alias("limit")), lambda x: _entropy(x["chars"], x["limit"], start, kind))
    return F.when(allowed, _none()).otherwise(judged)


def _inside(candidate: Column) -> Column:
    """The spans in one candidate (start, match): access keys, hexadecimal runs and high entropy, of the whole and of its parts."""
    start, match = candidate["start"], candidate["match"]
    of = lambda pattern, kind: F.transform(_places(match, pattern), lambda m: _span(start + m["start"], kind, start + m["start"] + _long(m["match"])))
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | match.rlike(pattern)
    parts = F.array_distinct(F.concat(*[_places(match, p) for p in PARTS]))
    parts = F.filter(parts, lambda m: F.length(m["match"]) < F.length(match))
    parts = _merged(F.flatten(F.transform(parts, lambda m: _windows(start + m["start"], m["match"], "part"))))
    return F.concat(of(ACCESS, "access"), of(HEX, "hex"), _windows(start, match, "entropy"), F.when(allowed, _none()).otherwise(parts))


def secret_spans(text: Column) -> Column:
    """All spans of a text, ordered by start and kind: array of (start, kind, end), kinds numbered as in KINDS."""
    text = F.coalesce(text, F.lit(""))
    matches = _places(text, ASSIGN)
    value = lambda m: F.regexp_extract(m["match"], f"^{ASSIGN}$", 2)
    assigned = F.transform(F.filter(matches, lambda m: _long(value(m)) >= LEAST_VALUE), lambda m: _span(m["start"], "assign", m["start"] + _long(m["match"])))
    others = F.flatten(F.transform(_places(text, CANDIDATE), _inside))
    return F.array_sort(F.concat(assigned, others))


def scan(documents: DataFrame) -> DataFrame:
    """Each row of documents as a struct `row`, with its spans."""
    return documents.select(F.struct("*").alias("row"), secret_spans(F.col("text")).alias("spans"))


def listed(spans: Column, kinds: int = KINDS.index("part")) -> Column:
    """kind:start:end of the spans of the first kinds, comma-joined; parts only if all kinds are asked for."""
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(spans, lambda s: s["kind"] < kinds)
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones together, replaced by the mark."""
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), b.cast("int"))
    done = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at")),
        lambda t, s: F.struct(
            F.when(s["start"] >= t["at"], F.concat(t["kept"], part(t["at"], s["start"] - t["at"]), F.lit(mark))).otherwise(t["kept"]).alias("kept"),
            F.greatest(t["at"], s["end"]).alias("at"),
        ),
        lambda t: F.concat(t["kept"], part(t["at"], F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
