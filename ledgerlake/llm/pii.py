"""Surrogates for personal data: each entity is replaced by another of its kind and format, the same wherever it stands.

Entities are found by pattern: e-mail addresses, telephone, card and social security numbers, IP addresses, IBANs, and
names (after a title, or a known first name before a surname; they run on over particles, initials, hyphens and all capitalised
words that follow). A text's detected surnames and first names count wherever else they stand in it, capitalised. A surrogate follows from a secret key and the entity alone: letters
become letters, digits digits, check digits stay right, a first name keeps its gender and script, a surname its script. A name's
words are replaced one by one, so `Mrs Lopez` and `Ana Lopez` still share their surname. Particles, initials and words of further
scripts in a name stay as they are.

Collision checks keep distinct entities distinct: where two entities get one surrogate, or a surrogate is itself an entity
of the corpus, the smallest entity keeps it and the others try again with the next number, until none is left. Most entities need no
second try, so texts are rewritten where they stand; only those that hold an entity with a later try are looked up, by a hash of
the text. Entities are made distinct before they are shuffled, so one that stands in very many documents is one row.

A kind has as many surrogates as its format has room for (a social security number: nine digits); a corpus with so many distinct
entities of one format that `tries` finds none free in 512 rounds ends with an error rather than with two entities under one surrogate.

Defined results: a null text stays null and an empty one empty; rows are rewritten one by one, repeated or not; an empty table
gives no rows; other columns are kept, whatever their names; where matches overlap, the one that begins first counts, of
those the longest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlake.llm.storage import prepare, stored

# Titles with the gender they tell, and first names by script and gender.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Lady": "f", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Mme": "f", "Señor": "m", "Señora": "f", "Г-н": "m", "Г-жа": "f", "Господин": "m", "Госпожа": "f",
}
FIRST_NAMES = {
    ("latin", "f"): ["Alice", "Ana", "Anna", "Carmen", "Clara", "Elena", "Emma", "Greta", "Helen", "Ines", "Julia", "Laura", "Lucia", "Maria", "Marie", "Nina", "Olivia", "Rosa", "Sarah", "Sophie"],
    ("latin", "m"): ["Adam", "Anton", "Carlos", "Daniel", "David", "Felix", "Hugo", "James", "Jean", "John", "Juan", "Lucas", "Marco", "Martin", "Michael", "Oscar", "Paul", "Peter", "Robert", "Thomas"],
    ("cyrillic", "f"): ["Алина", "Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Светлана", "Татьяна"],
    ("cyrillic", "m"): ["Алексей", "Антон", "Борис", "Виктор", "Дмитрий", "Иван", "Максим", "Николай", "Павел", "Сергей"],
}
_SYLLABLES = {"latin": [c + v for c in "bdfglmnprstv" for v in "aeiou"], "cyrillic": [c + v for c in "бвгдлмнпрст" for v in "аеиоу"]}
_FIRST_ENDS = {("latin", "f"): "na", ("latin", "m"): "ro", ("cyrillic", "f"): "на", ("cyrillic", "m"): "рий"}
_LAST_ENDS = {"latin": ["son", "mann", "ez", "ard"], "cyrillic": ["енко", "ук", "ян", "ич"]}
_NAMED = {name: key for key, names in FIRST_NAMES.items() for name in names}

# Small words within surnames, those that are so with a capital too, and capitalised words that begin a sentence rather than go on
# with a name.
PARTICLES = "af al ap auf av ben bin da dal das de del della den der des di do dos du el ibn la las le li los op san santa st ten ter und van vom von zu zum zur".split()
_CAPITAL_PARTICLES = set("Da De Del Della Der Des Di Dos La Las Los Van Von Vom Zu Zum Zur".split())
_NO_NAMES = set("A An And As At But By For From He Her His I If In Is It Its My No Not On Or Our She So That The Their Then There They This To We Was When Who Will With You Your Der Die Das Und Er Sie El La Los Las Il Elle Le Les Et И В Он Она Они Но".split())

_WORD = r"[^\W\d_]+"
# A name's word, without an elided particle before it and without a possessive ending.
_NAME_WORD = re.compile(rf"(?:[dl]['’](?=[^\W\d_a-z]))?(?P<word>{_WORD}(?:['’](?![sS]\b){_WORD})*)")
# Where a name begins: behind a title, or at a known first name.
_NAME_HEAD = re.compile(rf"\b(?:(?P<title>{'|'.join(TITLES)})\b\.?[ ]|(?P<first>{'|'.join(_NAMED)})\b(?=[ -]))")
_PATTERNS = [
    ("email", "@", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    ("ip", ".", r"\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"),
    ("phone", "+", r"(?<![\w+])\+\d{1,3}[ -]?(?:\(\d{1,4}\)[ -]?)?\d{2,4}(?:[ -]?\d{2,4}){1,4}(?!\d)"),
    ("phone", "-", r"(?<![\w+(])(?:\(\d{3}\) ?|\d{3}-)\d{3}-\d{4}(?![\d-])"),
    ("ssn", "-", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", "", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)"),
]
_PATTERNS = [(kind, sign, re.compile(pattern)) for kind, sign, pattern in _PATTERNS]
# Where an IBAN may begin, and its length by country.
_IBAN_HEAD = re.compile(r"[A-Z]{2}\d{2}(?= ?[A-Z0-9]{4})")
_IBAN_LENGTHS = {
    country: n for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for country in countries.split()
}
_IBANS = {n: re.compile(r"[A-Z]{2}\d{2}" + r"(?: ?[A-Z0-9]{4})" * ((n - 4) // 4) + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])") for n in range(34, 14, -1)}
# What a text must hold for a kind to be looked for at all; each is cheap, and true wherever the kind's pattern matches.
_CAPITAL = r"[^\W\d_a-zß-öø-ÿа-я]"  # or a rarer small letter
_NUMBERS = re.compile(r"\d[\d .()-]{3,}\d")
_PARTICLE = rf"(?:{'|'.join(PARTICLES)}) |[dl]['’]"
_NEEDED = {
    "ip": _NUMBERS, "phone": _NUMBERS, "ssn": _NUMBERS, "card": _NUMBERS, "iban": re.compile(r"[A-Z]{2}\d{2}"),
    "name": re.compile(rf"(?:{_CAPITAL}\w*|(?:{'|'.join(TITLES)})\.?) (?:{_CAPITAL}|{_PARTICLE})"),
}


# What may not stand before a match; told afterwards, as patterns that begin with a character class are found faster.
_NOT_AFTER = {"ip": re.compile(r"[\d.]"), "card": re.compile(r"[\w.-]"), "iban": re.compile(r"[A-Za-z0-9]")}


def _accepted(kind: str, m: re.Match) -> bool:
    before = _NOT_AFTER.get(kind)
    if before is not None and m.start() and before.match(m.string, m.start() - 1):
        return False
    if kind == "ip":
        return all(int(x) < 256 for x in m[0].split("."))
    return True


def _script(word: str) -> str | None:
    if all(c.isascii() or "À" <= c <= "ɏ" for c in word):
        return "latin"
    return "cyrillic" if all("Ѐ" <= c <= "ӿ" for c in word) else None


def _iban(text: str) -> bool:
    t = text.replace(" ", "")
    return 15 <= len(t) <= 34 and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def _name_words(text: str, at: int) -> tuple[list[tuple[int, str, bool, bool]], int]:
    """The words of a name from a place on, and where they end: start, word, whether it is a particle, whether a hyphen follows."""
    words, end = [], at
    while (m := _NAME_WORD.match(text, at)) is not None:
        word = m["word"]
        particle = word in PARTICLES or word in _CAPITAL_PARTICLES
        if not (particle or word[0].isupper()) or word in TITLES or words and word in _NO_NAMES and not particle and len(word) > 1:
            break
        at = m.end()
        if len(word) == 1 and text.startswith(". ", at):  # an initial
            at += 1
        words.append((m.start("word"), word, particle, text.startswith("-", at)))
        end = at
        if not text.startswith((" ", "-"), at):
            break
        at += 1
    # Neither particles in small letters nor initials end a name.
    while words and (not words[-1][1][0].isupper() or len(words[-1][1]) < 2):
        words.pop()
    return words, end


def _ibans(text: str) -> Iterator[re.Match]:
    """IBANs: as long as their country says or as the whole run is, without a known country the longest whose check digits are right."""
    at = 0
    while (head := _IBAN_HEAD.search(text, at)) is not None:
        at = head.start() + 1
        if head.start() and _NOT_AFTER["iban"].match(text, head.start() - 1):
            continue
        own = _IBAN_LENGTHS.get(head[0][:2])
        fits = (m for n in _IBANS if (m := _IBANS[n].match(text, head.start())) is not None)
        if own:
            fits = (m for m in (_IBANS[own].match(text, head.start()), next(fits, None)) if m is not None)
        found = next((m for m in fits if _iban(m[0])), None)
        if found is not None:
            yield found
            at = found.end()


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """The words of all names as entities: first names by gender and script, surnames by script; and their further mentions."""
    out, at, kinds = [], 0, {}
    while (m := _NAME_HEAD.search(text, at)) is not None:
        words, end = _name_words(text, m.end() if m["title"] else m.start())
        at = max(m.end(), end if words else 0)
        # The surname: what a hyphen joins to the last word, and all from the first particle on.
        surname = len(words) - 1
        while surname > 0 and words[surname - 1][3]:
            surname -= 1
        surname = min([surname, *(k for k, w in enumerate(words[:-1]) if w[2])])
        if not m["title"] and surname < 1:
            continue
        gender = TITLES[m["title"]] if m["title"] else _NAMED[m["first"]][1]
        for k, (start, word, _, _) in enumerate(words):
            plain = word.lower().replace("’", "'")
            script = _script(plain)
            if script is not None and len(word) > 1 and word[0].isupper():
                kind = f"last-{script}" if k >= surname else f"first-{gender}-{script}"
                out.append((start, start + len(word), kind, plain))
                kinds.setdefault(plain, kind)
    if kinds:
        found = {e[0] for e in out}
        for m in _NAME_WORD.finditer(text):
            word, start = m["word"], m.start("word")
            plain = word.lower().replace("’", "'")
            if plain in kinds and start not in found and word[0].isupper() and word not in _CAPITAL_PARTICLES | _NO_NAMES:
                out.append((start, m.end(), kinds[plain], plain))
    return out


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """Entities of a text in order, without overlap: start, end, kind, and the form that is the same for all its spellings."""
    found = []
    needed = {p for p in _NEEDED.values() if p.search(text)}
    for kind, sign, pattern in _PATTERNS:
        if sign and sign not in text or kind in _NEEDED and _NEEDED[kind] not in needed:
            continue
        for m in pattern.finditer(text):
            if _accepted(kind, m):
                plain = m[0].lower() if kind in ("email", "ip") else re.sub(r"[^A-Z0-9+]", "", m[0])
                found.append((m.start(), m.end(), kind, plain))
    if _NEEDED["iban"] in needed:
        found += [(m.start(), m.end(), "iban", m[0].replace(" ", "")) for m in _ibans(text)]
    if _NEEDED["name"] in needed:
        found += _names(text)
    out: list[tuple[int, int, str, str]] = []
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class _Draw:
    """Numbers that follow from the key, the entity and the try."""

    def __init__(self, key: bytes, kind: str, plain: str, attempt: int):
        self.seed, self.block, self.held = f"{kind}\0{plain}\0{attempt}\0".encode(), 0, 0
        self.key, self.room = key, 1

    def below(self, n: int) -> int:
        if self.room < n << 32:
            digest = hashlib.blake2b(self.seed + str(self.block).encode(), key=self.key).digest()
            self.held, self.room, self.block = int.from_bytes(digest, "big"), 1 << 512, self.block + 1
        self.held, x = divmod(self.held, n)
        self.room //= n
        return x


def _like(text: str, draw: _Draw) -> str:
    """Letters for letters, digits for digits (no new leading zero), the rest as it is."""
    out = []
    for i, c in enumerate(text):
        if c.isdigit():
            out.append(str(1 + draw.below(9)) if i == 0 and c != "0" else str(draw.below(10)))
        elif c.isalpha() and c.isascii():
            out.append(chr((65 if c.isupper() else 97) + draw.below(26)))
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(reversed(digits))) % 10


def surrogate(key: bytes, kind: str, plain: str, attempt: int = 0) -> str:
    """The plain form of what replaces an entity."""
    draw = _Draw(key, kind, plain, attempt)
    if kind == "email":
        local, _, domain = plain.rpartition("@")
        host, _, top = domain.rpartition(".")
        # The domain is replaced alike in all addresses.
        return f"{_like(local, draw)}@{_like(host, _Draw(key, 'domain', domain, attempt // 64))}.{top}"
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4))
    if kind == "phone":
        kept = 2 if plain.startswith("+") else 0  # the country
        return plain[:kept] + _like(plain[kept:], draw)
    if kind == "card":
        new = plain[0] + _like("0" + plain[1:], draw)[1:]
        return new if _luhn(plain) else next(x for x in (new[:-1] + str(d) for d in range(10)) if not _luhn(x))
    if kind == "iban":
        body = _like(plain[4:], draw)
        rest = int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
        return f"{plain[:2]}{98 - rest:02d}{body}"
    if kind.startswith("first-"):
        _, gender, script = kind.split("-")
        pool = FIRST_NAMES[script, gender]
        if attempt == 0:
            return pool[draw.below(len(pool))].lower()
        return "".join(_SYLLABLES[script][draw.below(len(_SYLLABLES[script]))] for _ in range(2 + attempt // 8)) + _FIRST_ENDS[script, gender]
    if kind.startswith("last-"):
        script = kind.split("-")[1]
        ends = _LAST_ENDS[script]
        return "".join(_SYLLABLES[script][draw.below(len(_SYLLABLES[script]))] for _ in range(3 + attempt // 8)) + ends[draw.below(len(ends))]
    return _like(plain, draw)


def written_as(new: str, old: str, kind: str) -> str:
    """A plain surrogate in the spelling of the text it replaces: its case, or its separators."""
    if kind.startswith(("first", "last")):
        return new.upper() if old.isupper() else new[0].upper() + new[1:]
    if kind in ("email", "ip"):
        return new.upper() if kind == "email" and old.isupper() else new
    letters = iter(new)
    return "".join(next(letters) if re.match(r"[A-Z0-9+]", c) else c for c in old)


_FOUND = "text_hash long, kind string, plain string"


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(h, k, p) for h, t in zip(batch.column("text_hash").to_pylist(), batch.column("text").to_pylist(), strict=True) for k, p in {e[2:] for e in entities(t or "")}]
        columns = zip(*rows, strict=True) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.string()), strict=True)], names=["text_hash", "kind", "plain"])


def tries(found: DataFrame, key: bytes, most: int = 512) -> DataFrame:
    """Distinct entities (kind, plain) with the try whose surrogate is theirs alone and no entity of the corpus."""
    prepare(found.sparkSession)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(key, *e) for e in zip(*(batch.column(c).to_pylist() for c in ("kind", "plain", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "plain", "attempt")), pa.array(new, pa.string())], names=["kind", "plain", "attempt", "new"])

    every = stored(found.select("kind", "plain").distinct(), "entities")
    now = every.withColumn("attempt", F.lit(0))
    kind = "kind string, plain string, attempt int, new string"
    for _ in range(most):
        now = stored(now.select("kind", "plain", "attempt").mapInArrow(draw, kind), "surrogates")
        # First come those that were settled before, then the smallest.
        owners = now.groupBy("kind", "new").agg(F.min(F.struct("attempt", "plain")).alias("owner"), F.count("*").alias("n"))
        taken = every.select("kind", F.col("plain").alias("new"), F.lit(True).alias("taken"))
        clash = owners.join(taken, ["kind", "new"], "left").filter("n > 1 or taken").select("kind", "new", "owner.plain", F.coalesce("taken", F.lit(False)).alias("taken"))
        if clash.isEmpty():
            return now
        clash = clash.withColumnRenamed("plain", "keeps")
        again = F.col("keeps").isNotNull() & (F.col("taken") | (F.col("keeps") != F.col("plain")))
        now = now.join(clash, ["kind", "new"], "left").withColumn("attempt", F.col("attempt") + F.when(again, 1).otherwise(0))
    raise RuntimeError(f"entities still share surrogates after {most} tries")


def with_surrogates(documents: DataFrame, key: bytes) -> DataFrame:
    """Each row of documents as a struct `row`, with its new text, and what was replaced: kind, start and end in the old text."""
    prepare(documents.sparkSession)
    rows = documents.select(F.struct("*").alias("row"), F.col("text").alias("text"), F.xxhash64("text").alias("text_hash"))
    found = stored(rows.select("text_hash", "text").mapInArrow(_detect, _FOUND).distinct(), "found")
    later = tries(found, key).filter("attempt > 0").select("kind", "plain", "attempt")
    lists = found.join(later, ["kind", "plain"]).groupBy("text_hash").agg(F.collect_list(F.struct("kind", "plain", "attempt")).alias("later"))
    lists = stored(lists, "later_tries")  # its size is known then: Catalyst broadcasts it only where it is small

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, places = [], []
            for text, later in zip(batch.column("text").to_pylist(), batch.column("later").to_pylist(), strict=True):
                attempts = {(x["kind"], x["plain"]): x["attempt"] for x in later or []}
                parts, at, own = [], 0, []
                for a, b, kind, plain in entities(text or ""):
                    new = surrogate(key, kind, plain, attempts.get((kind, plain), 0))
                    parts += [text[at:a], written_as(new, text[a:b], kind)]
                    own.append({"kind": kind, "start": a, "end": b})
                    at = b
                texts.append(text if text is None else "".join(parts) + text[at:])
                places.append(own)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string()), pa.array(places, place)], names=["row", "new_text", "replaced"])

    kind = StructType([f for f in rows.schema.fields if f.name == "row"] + StructType.fromDDL("new_text string, replaced array<struct<kind: string, start: long, end: long>>").fields)
    return rows.join(lists, "text_hash", "left").select("row", "text", "later").mapInArrow(rewrite, kind)
