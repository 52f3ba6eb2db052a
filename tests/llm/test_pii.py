import random
import re

import pytest

from ledgerlake.llm.pii import FIRST_NAMES, _iban, _luhn, entities, surrogate, tries, with_surrogates

KEY = b"test"


def rewritten(frame, rows, key=KEY):
    df = frame("doc_id long, text string, new_text string", [(d, t, "x") for d, t in rows])
    return with_surrogates(df, key).select("row.doc_id", "row.text", "new_text", "replaced").collect()


TEXTS = [
    "Write to jane.doe7@mail.example.com or JANE.DOE7@MAIL.EXAMPLE.COM, call +1 (212) 555-0199 or (212) 555-0142.",
    "Card 4539 1488 0343 6467 and 4539148803436467, ssn 078-05-1120, from 192.168.10.77.",
    "Mrs Lopez met Ana Lopez; Mr Lopez and Juan García left. Г-жа Иванова и Борис Иванов.",
    "IBAN GB82 WEST 1234 5698 7654 32 but not GB83 WEST ABCD EFGH 12.",
]


def test_formats_are_kept(frame):
    got = [r.new_text for r in sorted(rewritten(frame, list(enumerate(TEXTS))), key=lambda r: r.doc_id)]
    m = re.fullmatch(r"Write to ([a-z]{4}\.[a-z]{3}\d@\S+\.com) or ([A-Z.0-9@]+), call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}\.", got[0])
    assert m and m[1].upper() == m[2] and "jane" not in got[0]
    m = re.fullmatch(r"Card (4\d{3} \d{4} \d{4} \d{4}) and (\d{16}), ssn \d{3}-\d{2}-\d{4}, from (\d+\.\d+\.\d+\.\d+)\.", got[1])
    assert m and m[1].replace(" ", "") == m[2] and _luhn(m[2]) == 0 and m[3] != "192.168.10.77"
    m = re.fullmatch(r"Mrs (\w+) met (\w+) (\w+); Mr (\w+) and (\w+) (\w+) left\. Г-жа (\w+) и (\w+) (\w+)\.", got[2])
    assert m[1] == m[3] == m[4] != "Lopez" and m[6] != m[1] and m[2] != "Ana"
    assert all("Ѐ" <= c <= "ӿ" for c in m[7] + m[8] + m[9]) and m[7] != m[9]
    m = re.fullmatch(r"IBAN (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) but not GB83 WEST ABCD EFGH 12\.", got[3])
    assert m and _iban(m[1])


def test_names_keep_gender_and_script():
    for (script, gender), names in FIRST_NAMES.items():
        for name in names:
            assert surrogate(KEY, f"first-{gender}-{script}", name.lower()).capitalize() in names
    assert [e[2] for e in entities("Frau Greta Meier")] == ["first-f-latin", "last-latin"]
    assert entities("Mr and the Dr. Paul paints, Anna 12") == []


def test_distinct_entities_stay_distinct(spark, frame):
    # Short addresses, so that surrogates collide with each other and with entities.
    rng = random.Random(1)
    local = ["".join(rng.choice("abcdefghij") for _ in range(rng.choice([1, 1, 2]))) for _ in range(90)]
    rows = [(i, f"{a}@x.org and {b}@x.org, {c}") for i, (a, b, c) in enumerate(zip(local, local[1:], (FIRST_NAMES["latin", "m"] + FIRST_NAMES["latin", "f"]) * 5, strict=False))]
    rows = [(i, t + " Smith") for i, t in rows]
    got, mapping = rewritten(frame, rows), {}
    for r in got:
        old, new = entities(r.text), entities(r.new_text)
        assert [e[2] for e in old][:2] == ["email", "email"]
        for (a, b, kind, plain), (c, d, _, fresh) in zip(old[:2], new[:2], strict=True):
            assert mapping.setdefault((kind, plain), fresh) == fresh and plain != fresh
    assert len(set(mapping.values())) == len(mapping)
    assert not {v for v in mapping.values()} & {p for _, p in mapping}
    names = {}
    for r in got:
        old, new = r.text.split(", ")[1].split()[0], r.new_text.split(", ")[1].split()[0]
        assert names.setdefault(old, new) == new != old
    assert len(set(names.values())) == len(names)


def test_odd_texts(frame):
    rows = [(1, None), (2, ""), (None, "a@b.co"), (3, "a@b.co"), (3, "a@b.co"), (4, "@ . + - nothing 12 é"), (5, "x" * 100_000 + "@" + "1.2.3" * 1000), (6, "1" * 60)]
    got = rewritten(frame, rows)
    assert len(got) == len(rows)
    by = {(r.doc_id, r.text): r.new_text for r in got}
    assert by[1, None] is None and by[2, ""] == "" and by[None, "a@b.co"] == by[3, "a@b.co"] != "a@b.co"
    assert by[4, rows[5][1]] == rows[5][1] and by[6, rows[7][1]] == rows[7][1]
    assert with_surrogates(frame("doc_id long, text string", []), KEY).count() == 0


def test_keys_matter_and_texts_without_entities_stay():
    assert surrogate(b"a", "ssn", "123456789") != surrogate(b"b", "ssn", "123456789")
    assert entities("Version 2.0.1 of 2024-01-02, 3.14159, order 4974608795, page 12-14") == []


@pytest.mark.parametrize("kind,plain", [("card", "4000000000000000"), ("ip", "1.2.3.4"), ("phone", "+12125550199"), ("last-latin", "lopez")])
def test_tries_differ(kind, plain):
    assert len({surrogate(KEY, kind, plain, a) for a in range(20)}) == 20 and tries


def named(text):
    return [(text[a:b], kind) for a, b, kind, _ in entities(text)]


def test_names_are_replaced_whole():
    first, last = "first-m-latin", "last-latin"
    assert named("Mr John Ronald Tolkien left") == [("John", first), ("Ronald", first), ("Tolkien", last)]
    assert named("John Ronald Tolkien and Paul O’Brien left") == [("John", first), ("Ronald", first), ("Tolkien", last), ("Paul", first), ("O’Brien", last)]
    assert named("Mr O'Brien's house, Mr. O'Brien") == [("O'Brien", last)] * 2
    assert named("Ms de la Cruz and Juan de la Cruz Vega") == [("Cruz", last), ("Juan", first), ("Cruz", last), ("Vega", last)]
    assert named("Monsieur d'Artagnan, Mr Smith-Jones, Mr J. R. R. Tolkien") == [("Artagnan", last), ("Smith", last), ("Jones", last), ("Tolkien", last)]
    assert named("Mrs Lopez Mr Garcia. Miss Li") == [("Lopez", last), ("Garcia", last), ("Li", last)]
    assert named("Mr Ben Smith met Ms De La Cruz; Ben left. La casa. Mr He too") == [("Ben", first), ("Smith", last), ("De", last), ("La", last), ("Cruz", last), ("Ben", first), ("He", last)]
    assert named("Mr de la Then she spoke to Paul. Anna B. She left, Jean-Luc too") == []


def test_further_mentions_share_the_surrogate(frame):
    text = "Mrs Lopez arrived. Lopez left; LOPEZ's car, Ana Lopez. Ana slept, a lopez not. Lopezia."
    new = rewritten(frame, [(1, text)])[0].new_text
    m = re.fullmatch(r"Mrs (\w+) arrived\. (\w+) left; (\w+)'s car, (\w+) (\w+)\. (\w+) slept, a lopez not\. Lopezia\.", new)
    assert m and m[1] == m[2] == m[5] != "Lopez" and m[3] == m[1].upper() and m[4] == m[6] != "Ana"


@pytest.mark.parametrize(
    "text,ibans",
    [
        ("BE68 5390 0754 7034 EUR", ["BE68 5390 0754 7034"]),
        ("ES91 2100 0418 4502 0005 1332 BIC", ["ES91 2100 0418 4502 0005 1332"]),
        ("BE68 5390 0754 7034 DE89 3704 0044 0532 0130 00", ["BE68 5390 0754 7034", "DE89 3704 0044 0532 0130 00"]),
        ("XY12 BE68 5390 0754 7034 and GB82WEST12345698765432 GBP", ["BE68 5390 0754 7034", "GB82WEST12345698765432"]),
        ("BE69 5390 0754 7034 EUR, BE68 5390 0754 70345", []),
    ],
)
def test_ibans_before_other_words(text, ibans):
    assert [text[a:b] for a, b, kind, _ in entities(text) if kind == "iban"] == ibans


def planted(rng):
    """A text put together from plain words and entities, and where each entity stands: kind, start, end, plain form."""
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    first = {n: (g, sc) for (sc, g), names in FIRST_NAMES.items() for n in names}
    last = {"latin": ["Silva", "Keller", "Moreau", "Baker"], "cyrillic": ["Иванов", "Петров"]}
    text, out = "", []
    for _ in range(rng.randrange(1, 7)):
        text += rng.choice(["the river runs ", "order 4974608795, ", "it was 3.14 or 2024-01-02; ", "wörter und sätze, "])
        kind = rng.choice(["email", "ip", "ssn", "phone", "card", "iban", "name", "none"])
        if kind == "name":
            name = rng.choice(sorted(first))
            gender, script = first[name]
            surname = rng.choice(last[script])
            out.append((f"first-{gender}-{script}", len(text), len(text) + len(name), name.lower()))
            out.append((f"last-{script}", len(text) + len(name) + 1, len(text) + len(name) + 1 + len(surname), surname.lower()))
            text += f"{name} {surname}, "
            continue
        if kind == "none":
            continue
        if kind == "card":
            body = "4" + digits(14)
            own = body + str(-_luhn(body + "0") % 10)
        elif kind == "iban":
            body = digits(18)
            own = f"DE{98 - int(body + '131400') % 97:02d}{body}"
        else:
            own = {"email": f"{rng.choice('abc')}{digits(2)}@mail.org", "ip": f"10.{digits(1)}.{digits(2)}.{digits(1)}", "ssn": f"{digits(3)}-{digits(2)}-{digits(4)}", "phone": f"+1 {digits(3)} {digits(3)} {digits(4)}"}[kind]
        written = " ".join(own[i : i + 4] for i in range(0, len(own), 4)) if kind in ("card", "iban") and rng.random() < 0.5 else own
        out.append((kind, len(text), len(text) + len(written), re.sub(r"[^A-Z0-9+]", "", own) if kind not in ("email", "ip") else own))
        text += written + " and "
    return text + "ends.", out


def test_against_planted_entities(frame):
    """Exactly the planted entities are replaced, each by one surrogate wherever it stands, none by another's or by one of the corpus."""
    rng = random.Random(11)
    made = [planted(rng) for _ in range(300)]
    got = rewritten(frame, [(i, t) for i, (t, _) in enumerate(made)])
    mapping = {}
    for r in got:
        text, wanted = made[r.doc_id]
        assert [(x.kind, x.start, x.end) for x in r.replaced] == [w[:3] for w in wanted], text
        at, rest = 0, r.new_text
        for k, (kind, a, b, plain) in enumerate(wanted):
            between = text[at:a]
            assert rest.startswith(between)
            rest, at = rest[len(between) :], b
            ahead = text[b : wanted[k + 1][1]] if k + 1 < len(wanted) else text[b:]
            new = rest[: rest.index(ahead)]
            rest = rest[len(new) :]
            assert new != text[a:b]
            same = new.lower() if kind in ("email", "ip") or kind.startswith(("first", "last")) else re.sub(r"[^A-Z0-9+]", "", new)
            assert mapping.setdefault((kind, plain), same) == same
            if kind == "card":
                assert _luhn(same) == 0 and len(new) == b - a
            if kind == "iban":
                assert _iban(new) and same[:2] == "DE"
            if kind.startswith("first"):
                assert kind.split("-")[2] != "cyrillic" or all("Ѐ" <= c <= "ӿ" for c in new)
        assert rest == text[at:]
    for kind in {k for k, _ in mapping}:
        own = {p: s for (k, p), s in mapping.items() if k == kind}
        assert len(set(own.values())) == len(own) and not set(own.values()) & set(own)
