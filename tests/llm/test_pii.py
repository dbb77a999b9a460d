from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import texts
from tillroll.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n if n < 10 else n - 9
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=400, deadline=None)
@given(st.text("0123456789 .-+()@ab%é", max_size=60))
def test_rules(text):
    assert pii.base_spans(text) == plain(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1111", "x@y.zz.", "a@b", "1.2.3.4.5.6.7.8", "256.1.1.1", "+1 (705) 555-1902 x", "0" * 6000 + ".1.1.1"])
def test_known(text):
    if len(text) < 4000:
        assert pii.base_spans(text) == plain(text)
    else:
        assert pii.base_spans(text) == [("ip", 0, 6006)]


def test_rules_stay_linear():
    for text in ("a" * 300000, "1" * 300000, "1." * 150000, "@" * 300000, "a@" * 150000, "+1" * 150000, "1 " * 150000):
        pii.instances(text, pii.base_spans(text))


@pytest.fixture(scope="module")
def mail(spark, store):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(40):
        filler = " ".join(word() for _ in range(20))
        rows.append((i, f"{filler} please write to: {word()}@{word()}.example {filler}"))
        rows.append((100 + i, f"{filler} of the 1{i}th day of the {word()} of the {word()} {filler}"))
    rows.append((200, f"{word()} please write to: {word()}(at){word()}.example99 now"))  # no rule knows it
    rows.append((201, f"{word()} of the A{word()}77 day"))  # a common phrase before it
    rows.append((202, f"Please write to: ordinary words, {word()}"))
    return rows, store(spark.createDataFrame(rows, "doc_id long, text string"), "mail")


def test_trusted_patterns_find_what_rules_do_not(mail):
    rows, df = mail
    text = dict(rows)
    out = {r.doc_id: r for r in pii.find(df).collect()}
    extra = {d: r.spans for d, r in out.items() if r.spans != pii.spell(plain(text[d]))}
    start = text[200].index("to: ") + 4
    assert extra == {200: f"email:{start}:{text[200].rindex(' ')}"}
    assert out[200].n_email == 0


def test_edge_cases(docs, empty):
    out = pii.find(docs).collect()
    assert len(out) == len(texts())
    none = hashlib.sha256(b"").hexdigest()
    for r in out:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) == (0, 0, 0, 0, none, "")
    assert pii.find(empty).count() == 0


def test_line_start_spaced_identifiers_and_new_seeds(spark, store):
    rng = random.Random(4)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows = []
    for i in range(40):
        rows.append((i, f"{word()} {word()}\nTel: +49 30 {digits(7)}\n{word()}"))
        if i < 12:  # found by Tel:, and the seeds of Rufnummer:
            number = f"030 {digits(4)} {digits(4)}"
            rows.append((100 + i, f"Tel: {number}"))
            rows.append((200 + i, f"{word()}\nRufnummer: {number}\n{word()}"))
            rows.append((300 + i, f"{word()} +49 30 {digits(7)} (mobile number) {word()}"))
    rows += [(400, "Rufnummer: 0171 555 1234"), (401, f"{word()} 0172 555 1234 (mobile number) {word()}"), (402, f"{word()} 0172 555 9999 {word()}")]
    df = store(spark.createDataFrame(rows, "doc_id long, text string"), "spaced")
    out, text = {r.doc_id: r.spans for r in pii.find(df).collect()}, dict(rows)
    for d in [*range(100, 112), *range(200, 212), 400, 401]:
        number = re.search(r"[0-9][0-9 ]+[0-9]", text[d])
        assert out[d] == f"phone:{number.start()}:{number.end()}", d
    assert out[402] == ""


def test_secrets_by_glue_prefix_and_context(spark, store):
    """Key-like tokens are seeds only: what their patterns introduce is found,
    short ones too, and a lone key-like token is not."""
    rng = random.Random(6)
    drawn = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 4)) + "a1b2"
    word = lambda: "".join(rng.choice("ghijklmnop") for _ in range(6))
    rows, want = [], {}
    for i in range(30):
        for k, (before, n) in enumerate((("password=", 18), ('token = "', 40), ("ZQXW", 16), ("", 20))):
            value = drawn(n)
            lead = f"{word()} {before}"
            doc = 100 * k + i
            rows.append((doc, f'{lead}{value}{chr(34) if k == 1 else ""} {word()}'))
            start = len(lead) - (4 if k == 2 else 0)
            want[doc] = "" if k == 3 else f"secret:{start}:{len(lead) + n}"
    rows.append((900, f"{word()} password=kurz77 {word()}"))  # by its pattern alone
    want[900] = f"secret:{len('123456 password=')}:{len('123456 password=kurz77')}"
    out = {r.doc_id: r.spans for r in pii.find(store(spark.createDataFrame(rows, "doc_id long, text string"), "secrets")).collect()}
    assert out == want


def test_places_against_a_plain_count(spark, store):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["id:", "id:", "of", "the", f"A{rng.randint(1000, 9999)}7", "\n"]) for _ in range(60))) for i in range(40)]
    df = store(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "places")
    edges = [(pattern, a) for _, text in rows for pattern, a, *_ in pii.instances(text, pii.base_spans(text))]
    found = spark.createDataFrame(edges, "pattern string, instance string")
    got = {r.pattern: r.places for r in pii.places(df, found, pii.Scratch(spark, "t")).collect()}
    seen: dict = {}
    for pattern, a in edges:
        seen.setdefault(pattern, set()).add(a)
    for pattern, n in got.items():
        words = pattern.replace(pii.GAP, "").split(" ")
        flat = [w for _, text in rows for w in pii._words(text)]
        if pattern[0] == pii.HEAD:
            assert n == sum(w[:4] == pattern[1:] for w in flat)
        else:
            assert n == sum(flat[i : i + len(words)] == words for i in range(len(flat)))
    assert set(got) == {p for p, a in seen.items() if len(a) >= pii.MIN_SEEDS}
