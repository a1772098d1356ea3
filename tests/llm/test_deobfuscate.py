import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import deobfuscate as d
from ledgerwatch.llm import queries

CARD = "4111 1111 1111 1111"


def base(text):
    """The plain forms straight from their patterns."""
    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c)
                   for i, c in enumerate(reversed(s))) % 10 == 0

    def all_of(kind, pattern, good=lambda s: True):
        return [(kind, *m.span()) for m in re.finditer(pattern, text) if good(m.group())]

    return [
        *all_of("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        *all_of("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                lambda s: all(int(p) <= 255 for p in s.split("."))),
        *all_of("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
        *all_of("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)]


PARTS = st.sampled_from(["a", "b.", "@", "@b.c", "1", "23", ".", "-", " ", "+1", CARD, "255", "256.1",
                         "(", ")", "é", "x@y.z", "+", " dot ", " at ", "one ", "[at]", "0 "])


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS | st.text(max_size=3), max_size=16).map("".join))
def test_plain_forms_equal_their_patterns_and_stay(text):
    assert d.plain(text) == base(text)
    found = d.spans(text)
    assert [s[:3] for s in found if s[3]] == base(text)
    for kind in d.KINDS:  # no overlaps within a kind
        own = [s for s in found if s[0] == kind]
        assert all(x[2] <= y[1] for x, y in zip(own, own[1:]))
    assert all(0 <= s[1] < s[2] <= len(text) for s in found)


@pytest.mark.parametrize("text, kind, hidden", [
    ("write to john.doe (at) example (dot) com now", "email", "john.doe (at) example (dot) com"),
    ("mail john at example dot com.", "email", "john at example dot com"),
    ("bob[at]mail[.]org, please", "email", "bob[at]mail[.]org"),
    ("eve @ mail dot net", "email", "eve @ mail dot net"),
    ("see аlice@exаmple.com ok", "email", "аlice@exаmple.com"),
    ("u​ser@ex​ample.com", "email", "u​ser@ex​ample.com"),
    ("ip 192 dot 168 dot 1 dot 7 up", "ip", "192 dot 168 dot 1 dot 7"),
    ("call plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven"),
    ("card four one one one 1111 1111 1111 end", "card", "four one one one 1111 1111 1111"),
    ("card ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("日本 𝟒𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏 x", "card", "𝟒𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏𝟏"),
])
def test_disguises_map_back(text, kind, hidden):
    (got, start, end, plain), = d.spans(text)
    assert (got, text[start:end], plain) == (kind, hidden, False)


@pytest.mark.parametrize("text", [
    "meet at noon dot he said", "look at this.that is dot fine", "one two three", "at dot com", "(at)",
    "Привет, мир. Это текст", "Ελληνικά γράμματα", "chapter one dot two", "", "dot dot dot", "seven at nine"])
def test_prose_stays_clean(text):
    assert d.spans(text) == []


@pytest.mark.parametrize("text, kind, hidden", [
    ("mail john at example.com today", "email", "john at example.com"),
    ("mail john at mail.example dot com", "email", "john at mail.example dot com"),
    *[(f"to jane at firm dot {last}, please", "email", f"jane at firm dot {last}")
      for last in ("shop", "xyz", "nz", "kr", "pt", "gr")],
    ("bob (at) firm (dot) shop", "email", "bob (at) firm (dot) shop"),
    ("ip one nine two dot one six eight dot one dot one up", "ip",
     "one nine two dot one six eight dot one dot one")])
def test_wider_disguises_map_back(text, kind, hidden):
    assert [(k, text[a:b], plain) for k, a, b, plain in d.spans(text)] == [(kind, hidden, False)]


@pytest.mark.parametrize("text", [
    "look at example.com for more", "available at example.org.", "paper at example.com/path", "run at node.js",
    "meet at noon dot everyone came", "we met at ten dot then he left", "anna at home dot and so on",
    "one two dot three four dot five", "look at this dot that is all"])
def test_prose_stays_clean_of_wider_disguises(text):
    assert d.spans(text) == []


def test_plus_before_ordinary_digits():
    text = "call plus 49 170 1234567 today"
    assert [(k, text[a:b], plain) for k, a, b, plain in d.spans(text)] == [
        ("phone", "plus 49 170 1234567", False)]


@settings(max_examples=500, deadline=None)
@given(st.lists(PARTS | st.sampled_from(
    ["plus 49 170 1234567", "plus\n", "plus", "[.]", " dot com", "\u017feven ", "f\u0131ve ", "s\u0130x ", "nine", "x",
     " at b.com", "joe at mail.org", "\u212a"]) | st.text(max_size=3), max_size=10).map("".join))
def test_the_gate_loses_nothing(text):
    gate, gated = d.disguised, d.spans(text)
    try:
        d.disguised = lambda t: True
        assert d.spans(text) == gated
    finally:
        d.disguised = gate


def test_searches_are_linear():
    start = time.time()
    for text in ("1" * 200_000 + " dot ", " " * 200_000 + "dot", "a" * 200_000 + "@ dot", "1." * 100_000,
                 "+1" * 100_000, "[" * 100_000 + "dot", " at" * 60_000 + " dot", "a dot " * 40_000, "9 " * 100_000):
        d.spans(text)
    assert time.time() - start < 30


def test_rows_redaction_and_query(docs, spark, tmp_path):
    rows = [(1, f"x@y.org {CARD} +1 555 123 4567"), (2, None), (3, ""), (None, "a at b dot com"), (1, "dup 1.2.3.4")]
    got = sorted(((r.doc_id or 0), len(r.spans)) for r in d.detect(docs(rows, extra=True)).collect())
    assert got == [(0, 1), (1, 1), (1, 3), (2, 0), (3, 0)]
    texts = {r.text for r in d.redacted(docs(rows, extra=True)).collect()}
    assert texts == {"[email] [card] [phone]", None, "", "[email]", "dup [ip]"}
    assert d.detect(docs([])).count() == 0
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    out = {(r.doc_id, r.n_ip): r for r in queries.QUERIES["op10_deobfuscation"](spark, str(tmp_path)).collect()}
    one, hidden = out[1, 0], out[None, 0]
    want = ",".join(":".join(map(str, s)) for s in base(rows[0][1]))
    assert one.spans == want and one.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (one.n_email, one.n_card, one.n_phone) == (1, 1, 1)
    assert hidden.n_email == 1 and hidden.base_sha256 == hashlib.sha256(b"").hexdigest()
