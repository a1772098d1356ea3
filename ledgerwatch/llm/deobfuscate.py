"""Personal data, also where it is disguised, with spans in the original text.

Plain forms are found first: e-mail, IP, card and phone, leftmost and without overlaps per kind.
Then a transducer rewrites the text: look-alike letters and foreign digits become ASCII, invisible
characters go, spelled digits become digits, and "at" and "dot" disguises become ``@`` and ``.``.
Every rewritten piece remembers the source span it came from.  The same finders run over the result;
a hit that contains a rewritten piece, maps to source characters free of plain hits of its kind, is
added.  Bare "at" counts before a disguised dot, or between a mailbox and a host that ends in a common
last label; bare "dot" before a common last label or a digit, or before any last label after a disguised
"at".  Words of prose are no mailboxes and no last labels there, so ordinary prose stays clean.  Blanks
between spelled digits go inside four dotted numbers.

One pass over whole texts, no shuffle.  All finders take time in proportion to the text.

Null and empty texts have no spans.  Positions are code points, ends exclusive.  Repeated rows and
null ids each give their row, an empty table none.  Other columns are ignored.
"""

import re
import unicodedata
from bisect import bisect_right

import pandas as pd
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,plain:boolean>>"

# Look-alikes of ASCII letters in Cyrillic and Greek, in pairs.
LOOKALIKES = dict(zip(
    "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧοντυρ",
    "aeopcyxijshdqwABEKMHOPCTYXIJSABEZHIKMNOPTYXovtup", strict=True))
DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
INVISIBLE = "­​‌‍⁠﻿"

# Last labels that end an address in which "at" and "dot" are plain words.
LAST_LABELS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "ai", "app", "dev",
               "eu", "de", "fr", "es", "it", "nl", "uk", "us", "ca", "ch", "at", "be", "pl", "ru",
               "se", "jp", "cn", "in", "br", "au", "mx")

# Full-width forms, decimal digits of the scripts of the basic plane and mathematical digits, by rule.
_ASCII = {ord(k): v for k, v in LOOKALIKES.items()}
_ASCII |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
_ASCII |= {c: str(unicodedata.decimal(chr(c))) for c in [*range(128, 0x10000), *range(0x1D7CE, 0x1D800)]
           if unicodedata.decimal(chr(c), None) is not None}


def _char_class(codes):
    """A character class of code-point ranges."""
    out, codes = [], sorted(codes)
    for c in codes:
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out) + "]"


_FOREIGN = re.compile(_char_class([*_ASCII, *map(ord, INVISIBLE)]))

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is entered at its beginning only, which keeps the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DECIMAL = re.compile(r"\.[0-9]")  # cheap to search: no IP without it
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_WORD, _LAST = "|".join(DIGIT_WORDS), "|".join(LAST_LABELS)

# Gaps and labels are of bounded length, so no search goes back over a long run.
_GAP, _SOME, _LABEL = r"\s{0,3}", r"\s{1,3}", "[a-z0-9-]{1,63}"
_OPEN, _SHUT = rf"{_GAP}[\[({{<]{_GAP}", rf"{_GAP}[\])}}>]{_GAP}"
_DOT = rf"(?:{_OPEN}(?:dot|\.){_SHUT}|{_SOME}dot{_SOME})"
_ADDRESS = rf"(?={_LABEL}{_DOT}[a-z0-9])"
_REWRITE = re.compile(
    rf"(?P<at>{_OPEN}(?:at|@){_SHUT}|{_SOME}@{_GAP}{_ADDRESS}|{_SOME}at{_SOME}{_ADDRESS})"
    rf"|(?P<dot>{_OPEN}(?:dot|\.){_SHUT}|(?<=[a-z0-9]){_SOME}dot{_SOME}"
    rf"(?=(?:{_LABEL}(?:{_SOME}dot{_SOME}|\.)){{0,6}}(?:(?:{_LAST})\b|[0-9]|(?:{_WORD})\b)))"
    rf"|(?P<plus>\bplus{_SOME}(?=[0-9]|(?:{_WORD})\b))"
    rf"|\b(?P<digit>{_WORD})\b"
    rf"|(?P<gone>[{INVISIBLE}]+)", re.IGNORECASE)
_BRACKET = re.compile(rf"[\[({{<]{_GAP}(?:at|@|dot|\.){_GAP}[\])}}>]", re.IGNORECASE)
_SPOKEN = re.compile(rf"\b(?:plus\s|(?:{_WORD})\b)")
# Letters that the patterns take for s and i when they ignore case.
_FOLD = {ord("\u017f"): "s", ord("\u0131"): "i", ord("\u0130"): "i"}

_AT_HOST = re.compile(r"\bat\s{1,3}[a-z0-9-]{1,63}\.[a-z]")

# Words of prose that are no last label, and that stand before "at" without being a mailbox.
_NO_LABEL = ("a an and but or nor so yet if then than that this these those the he she they we you i it its his her "
             "their our my your is am are was were be been to of on by for from with as at not no do does did have has "
             "had can could will would should may might must there here when where what who why how all each every "
             "some everyone everything nobody nothing").split()
_NO_LOCAL = frozenset((
    "look looks looked looking meet meets met meeting arrive arrives arrived arriving visit visits us me him her them "
    "it you available found find live lives lived living stay stays stayed see seen read here there hosted online "
    "site website page blog shop store work works worked working sold buy bought start starts started starting end "
    "ends ended open opens opened be is are was were am been and or not only also still now right people one out up "
    "back down over home time more details information posted published listed located based aimed point pointed "
    "stop stopped sit sat stand stood laugh laughed shout shouted good bad better best free learn order download "
    "register join check checked eat ate sleep shopping prices view watch watched play played").split())
_MAIL = re.compile(
    rf"(?<![a-z0-9._%+-])(?P<local>[a-z0-9._%+-]{{1,64}})"
    rf"(?:(?P<bare>{_SOME}at{_SOME})|(?P<other>{_OPEN}(?:at|@){_SHUT}|{_SOME}@{_GAP}))"
    rf"(?P<host>{_LABEL}(?:(?:{_DOT}|\.){_LABEL}){{0,5}}(?:{_DOT}|\.)(?!(?:{'|'.join(_NO_LABEL)})\b)"
    rf"(?P<last>[a-z]{{2,63}}))(?![a-z0-9-])", re.IGNORECASE)
_ONE_DOT = re.compile(_DOT, re.IGNORECASE)
_NUMBER = rf"(?:(?:{_WORD})(?:{_SOME}(?:{_WORD})){{0,2}}|[0-9]{{1,3}})"
_SPOKEN_IP = re.compile(rf"\b{_NUMBER}(?:(?:{_DOT}|\.){_NUMBER}){{3}}\b", re.IGNORECASE)
_BETWEEN = re.compile(rf"\b(?:{_WORD})({_SOME})(?=(?:{_WORD})\b)", re.IGNORECASE)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text):
    return [c for c in text if "0" <= c <= "9"]


def emails(text):
    """Spans as the leftmost search finds them, from one ``@`` to the next."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def plain(text):
    """(kind, start, end) of the undisguised forms in the order of kinds and places."""
    out = [("email", *s) for s in emails(text)]
    for m in _IP.finditer(text) if _DECIMAL.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
               for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() < 40 else ()
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def _whole_forms(text):
    """(start, end, new) inside addresses and spoken IPs that are known only as a whole."""
    for m in _MAIL.finditer(text):
        dots = [d.span() for d in _ONE_DOT.finditer(text, *m.span("host"))]
        bare = m["bare"] is not None
        if bare and m["local"].lower() in _NO_LOCAL:
            continue
        if not dots and not (bare and m["last"].translate(_FOLD).lower() in LAST_LABELS
                             and text[m.end():m.end() + 1] not in ("/", ":")):
            continue
        yield *m.span("bare" if bare else "other"), "@"
        yield from ((*d, ".") for d in dots)
    for m in _SPOKEN_IP.finditer(text):
        yield from ((*b.span(1), "") for b in _BETWEEN.finditer(text, *m.span()))


def rewrite(text):
    """(normalised text, pieces): pieces are (place, source start, source end, changed)."""
    out, pieces, size, last = [], [], 0, 0

    def add(piece, start, end, changed):
        nonlocal size
        pieces.append((size, start, end, changed))
        out.append(piece)
        size += len(piece)

    def copy(start, end):
        """Source characters, with look-alikes replaced one by one."""
        at = start
        for m in _FOREIGN.finditer(text, start, end) if not text.isascii() else ():
            if m.start() > at:
                add(text[at:m.start()], at, m.start(), False)
            add(m.group().translate(_ASCII), m.start(), m.end(), True)
            at = m.end()
        if at < end:
            add(text[at:end], at, end, False)

    clean = text.translate(_ASCII)
    changes = list(_whole_forms(clean))
    for m in _REWRITE.finditer(clean):
        new = {"at": "@", "dot": ".", "plus": "+", "gone": ""}.get(m.lastgroup)
        if new is None:
            new = str(DIGIT_WORDS.index(m.group().translate(_FOLD).lower()))
        changes.append((*m.span(), new))
    for start, end, new in sorted(changes, key=lambda c: c[:2]):
        if start >= last:
            copy(last, start)
            add(new, start, end, True)
            last = end
    copy(last, len(text))
    return "".join(out), pieces


def _source(pieces, places, start, end):
    """Source span of normalised [start, end), and whether it holds a rewritten piece."""
    i, j = bisect_right(places, start) - 1, bisect_right(places, end - 1) - 1
    place, begin, _, changed = pieces[i]
    low = begin if changed else begin + start - place
    place, begin, stop, changed = pieces[j]
    high = stop if changed else begin + end - place
    return low, high, any(p[3] for p in pieces[i:j + 1])


def disguised(text):
    """Whether the text holds anything the transducer could rewrite: no alternative is left out."""
    if not text.isascii():
        if _FOREIGN.search(text):
            return True
        text = text.replace("\u017f", "s").replace("\u0131", "i").replace("\u0130", "i")
    small = text.lower()
    return ("dot" in small or bool(_BRACKET.search(small)) or bool(_SPOKEN.search(small))
            or bool(_AT_HOST.search(small)))


def spans(text):
    """(kind, start, end, plain) of all identifiers, by kind as listed and place."""
    if not text:
        return []
    found = plain(text)
    out = [(*f, True) for f in found]
    if disguised(text):
        new, pieces = rewrite(text)
        # An empty piece shares its place with the next one, which then owns it.
        places = [p[0] for p in pieces]
        for kind, start, end in plain(new) if pieces else ():
            low, high, changed = _source(pieces, places, start, end)
            if changed and not any(k == kind and s < high and low < e for k, s, e in found):
                out.append((kind, low, high, False))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def detect(docs, id_col="doc_id", text_col="text"):
    """(id, spans) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        names = ("kind", "start", "end", "plain")
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "spans": [
                [dict(zip(names, s)) for s in spans(t)] for t in b["text"]]})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, spans {SPANS}").select(
        F.col("id").alias(id_col), "spans")


def redact(text, found):
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for kind, start, end, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{kind}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redacted(docs, text_col="text"):
    """``docs`` with all identifiers in the text replaced, other columns as they are."""

    @F.pandas_udf("string")
    def clean(text: pd.Series) -> pd.Series:
        return pd.Series([redact(t, spans(t)) if isinstance(t, str) else None for t in text],
                         dtype=object)

    return docs.withColumn(text_col, clean(F.col(text_col)))


def as_text(found):
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
