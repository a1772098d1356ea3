import hashlib
import re

import pytest

from ledgerwatch.llm import blocknames as b


def brute(rows):
    groups = {}
    for i, (doc, text, *_) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(body, []).append((-len(text or ""), doc is None, doc or 0, i))
    out = []
    for i, (doc, text, *_) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        g = groups[body]
        best = min(g)
        out.append((doc, None if best[1] else best[2], len(g),
                    hashlib.sha256(body.encode()).hexdigest()))
    return out, sum(1 for _ in groups)


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("config", [
    b.NamingConfig(), b.NamingConfig(block_bytes=7, bucket_rows=20),
    b.NamingConfig(block_bytes=5, hash_bits=3, bucket_rows=50)])
def test_against_brute_force(docs, real, config):
    rows = [(1, "a b c"), (2, "abc"), (3, " a  bc "), (4, None), (5, ""), (6, " \n\t"), (None, "abc"),
            (7, "ab c"), (7, "ab c"), (8, "é" * 40), (9, "é " * 40), (10, "é" * 39)]
    if config.block_bytes > 5:
        rows += [(100 + i, t) for i, t in real[:40]] + [(200, real[0][1].replace(" ", "\n"))]
    else:  # long texts with repeated and shared parts
        rows += [(20 + i, "abcde" * i) for i in range(12)] + [(50, "abcde" * 11 + "x")]
    got = b.deduplicate(docs(rows, extra=True), config).collect()
    want, groups = brute(rows)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) \
        == sorted(want, key=key)
    assert sum(r.kept for r in got) == groups


def test_long_text_takes_many_levels(docs):
    text = "".join(chr(97 + i * 7919 % 26) for i in range(50_000))
    rows = [(1, text), (2, text[:-1] + "!"), (3, text + " "), (4, text[:25_000])]
    got = {r.doc_id: r for r in b.deduplicate(docs(rows), b.NamingConfig(block_bytes=64)).collect()}
    assert got[1].keep_id == 3 and got[3].kept and got[2].group_size == got[4].group_size == 1


def test_empty_table(docs):
    assert b.deduplicate(docs([])).count() == 0
