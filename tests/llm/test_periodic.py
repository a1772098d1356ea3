import hashlib
import random
import time

import numpy as np
import pytest

from ledgerwatch.llm import periodic, queries


def plain_runs(w, least_words=12, least_periods=2):
    """All runs by looking at every period; (start, length, period) by start, then period."""
    found, n = {}, len(w)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least_words, least_periods * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return [x for i, x in enumerate(w) if i not in gone]


def runs_by_text(texts, config):
    sizes = np.array([len(w) for w in texts], np.int64)
    flat = np.array(sum(texts, []), np.int64)
    text, *run = periodic.runs_of(flat, sizes, config)
    out = [[] for _ in texts]
    for t, *r in zip(text.tolist(), *(a.tolist() for a in run)):
        out[t].append(tuple(r))
    return out


def test_random_texts_equal_brute_force():
    rng = random.Random(5)
    for _ in range(600):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, letters = rng.choice([0, 1, 5, 12, 13, 40, 120]), rng.choice([1, 2, 3, 10])
            w = [rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.5:
                a = rng.randrange(n)
                p = rng.randint(1, max(1, (n - a) // 2))
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        config = periodic.RunConfig(portion=rng.choice([7, 100, 500_000]), seed=rng.randrange(99))
        assert runs_by_text(texts, config) == [plain_runs(w) for w in texts]


def test_other_limits():
    w = [0, 1, 0, 1, 0, 1, 5, 6, 5, 6, 9, 9, 9]
    config = periodic.RunConfig(least_words=3, least_periods=3)
    assert runs_by_text([w], config) == [plain_runs(w, 3, 3)] == [[(0, 6, 2), (10, 3, 1)]]


def test_extensions_equal_comparison():
    rng = random.Random(8)
    for _ in range(100):
        w = [rng.randrange(2) for _ in range(60)] + [1] * rng.randrange(30) + [0, 1] * rng.randrange(20)
        s = np.array([-1, *w, -2])
        levels = periodic.grammar(s)
        x, y = np.array([(i, j) for i in range(1, len(w)) for j in range(i + 1, len(w) + 1)]).T
        ahead = periodic.extensions(levels, x, y)
        for i, j, n in zip(x, y, ahead):
            k = 0
            while s[i + k] == s[j + k]:
                k += 1
            assert n == k


@pytest.mark.parametrize("w", [[0] * 300_000, [0, 1, 2] * 100_000, list(range(300_000))])
def test_long_texts_in_n_log_n(w):
    start = time.perf_counter()
    runs = runs_by_text([w], periodic.RunConfig())[0]
    assert time.perf_counter() - start < 60
    assert runs == ([] if w[-1] > 2 else [(0, len(w), len(set(w)))])


def test_nulls_ties_repeats_and_clashing_names(spark, docs):
    a = " ".join(["a b"] * 6)
    rows = [(1, None), (2, ""), (3, " \n"), (None, a), (5, a), (5, a), (6, f"{a}\tz {a}  x"),
            (2**60 + 1, "one\x0btwo")]
    got = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                  for r in periodic.detect(docs(rows, extra=True)).collect()))
    run = [(0, 12, 2)]
    assert got == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (0, 12, run, "a b"), (5, 12, run, "a b"),
        (5, 12, run, "a b"), (6, 26, [(0, 12, 2), (13, 12, 2)], "a b z a b  x"),
        (2**60 + 1, 2, [], "one two")])
    assert periodic.detect(docs(rows).limit(0)).collect() == []
    best = docs([(1, f"{a} z {a} q " + "w " * 12)])
    best = periodic.detect(best).select(periodic.longest("runs").alias("b")).first().b
    assert (best.start, -best.n, best.period) == (0, 12, 2)


def test_query_equals_brute_force(spark, sf, real):
    expected = {}
    for doc_id, text in real:
        w = queries.periodic_tail(doc_id, (text or "").encode().split())
        if len(w) > 3000:
            continue  # the plain way is quadratic
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        expected[doc_id] = (
            len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(plain_collapsed(w, runs))).hexdigest())
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256,
                      r.collapsed_sha256) for r in queries.op11_recompression(spark, sf).collect()}
    assert {k: got[k] for k in expected} == expected and len(got) == len(real)
    assert sum(1 for r in expected.values() if r[0]) > 10
