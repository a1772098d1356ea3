import math
import random
import re
from collections import Counter

import pytest

from ledgerwatch.llm import decontam as d

QUESTION = ("Which of the seven bridges over the river was opened first, and in which year did the "
            "town council decide to build it? The old stone bridge, decided in 1381 and opened "
            "nineteen years later by the bishop.")


def words(text):
    return re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def make(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def bm25(passages, items, c):
    """{(passage, item): normalised score} of all pairs."""
    bags = {i: Counter(words(t)) for i, t in items}
    mean = sum(sum(b.values()) for b in bags.values()) / len(bags)
    df = Counter(w for b in bags.values() for w in b)
    part = {}
    for i, b in bags.items():
        n = sum(b.values())
        part[i] = {w: math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * tf * (c.k1 + 1)
                   / (tf + c.k1 * (1 - c.b + c.b * n / mean)) for w, tf in b.items()}
    return {(k, i): sum(x for w, x in ws.items() if w in set(p)) / sum(ws.values())
            for k, p in enumerate(passages) for i, ws in part.items()}


def test_bounds_lose_no_passage_above_the_threshold(spark):
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(60)] + ["the", "of", "and"] * 10
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 30))))
             for i in range(50)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(60)]
    texts += [" ".join(rng.sample(vocabulary, 20)) + " " + t for _, t in items[:20]]
    c = d.DecontamConfig(block_items=4, score=0.5)
    index, = d.build(make(spark, items), c)
    place = {item: k for k, item in enumerate(index.items)}
    seen = {}
    for t, text in enumerate(texts):
        raw = [text.encode()]
        hashes, at = d.words.word_hashes(raw)
        for _, first, last, item in index.candidates(hashes, at):
            seen[t, item] = max(seen.get((t, item), 0), index.score(hashes[first:last], item))
    window = 2 * max(index.longest, 16)
    passages, owner = [], []
    for t, text in enumerate(texts):
        w = words(text)
        for a in range(0, len(w), window // 2):
            passages.append(w[a:a + window])
            owner.append(t)
    want = {}
    for (k, i), s in bm25(passages, items, c).items():
        if s >= c.score:
            want[owner[k], place[i]] = max(want.get((owner[k], place[i]), 0), s)
    assert want and {k for k, s in seen.items() if s >= c.score} == set(want)
    assert all(seen[k] == pytest.approx(s) for k, s in want.items())


def test_tables_against_containment(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in d.matches(docs, items).collect()}
    tests = {r.item_id: " ".join(words(r.text)) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in tests.items()
            if f" {t} " in f" {' '.join(words(r.text))} "}
    assert got == want
    assert d.remove(docs, items).count() == docs.count() - len({i for i, _ in want})


def test_leaks_with_edits_and_near_misses(docs, spark):
    filler = " ".join(f"f{i}" for i in range(900))
    edited = QUESTION.replace("seven", "six").replace("river", "RIVER --")
    question = QUESTION.split("?")[0] + "?"
    rows = [(1, f"{filler} {QUESTION} {filler}"), (2, edited), (3, filler), (4, question + " " + filler),
            (5, QUESTION.split("?")[1]), (6, None), (7, ""), (1, QUESTION), (None, QUESTION)]
    items = make(spark, [(1, QUESTION), (2, None), (3, ""), (4, "short one"), (1, QUESTION), (8, QUESTION)])
    got = sorted((r.doc_id or -1, r.item_id) for r in d.matches(docs(rows, extra=True), items).collect())
    assert got == [(i, k) for i in (-1, 1, 2) for k in (1, 8)]
    left = d.remove(docs(rows, extra=True), items)
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6, 7]
    assert left.columns == docs(rows, extra=True).columns


def test_items_of_one_to_four_words(docs, spark):
    items = [(n, " ".join(f"short{n}x{k}" for k in range(n))) for n in range(1, 5)]
    rows = [(n, f"some words before {t}, and after") for n, t in items] + [
        (5, items[2][1]), (6, "short3x0 and short3x1 but not short3x2"), (7, "nothing of it at all")]
    got = sorted((r.doc_id, r.item_id) for r in d.matches(docs(rows), make(spark, items)).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 3)]
    assert sorted(r.doc_id for r in d.remove(docs(rows), make(spark, items)).collect()) == [6, 7]


def test_one_id_with_two_texts(docs, spark):
    other = "A quite different second text that stands under the same id for once. It has an answer."
    items = make(spark, [(1, QUESTION), (1, other)])
    got = {r.doc_id for r in d.matches(docs([(1, QUESTION), (2, other), (3, "x y")]), items).collect()}
    assert got == {1, 2}


def test_slices_and_pieces(docs, spark):
    long = " ".join(f"q{i}" for i in range(1500))
    items = make(spark, [(1, QUESTION), (2, long), (3, "a completely different item of text here")])
    c = d.DecontamConfig(slice_items=1)
    rows = [(1, QUESTION), (2, f"x y z {long} x"), (3, "nothing")]
    got = {(r.doc_id, r.item_id) for r in d.matches(docs(rows), items, c).collect()}
    assert got == {(1, 1), (2, 2)}
    assert [r.doc_id for r in d.remove(docs(rows), items, c).collect()] == [3]


def test_a_long_item_counts_as_a_whole(docs, spark):
    w = [f"q{i}" for i in range(517)]
    read = [f"r{i}" for i in range(1200)]
    asked = " ".join(read) + "? " + " ".join(f"a{i}" for i in range(60)) + "."
    items = make(spark, [(1, " ".join(w)), (2, asked)])
    rows = [(1, "x y " + " ".join(w[-5:]) + " z"), (2, "x " + " ".join(w) + " y"), (3, " ".join(w[:300])),
            (4, "x " + " ".join(w[40:]) + " y"), (5, " ".join(read)), (6, f"x y {asked} z"),
            (7, " ".join(read[:600])), (8, " ".join(w[259:]))]
    got = {(r.doc_id, r.item_id): r for r in d.matches(docs(rows), items).collect()}
    assert set(got) == {(2, 1), (4, 1), (6, 2)}
    assert got[2, 1].overlap == 1 and got[4, 1].overlap == pytest.approx(473 / 513)
    assert sorted(r.doc_id for r in d.remove(docs(rows), items).collect()) == [1, 3, 5, 7, 8]


def test_empty_tables(docs, spark):
    none = make(spark, [])
    assert d.matches(docs([(1, "a")]), none).count() == 0 and d.remove(docs([(1, "a")]), none).count() == 1
    assert d.matches(docs([]), make(spark, [(1, QUESTION)])).count() == 0
