import math
import random
import re
from collections import Counter

import numpy as np

from ledgerwatch.llm import probminhash as p


def shingles(text, k=5):
    w = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", (text or "").lower())
    counts = Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else {}
    return Counter({s: 1 + math.log10(n) for s, n in counts.items()})


def similarity(x, y):
    """Probability Jaccard by its definition."""
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in set(x) & set(y))


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    bags = {i: shingles(t) for i, t in rows}
    ids, pairs = sorted(bags), []
    for k, i in enumerate(ids):
        for j in ids[:k]:
            x, y = bags[i], bags[j]
            if x == y or (x and y and similarity(x, y) >= 0.8):
                pairs.append((i, j))
    return union(pairs, ids)


def edited(text, rng, changes):
    w = text.split()
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_signatures_estimate_and_verification_is_exact():
    rng = random.Random(3)
    base = " ".join(f"t{rng.randrange(40)}" for _ in range(120))
    texts = [base, edited(base, rng, 4), edited(base, rng, 12), base + " " + base, "one two", "x"]
    (grams, weights, at, *_), = [p.weighted([t.encode() for t in texts], 5)]
    signed = p.signatures(grams, weights, at, 2048)
    vectors = [(grams[i:j], weights[i:j]) for i, j in zip(at, at[1:])]
    for i in range(len(texts)):
        for j in range(len(texts)):
            exact = p.probability_jaccard(*vectors[i], *vectors[j])
            assert abs(exact - similarity(shingles(texts[i]), shingles(texts[j]))) < 1e-9
            assert abs((signed[i] == signed[j]).mean() - exact) < 0.06


def test_early_termination_changes_nothing():
    # The same shingle set in another batch, beside a large text, gets the same signature.
    rng = random.Random(5)
    small = " ".join(f"a{rng.randrange(99)}" for _ in range(30))
    large = " ".join(f"b{rng.randrange(99)}" for _ in range(3000))
    one = p.signatures(*p.weighted([small.encode()], 5)[:3], 128)
    two = p.signatures(*p.weighted([large.encode(), small.encode(), b""], 5)[:3], 128)
    assert (one[0] == two[1]).all() and not two[2].any()


def test_classes_equal_brute_force(docs):
    rng = random.Random(1)
    rows, number = [], 0
    for group in range(25):
        base = " ".join(f"g{group}w{rng.randrange(500)}" for _ in range(rng.choice([8, 60, 200])))
        for changes in (0, 0, 1, 1, 2, 6, 20):
            rows.append((number, edited(base, rng, min(changes, len(base.split()) // 40 + 1))
                         if changes < 20 else edited(base, rng, 30)))
            number += 1
    rows += [(900, None), (901, ""), (902, "..."), (903, "two words"), (904, "Two, WORDS!")]
    got = {r.doc_id: r for r in p.classes(docs(rows, extra=True)).collect()}
    want = brute(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[want[i]] for i, r in got.items())
    assert got[903].copies == 2


def test_a_line_repeated_many_times_does_not_join_texts(docs):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(120)) + " same old" * 300) for i in range(30)]
    assert len({r.class_id for r in p.classes(docs(rows)).collect()}) == 30


def test_large_group_around_one_text(docs):
    rng = random.Random(2)
    base = " ".join(f"w{rng.randrange(10 ** 5)}" for _ in range(150))
    rows = [(i, edited(base, rng, 2)) for i in range(200)] + [(500, base)] + [(600 + i, base)
                                                                             for i in range(100)]
    assert {r.class_id for r in p.classes(docs(rows)).collect()} == {0}


def test_every_similar_pair_of_a_bucket_is_one_class(docs):
    # One band of one row: large buckets, and chains whose ends are far from any centre.
    rng, rows = random.Random(7), []
    common = [f"c{k}" for k in range(60)]
    for chain in range(6):
        own = [f"h{chain}x{k}" for k in range(100)]
        for step in range(12):
            rows.append((len(rows), " ".join(common + own)))
            at = rng.randrange(90)
            own = own[:at] + [f"n{chain}y{step}z{k}" for k in range(6)] + own[at + 6:]
    rng.shuffle(rows)
    c = p.NearConfig(bands=1, rows=1, exact=True)
    got = {r.doc_id: r.class_id for r in p.classes(docs(rows), c).collect()}
    key = {r.id: r.bands[0] for r in p.sketch(docs(rows), c, "doc_id", "text").collect()}
    bags = {i: shingles(t) for i, t in rows}
    near = [(i, j) for i in bags for j in bags if i < j and key[i] == key[j]
            and similarity(bags[i], bags[j]) >= 0.8]
    assert len(near) > 20 and [(i, j) for i, j in near if got[i] != got[j]] == []
    assert got == union(near + [(i, got[i]) for i in got], bags)


def test_null_ids_and_ids_with_several_texts(docs):
    def text(n):
        return " ".join(f"d{n}w{k}" for k in range(60))

    near = text(1).replace("d1w59", "other")
    rows = [(3, text(1)), (5, text(1)), (5, text(2)), (5, text(2)), (7, text(2) + " more"), (None, text(1)),
            (None, text(3)), (None, text(3)), (8, text(4)), (8, near), (9, None), (9, text(5))]
    got = Counter((r.doc_id, r.class_id, r.class_size) for r in p.classes(docs(rows, extra=True)).collect())
    assert got == {(3, 3, 3): 1, (5, 3, 3): 1, (8, 3, 3): 1, (5, 5, 2): 1, (7, 5, 2): 1, (8, 8, 1): 1,
                   (9, 9, 1): 2, (None, None, None): 3}
    kept = Counter((r.doc_id, r.text) for r in p.keep_one(docs(rows, extra=True)).collect())
    assert kept == {(3, text(1)): 1, (5, text(2)): 2, (None, text(1)): 1, (None, text(3)): 2, (8, text(4)): 1,
                    (9, None): 1, (9, text(5)): 1}


def test_one_of_each_class_stays(docs, real):
    rows = [*real[:60], (None, "null id"), real[0]]
    source = docs(rows, extra=True)
    kept = p.keep_one(source)
    assert kept.columns == source.columns
    want = brute(real[:60])
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == set(want.values()) | {None}
    assert p.keep_one(docs([])).count() == 0 and p.classes(docs([])).count() == 0


def test_band_keys_differ_between_bands():
    keys = p.band_keys(np.zeros((2, 128), np.uint64), 25, 5)
    assert len(set(keys[0])) == 25 and (keys[0] == keys[1]).all()


def pair_recall(rows, got, chosen):
    """Similar pairs of a chosen and any other text, and those of them in one class."""
    bags = {i: shingles(t) for i, t in rows}
    near = [(i, j) for i in chosen for j in bags if i != j and similarity(bags[i], bags[j]) >= 0.8]
    return len(near), sum(got[i] == got[j] for i, j in near)


def test_recall_on_near_misses(docs):
    # One family: any two texts are about 0.7 alike, and each has one partner of 0.8 or more.
    rng, rows = random.Random(9), []
    base = [f"c{k}" for k in range(200)]
    for pair in range(100):
        own = list(base)
        for k in rng.sample(range(200), 5):
            own[k] = f"p{pair}x{k}"
        partner = list(own)
        for k in rng.sample(range(200), 3):
            partner[k] = f"q{pair}x{k}"
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(partner))]
    got = {r.doc_id: r.class_id for r in p.classes(docs(rows)).collect()}
    near, met = pair_recall(rows, got, [i for i, _ in rows if i % 20 == 0])
    assert near >= 10 and met >= 0.9 * near


def test_no_link_of_a_bucket_is_lost(docs):
    # Few bands and a family of near misses: the partners meet in buckets whose centres are other texts.
    rng, rows = random.Random(9), []
    base = [f"c{k}" for k in range(200)]
    for pair in range(60):
        own = list(base)
        for k in rng.sample(range(200), 5):
            own[k] = f"p{pair}x{k}"
        partner = list(own)
        for k in rng.sample(range(200), 3):
            partner[k] = f"q{pair}x{k}"
        rows += [(2 * pair, " ".join(own)), (2 * pair + 1, " ".join(partner))]
    c = p.NearConfig(bands=4, finer_rounds=0)
    got = {r.doc_id: r.class_id for r in p.classes(docs(rows), c).collect()}
    keys = {r.id: set(r.bands) for r in p.sketch(docs(rows), c, "doc_id", "text").collect()}
    bags = {i: shingles(t) for i, t in rows}
    near = [(i, j) for i in bags for j in bags if i < j and keys[i] & keys[j]
            and similarity(bags[i], bags[j]) >= 0.8]
    assert len(near) > 20 and [(i, j) for i, j in near if got[i] != got[j]] == []


def test_verification_in_slices_equals_the_definition(docs, monkeypatch):
    monkeypatch.setattr(p.words, "SLICE_BYTES", 300)
    rng = random.Random(4)
    base = " ".join(f"t{k}" for k in range(60))
    rows = [(i, edited(base, rng, i % 4)) for i in range(20)]
    texts = docs(rows).selectExpr("doc_id AS id", "text")
    pairs = texts.selectExpr("id AS a").crossJoin(texts.selectExpr("id AS b")).filter("a < b")
    got = {(r.a, r.b): r.similarity for r in p.verify(pairs, texts, p.NearConfig()).collect()}
    bags = {i: shingles(t) for i, t in rows}
    want = {(i, j): similarity(bags[i], bags[j]) for i in bags for j in bags if i < j}
    assert got.keys() == {k for k, v in want.items() if v >= 0.8}
    assert all(abs(v - want[k]) < 1e-9 for k, v in got.items())


def test_similarity_is_bounded_by_the_shared_parts():
    rng = random.Random(4)
    for _ in range(300):
        x, y = (Counter({k: 1 + rng.random() * rng.choice([0, 1, 5])
                         for k in rng.sample(range(14), rng.randrange(1, 14))}) for _ in range(2))
        both = set(x) & set(y)
        if both:
            part, other = sum(x[k] for k in both) / sum(x.values()), sum(y[k] for k in both) / sum(y.values())
            assert similarity(x, y) <= 1 / (1 / part + 1 / other - 1) + 1e-12


def test_exact_join_makes_few_pairs_just_below_the_similarity_and_loses_none(spark, docs):
    # One family just below and around 0.8, of texts of several lengths, some with repeated lines.
    rng, rows = random.Random(3), []
    base = [f"c{k}" for k in range(220)]
    for n in range(160):
        own = base[:rng.choice([180, 200, 220])] + base[:30] * (n % 3)
        for k in rng.sample(range(30, 170), rng.choice([1, 3, 3, 4, 4])):
            own[k] = f"e{n}x{k}"
        rows.append((n, " ".join(own)))
    grams, weights, at, *_ = p.weighted([t.encode() for _, t in rows], 5)
    bags = [(grams[i:j], weights[i:j]) for i, j in zip(at, at[1:])]
    near = {(i, j) for j in range(160) for i in range(j) if p.probability_jaccard(*bags[i], *bags[j]) >= 0.8}
    texts = spark.createDataFrame(rows, "id long, text string")
    nodes = spark.createDataFrame([(i, i) for i, _ in rows], "node long, class long")
    for words in (1, 16):  # few bins drop few pairs, but none that is similar
        found = {(r.a, r.b) for r in p.prefix_pairs(nodes, texts, p.NearConfig(parity_words=words)).collect()}
        assert near <= found
    assert 100 < len(near) and len(found) < 2 * len(near) < 160 * 159 / 2 / 3, (len(near), len(found))
