import re

import pytest

from ledgerwatch.llm import mixing as m


def fill(sizes, weights, total, cap):
    """Water-filling by the definition: share, clamp, share the rest again."""
    done = {}
    while True:
        free = [s for s in sizes if s not in done]
        rest = total - sum(done.values())
        weight = sum(weights[s] for s in free)
        shares = {s: rest * weights[s] / weight for s in free} if weight else {}
        over = {s: cap * sizes[s] for s in free if shares.get(s, 0) > cap * sizes[s]}
        if not over:
            return done | shares
        done |= over


ROWS = [(i, "word " * (1 + i * 37 % 50), "abcdefg"[i % 7] if i % 3 else "a") for i in range(300)] + [
    (1000, None, "b"), (1001, "", "c"), (1002, "x\ty\x0bz w", None), (1002, "x\ty\x0bz w", None),
    (None, "no id", "d"), (1003, "   ", "empty")]


def test_targets_and_counts(docs):
    got = m.allocate(docs(ROWS, extra=True)).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, size(t)) for i, t, _ in ROWS)
    sizes = {}
    for _, text, source in ROWS:
        sizes[source] = sizes.get(source, 0) + size(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = fill(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2)
    by_id = {i: s for i, _, s in ROWS}
    taken = {}
    for r in got:
        source = by_id[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] = taken.get(source, 0) + r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - want[s]) <= largest for s in sizes)


def test_mix_repeats_rows_with_their_columns(docs):
    source = docs(ROWS, extra=True)
    copies = {r.doc_id: r.copies for r in m.allocate(source).collect()}
    mixed = m.mix(source)
    assert mixed.columns == source.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    repeated = {1002: 2}
    assert all(counts.get(i, 0) == n * repeated.get(i, 1) for i, n in copies.items())
    assert sorted(map(str, m.mix(source).collect())) == sorted(map(str, mixed.collect()))


def test_given_weights_and_infeasible_total(docs, spark):
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "source string, weight double")
    rows = [(1, "x x", "a"), (2, "y", "b"), (3, "z", "c")]
    got = {r.doc_id: r for r in m.allocate(docs(rows), weights=weights).collect()}
    assert got[1].taken == 4 and got[2].taken == got[3].taken == 0  # 4 of 6: the cap is reached
    everything = m.MixConfig(share=10.0)
    assert {r.taken - 2 * r.size for r in m.allocate(docs(rows), everything).collect()} == {0}


def test_empty_tables(docs):
    assert m.allocate(docs([])).count() == 0 and m.mix(docs([])).count() == 0
    assert m.allocate(docs([(1, None, "a")])).first().taken == 0


@pytest.mark.parametrize("share, name", [
    (0.6, lambda i: None if i % 2 else i), (0.9, lambda i: None if i % 2 else i), (0.3, lambda i: i // 50)])
def test_null_and_repeated_ids_meet_the_target(docs, share, name):
    rows = [(name(i), f"{'w ' * (1 + i * 7 % 13)}x{i if i % 3 else 0}", "abc"[i % 3]) for i in range(600)]
    got = m.allocate(docs(rows), m.MixConfig(share=share)).collect()
    taken, want = {}, {}
    for r in got:  # one source each has its own size and target
        taken[r.source_size, r.target] = taken.get((r.source_size, r.target), 0) + r.taken
        want[r.source_size, r.target] = r.target
    assert len(want) == 3 and all(abs(taken[s] - want[s]) <= 14 / 2 for s in want)
    mixed = m.mix(docs(rows), m.MixConfig(share=share))
    assert mixed.count() == sum(r.copies for r in got)


def test_equal_rows_are_split_by_number(docs):
    rows = [(None, "a b c", "s")] * 1000 + [(5, "d e", "s")] * 500 + [(6, "", "s")] * 3
    for share in (0.25, 1.25):
        got = m.allocate(docs(rows), m.MixConfig(share=share)).collect()
        assert abs(sum(r.taken for r in got) - share * 4000) <= 1.5
        assert m.mix(docs(rows), m.MixConfig(share=share)).count() == sum(r.copies for r in got)


def test_sources_are_dealt_in_code_point_order(docs):
    rows = [(i, "w", s) for i, s in enumerate(["é", None, "Z", "a", "", "b"])]
    got = {r.source: r.weight for r in m.cyclic_weights(
        docs(rows).select("source").distinct(), (3, 1, 2)).collect()}
    assert got == {"": 3, "Z": 1, "a": 2, "b": 3, "é": 1, None: 2}
