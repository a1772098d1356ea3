import zlib

import pytest

from ledgerwatch.llm import splitters as s


def check(rows, got, n=16):
    size = {i: len((t or "").encode()) + 1 for i, t, *_ in rows}
    total = sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    assert len(got) == len(rows)
    shards = {}
    for r in got:
        assert r.doc_id is None or r["size"] == size[r.doc_id]
        shards.setdefault(r.shard, []).append(r)
    for shard, records in shards.items():
        assert 0 <= shard < n
        assert sorted(r.slot for r in records) == list(range(len(records)))
    return {k: sum(r["size"] for r in v) for k, v in shards.items()}, total


def test_equal_bytes_and_checksums(docs, real):
    got = s.assign(docs(real, extra=True)).collect()
    held, total = check(real, got)
    largest = max(r["size"] for r in got)
    assert all(abs(b - total / 16) <= largest * 1.05 for b in held.values())
    text = dict(real)
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    assert sorted(map(tuple, s.assign(docs(real)).collect())) == sorted(map(tuple, got))


@pytest.mark.parametrize("config", [s.ShardConfig(), s.ShardConfig(range_rows=50),
                                    s.ShardConfig(shards=3, ranges_per_shard=2, samples=4)])
def test_hot_group_is_subdivided_and_small_groups_stay_whole(docs, config):
    rows = [(i, "hot text of a third of all rows") for i in range(1000)]
    rows += [(1000 + i, f"text number {i % 700} " * (1 + i % 3)) for i in range(2000)]
    got = s.assign(docs(rows), config).collect()
    held, total = check(rows, got, config.shards)
    mean = total / config.shards
    assert all(abs(b - mean) <= 0.05 * mean + 200 for b in held.values()), held
    text = dict(rows)
    places = {}
    for r in got:
        places.setdefault(text[r.doc_id], set()).add(r.shard)
    assert len(places.pop(rows[0][1])) > 1 and all(len(p) == 1 for p in places.values())


def test_nulls_ties_and_repeated_rows(docs):
    rows = [(1, None), (2, ""), (3, "x")] + [(4, "same")] * 50 + [(None, "no id"), (None, None)]
    got = s.assign(docs(rows)).collect()
    check(rows, got)
    assert {r["size"] for r in got if r.doc_id in (1, 2)} == {1}


def test_text_ids_and_empty_table(spark, docs):
    named = spark.createDataFrame([("a", "x"), ("b", "y"), (None, None)], "doc_id string, text string")
    assert s.assign(named).count() == 3
    assert s.assign(docs([])).count() == 0


def test_written_shards(docs, real, spark, tmp_path):
    s.write_shards(docs(real), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 16


def test_native_plan(docs, real):
    plan = s.assign(docs(real))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_shards_hold_the_texts_of_repeated_rows(docs, spark, tmp_path):
    rows = [(1, "a b"), (1, "a b"), (1, "other"), (None, "x"), (None, "x"), (None, None), (2, ""), (2, None)] * 5
    out = s.write_shards(docs(rows, extra=True), str(tmp_path / "out"))
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    slots = sorted((r.shard, r.slot) for r in got)
    firsts = {shard: [b for a, b in slots if a == shard] for shard, _ in slots}
    assert all(v == list(range(len(v))) for v in firsts.values())
    assert s.write_shards(docs([]), str(tmp_path / "none")).collect() == []
