import hashlib
import zlib
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from test_decontam import words
from test_mixing import fill
from test_probminhash import shingles, similarity, union

from ledgerwatch.llm import quality
from ledgerwatch.llm.staging import stage


@pytest.fixture(scope="module")
def outputs(spark, sf):
    """Rows of documents and of every stage's output."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, apply in corpus_pipeline.STAGES:
        out.append(stage(apply(spark, out[-1], sf), f"test-{name}"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "decontamination", "mixing", "sharding"]
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])


def test_quality_stage(outputs, spark, sf):
    before, after = texts(outputs[0]), texts(outputs[1])
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter(~quality.held_out())
    config = quality.QualityModelConfig()
    weights = quality.fit(outputs[0], labels, config)
    want = set()
    for i, text in before.items():
        index, value = quality.shares(text, config) if text else (np.zeros(0, int), np.zeros(0))
        z = weights[-1] + sum(float(weights[k]) * float(v) for k, v in zip(index, value))
        if 1 / (1 + np.exp(-z)) >= config.threshold:
            want.add(i)
    assert set(after) == want and 0 < len(want) < len(before)


def test_near_dedup_stage(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    bags = {i: shingles(t) for i, t in before.items()}
    holders = {}
    for i, bag in bags.items():
        for s in bag:
            holders.setdefault(s, []).append(i)
    pairs = {p for ids in holders.values() for p in combinations(sorted(ids), 2)}
    links = [(a, b) for a, b in pairs
             if min(len(bags[a]), len(bags[b])) >= 0.5 * max(len(bags[a]), len(bags[b]))
             and (bags[a] == bags[b] or similarity(bags[a], bags[b]) >= 0.8)]
    assert set(after) == set(union(links, list(before)).values())


def test_decontamination_stage(outputs, spark, sf):
    before, after = texts(outputs[2]), texts(outputs[3])
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {i for i, t in before.items() if not any(f" {x} " in f" {' '.join(words(t))} " for x in items)}
    assert set(after) == want


def test_mixing_stage(outputs):
    rows, mixed = outputs[3].collect(), Counter(r.doc_id for r in outputs[4].collect())
    size = {r.doc_id: len(r.text.split()) for r in rows}
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r.doc_id)
    sizes = {s: sum(size[i] for i in ids) for s, ids in by_source.items()}
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    targets = fill(sizes, weights, 1.5 * sum(sizes.values()), 2)
    for source, ids in by_source.items():
        whole = int(targets[source] // sizes[source])
        missing, upto = targets[source] - whole * sizes[source], 0
        for i in sorted(ids, key=lambda i: hashlib.md5(f"{i}:20240101".encode()).hexdigest()):
            upto += size[i]
            assert mixed.get(i, 0) == whole + (2 * upto - size[i] <= 2 * missing), source


def test_sharding_stage(outputs):
    rows, got = outputs[4].collect(), outputs[5].collect()
    records = sorted((zlib.crc32(r.text.encode()), r.doc_id, len(r.text.encode()) + 1) for r in rows)
    total, start = sum(r[2] for r in records), 0
    groups = Counter()
    for crc, _, n in records:
        groups[crc] += n
    first, slots, want = {}, Counter(), Counter()
    for crc, i, n in records:
        first.setdefault(crc, start)
        at = first[crc] if groups[crc] <= 0.02 * total / 16 else start
        shard = min(15, at * 16 // total)
        want[i, n, crc, shard, slots[shard]] += 1
        slots[shard] += 1
        start += n
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in got) == want


def test_run_is_the_stages(outputs, spark, sf):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(
        map(tuple, outputs[-1].collect()))


def test_stages_on_odd_documents(spark, sf):
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = [(1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "a", 0),
            (None, "text", None, "b", 4), (3, "w " * 100_000, "en", "a", None), (4, "same", "en", "c", 4),
            (5, "same", "en", "c", 4)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, apply in corpus_pipeline.STAGES:
            docs = stage(apply(spark, docs, sf), f"odd-{name}")
        assert docs.count() >= 0
