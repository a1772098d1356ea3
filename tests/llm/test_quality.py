import zlib

import numpy as np

from ledgerwatch.llm import quality as q


def test_held_out_accuracy_on_the_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    rows = [(got[r.doc_id].score, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    good, bad = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([s >= 0.3 for s in good]) > 0.97
    assert np.mean([s < 0.3 for s in bad]) > 0.8


def test_labels_of_held_out_rows_do_not_matter(docs, spark, real):
    rows = [(i, t) for i, t in real[:60]]
    labels = [(i, i % 2) for i, _ in rows]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    flipped = [(i, 1 - y if i in held else y) for i, y in labels]
    schema = "doc_id long, quality int"
    a, b = (q.classify(docs(rows, extra=True), spark.createDataFrame(x, schema)).collect()
            for x in (labels, flipped))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_dot_products_equal_a_loop_over_the_features():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=2 ** 10 + 1)
    texts = ["One two, two THREE!!", "", None, "été 12 ***", "x " * 5000]
    got = q.dot_products(texts, weights, 10, 6.0)
    for text, value in zip(texts, got):
        want = weights[-1]
        if text:
            index, x = q.shares(text, q.QualityModelConfig(bits=10))
            want += sum(weights[i] * v for i, v in zip(index, x))
        assert abs(want - value) < 1e-4


def test_edges(docs, spark):
    rows = [(1, None), (2, ""), (3, "word"), (None, "word"), (3, "word"), (4, "long " * 200_000)]
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = q.classify(docs(rows), none).collect()
    assert len(got) == 6 and {r.score for r in got} == {0.5}
    some = spark.createDataFrame([(3, 1), (3, None), (None, 1), (1, 0), (1, 0)], none.schema)
    assert len(q.classify(docs(rows, extra=True), some).collect()) == 6
    assert q.classify(docs([]), some).count() == 0
    kept = q.keep_good(docs(rows).withColumnRenamed("source", "_quality_score"), none)
    assert kept.count() == 6 and kept.columns == ["doc_id", "text", "_quality_score"]
