import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import resample
from ledgerwatch.llm.resample import ResampleConfig


def plain(rows, target, config):
    """The result by the definition, in plain Python; rows are (id, text)."""
    def features(text):
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(w[i:i + n]) for n in range(1, config.max_words + 1)
                for i in range(len(w) - n + 1)]
        return [zlib.crc32(f.encode()) % config.buckets for f in runs], len(w)

    s, t = [0] * config.buckets, [0] * config.buckets
    for texts, total in ((rows, s), (target, t)):
        for _, text in texts:
            for b in features(text)[0]:
                total[b] += 1
    big_s, big_t, m = sum(s), sum(t), config.buckets
    out = []
    for doc_id, text in rows:
        f, n = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + m) / ((s[b] + 1) * (big_t + m)))) for b in f]
        weight = math.floor(sum(gain) / len(gain)) if gain else 0
        name = f"{config.seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(f), weight, score, None, n >= config.least_words])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(able[:len(able) * config.percent // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:5]) for r in out], key=str)


def result(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def made(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(["Aa", "b1", "c", "é", "DD", "x-y"], k=rng.randint(0, 50))))
            for i in range(n)]


@pytest.mark.parametrize("config", [
    ResampleConfig(), ResampleConfig(max_words=3, buckets=97, seed=5, percent=37, pivots=2)])
def test_equals_plain_python(docs, config):
    rows, target = made(300), made(20, 9)
    got = resample.resample(docs(rows), docs(target), config)
    assert result(got) == plain(rows, target, config)


def test_nulls_ties_repeats_and_clashing_names(docs):
    text = "w " * 25
    rows = [(1, None), (2, ""), (None, text), (None, text), (7, text), (7, text), (7, text + "w"),
            (2**60 + 1, text), (9, "z " * 200_000)]
    config = ResampleConfig(percent=60)
    got = resample.resample(docs(rows, extra=True), docs([(1, "w w")]), config)
    assert result(got) == plain(rows, [(1, "w w")], config)


def test_empty_tables(docs):
    none, some = docs([(1, "x")]).limit(0), docs(made(40))
    assert resample.resample(none, some).collect() == []
    assert result(resample.resample(some, none)) == plain(made(40), [], ResampleConfig())


@pytest.mark.parametrize("pivots, places", [(1, [70]), (8, [1, 99, 200])])
def test_kth_keys(spark, pivots, places):
    rows = spark.range(200).select(
        (F.col("id") % 7).alias("low"), F.lit(False).alias("nameless"), (F.col("id") % 5).alias("id"),
        (F.col("id") % 3).alias("n_features"), F.col("id").alias("row")).cache()
    for k in places:
        last = resample.kth_key(rows, k, ResampleConfig(pivots=pivots))
        assert rows.filter(F.struct(*resample.KEYS) <= last).count() == k
