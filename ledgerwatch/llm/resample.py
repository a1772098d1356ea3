"""Importance resampling of a corpus towards a target distribution.

Texts are bags of hashed features: all runs of 1 to ``max_words`` words, by the CRC-32 of their bytes
modulo ``buckets``.  The smoothed log ratio of a bucket's share in the target and in the corpus is its
gain; a text's weight is the mean gain of its features.  Adding Gumbel noise, seeded by the id, and
taking the highest scores draws texts without replacement in proportion to their importance.

1. Two counting passes (corpus, target): an array of counts in each task, one row per bucket and task.
   The array of gains, bounded by ``buckets``, goes to the driver and out to the tasks.
2. A scoring pass with that array writes narrow rows (id, counts, weight, score); no text is shuffled.
3. The k-th best composite key (score, id, number of features, row) is found by quickselect: a few
   rows drawn at random are pivots, one aggregate counts exactly how many keys lie below, at and above
   each, and only the interval that holds the k-th goes on, stored anew.  The intervals shrink about
   ``pivots`` times a round, so all rounds together read little more than the first.  Nothing is sorted.
4. The winners alone are range-partitioned, sorted inside each range, and ranked by the exact counts of
   the ranges before.  All other rows pass through without an exchange.

Null and empty texts have no features, weight 0, and are scored like others.  Very long texts count
whole.  Null ids draw their noise from the empty name and come last among ties.  Repeated rows are
candidates of their own; equal ones have neighbouring ranks.  An empty corpus gives no rows; an empty
target leaves the smoothed shares of the corpus to decide.  Only the id and the text are read, so other
columns cannot clash.
"""

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerwatch.llm import words
from ledgerwatch.llm.batches import map_texts
from ledgerwatch.llm.ranking import ranked
from ledgerwatch.llm.staging import stage

#: A word in UTF-8, after A-Z are lower-cased: digits, a-z and everything that is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
KEYS = ["low", "nameless", "id", "n_features", "row"]


@dataclass(frozen=True)
class ResampleConfig:
    max_words: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024
    pivots: int = 8  # expected number a round
    range_rows: int = 1_000_000  # winners sorted in one task


def hashed(raw, max_words, buckets):
    """(buckets of all features of a text, number of its words)."""
    found = _WORD.findall(raw.lower())
    part = list(map(zlib.crc32, found))
    out = part
    for n in range(1, max_words):
        # The CRC of a run and one more word goes on from that of the run.
        part = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, w in zip(part, found[n:])]
        out = out + part
    return np.array(out, np.int64) % buckets, len(found)


def counts(texts, config, text_col="text"):
    """How often each bucket occurs in all texts: an array of ``buckets`` numbers."""

    def run(batches):
        total = np.zeros(config.buckets, np.int64)
        for b in batches:
            for _, raws in words.slices(b["text"]):
                for raw in raws:
                    total += np.bincount(hashed(raw, config.max_words, config.buckets)[0],
                                         minlength=config.buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = (texts.select(F.col(text_col).alias("text")).mapInPandas(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())  # at most ``buckets`` rows
    out = [0] * config.buckets
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source, target):
    """floor(1000 ln(smoothed target share / smoothed source share)) of each bucket."""
    size = float(len(source))
    all_s, all_t = sum(source) + size, sum(target) + size
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t)))
                     for s, t in zip(source, target)], np.int64)


def score(docs, gain, config, id_col="doc_id", text_col="text"):
    """(id, n_features, n_words, weight, score) of every row."""

    def make(_, raws):
        rows = []
        for raw in raws:
            at, n = hashed(raw, config.max_words, config.buckets)
            rows.append((len(at), n, int(gain[at].sum()) // len(at) if len(at) else 0))
        return {name: pa.array(column, pa.int64()) for name, column in
                zip(("n_features", "n_words", "weight"), zip(*rows))}

    plain = map_texts(docs, make, "n_features long, n_words long, weight long", id_col, text_col)
    plain = plain.withColumnRenamed(id_col, "id")
    name = F.concat(F.lit(f"{config.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return plain.withColumn("score", F.col("weight") + noise)


def _key(values, kind):
    """A composite key as a literal."""
    types = dict(zip(KEYS, ["long", "boolean", kind, "long", "long"]))
    return F.struct(*[F.lit(values[k]).cast(types[k]).alias(k) for k in KEYS])


def kth_key(keys, k, config):
    """The k-th smallest (1-based) of the distinct composite keys of a stored table.

    Each round's pivots are rows whose seeded hash falls under a chance of pivots / rows left.  The
    interval is stored before the next round, and every pivot leaves it: a round that has drawn
    any makes it smaller.
    """
    kind, here = keys.schema["id"].dataType, F.struct(*KEYS)
    left, turn = keys.count(), 0
    while True:
        turn += 1
        chance = F.pmod(F.xxhash64("row", F.lit(config.seed), F.lit(turn)), F.lit(1 << 40))
        # A Poisson number of rows, so bounded like ``pivots``.
        drawn = keys.filter(chance * left < config.pivots * (1 << 40)).collect()
        if not drawn:
            continue
        pivots = sorted(drawn, key=lambda r: (r.low, r.nameless, r.id if r.id is not None else 0,
                                              r.n_features, r.row))
        sides = []
        for i, p in enumerate(pivots):
            at = _key(p.asDict(), kind)
            sides += [F.count(F.when(here < at, 1)).alias(f"below{i}"),
                      F.count(F.when(here == at, 1)).alias(f"at{i}")]
        n = keys.agg(*sides).first()
        low = high = None
        for i, p in enumerate(pivots):
            if n[f"below{i}"] < k <= n[f"below{i}"] + n[f"at{i}"]:
                return _key(p.asDict(), kind)
            if k <= n[f"below{i}"]:
                high = i
                break
            low = i
        upto = left if high is None else n[f"below{high}"]
        passed = 0 if low is None else n[f"below{low}"] + n[f"at{low}"]
        if high is not None:
            keys = keys.filter(here < _key(pivots[high].asDict(), kind))
        if low is not None:
            keys = keys.filter(here > _key(pivots[low].asDict(), kind))
        keys, k, left = stage(keys, "interval"), k - passed, upto - passed


def resample(docs, target, config=ResampleConfig(), id_col="doc_id", text_col="text",
             target_text_col="text"):
    """(id, n_features, weight, score, rank) of every row; rank is null for those not drawn."""
    gain = gains(counts(docs, config, text_col), counts(target, config, target_text_col))
    rows = stage(score(docs, gain, config, id_col, text_col).withColumns({
        "low": -F.col("score"), "nameless": F.col("id").isNull(),
        "row": F.monotonically_increasing_id()}), "scored")
    able = F.col("n_words") >= config.least_words
    k = rows.filter(able).count() * config.percent // 100
    shown = ["n_features", "weight", "score"]

    def out(part, rank):
        return part.select(F.col("id").alias(id_col), *shown, rank.cast("long").alias("rank"))

    if not k:
        return out(rows, F.lit(None))
    last = kth_key(rows.filter(able).select(*KEYS), k, config)
    won = able & (F.struct(*KEYS) <= last)
    return out(rows.filter(~won), F.lit(None)).unionAll(
        out(ranked(rows.filter(won), KEYS, k, config.range_rows), F.col("rank")))


#: The same in DuckDB's SQL for one-word features: CRC-32 over bytes with a table made from its rule.
SQL = r"""
WITH RECURSIVE bits(i, c, n) AS (
  SELECT range, range::BIGINT, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM bits WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE n = 8),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
items AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
uses AS (SELECT r, unnest(ws) AS w FROM docs),
wanted AS (SELECT unnest(ws) AS w FROM items),
vocabulary AS (SELECT DISTINCT w FROM (SELECT w FROM uses UNION ALL SELECT w FROM wanted)),
hexed AS (SELECT w, hex(encode(w)) AS h FROM vocabulary),
hashed AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h) // 2 + 1),
  lambda i: (instr('0123456789ABCDEF', substr(h, 2 * i - 1, 1)) - 1) * 16
  + instr('0123456789ABCDEF', substr(h, 2 * i, 1)) - 1)),
  lambda c, b: xor(t[xor(c % 256, b) + 1], c // 256)), 4294967295) % 10000 AS bucket FROM hexed, crc),
s AS (SELECT bucket, count(*) AS s FROM uses JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s,
  (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0)::DOUBLE * (all_s + 10000)
  / ((s + 1.0)::DOUBLE * (all_t + 10000))))::BIGINT AS g FROM s LEFT JOIN t USING (bucket), totals),
weights AS (SELECT r, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight
  FROM uses JOIN hashed USING (w) JOIN gain USING (bucket) GROUP BY r),
named AS (SELECT r, doc_id, len(ws) AS n, coalesce(weight, 0) AS weight,
  sha256('2024:' || coalesce(doc_id::VARCHAR, '')) AS h FROM docs LEFT JOIN weights USING (r)),
scored AS (SELECT r, doc_id, n, weight, weight + floor(-1000 * ln(-ln((list_reduce(list_prepend(0::BIGINT,
  list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', substr(h, i, 1)) - 1)::BIGINT)),
  lambda a, d: a * 16 + d) + 0.5)::DOUBLE / 4294967296)))::BIGINT AS score FROM named),
places AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n, r) AS place
  FROM scored WHERE n >= 20)
SELECT doc_id, n::BIGINT AS n_features, weight, score,
  CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM places) THEN place END AS rank
FROM scored LEFT JOIN places USING (r)
"""
