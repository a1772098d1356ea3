"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-
regularised-leader updates and scored as sparse dot products.

Features of a text are shares: how often each hashed n-gram occurs, divided by the number of
n-grams of its group.  The groups are token uni- and bigrams, where a token is a run of letters or
a run of symbols, and uni- to trigrams of token shapes (case, digits, length class; a run of
symbols is its own shape), so that unseen words still carry evidence.  Each share is multiplied
with its weight and summed: a sparse dot product, done for many texts at once.

Training takes at most ``max_rows`` labelled rows, chosen by a hash of the document id, so its one
task is bounded whatever the number of labels.  The model is 2**bits floats (1 MB at 18 bits); that
fixed size is all that travels to the scoring tasks.  Scoring reads every whole text in one pass
without a shuffle.

Nulls and empty texts have no n-grams; their score is that of the bias alone.  Labels that are null
are no training rows; a document labelled twice counts twice.  Without any training row the
weights stay zero and every score is 0.5.  Ties and other columns play no part.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerwatch.llm import words


@dataclass(frozen=True)
class QualityModelConfig:
    bits: int = 18
    max_rows: int = 8000
    epochs: int = 4
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.0
    l2: float = 1e-4
    scale: float = 6.0
    threshold: float = 0.3


_KIND = np.where(words.IS_WORD, 1, 2).astype(np.uint8)
_KIND[:33] = 0
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LOWER = np.zeros(256, np.int64)
_LOWER[97:123] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
GROUPS = ((0, 1), (0, 2), (1, 1), (1, 2), (1, 3))  # (token or shape, n)


def _tokens(raws):
    """Token hashes, shape hashes, offsets per text."""
    data, begins = words.layout(raws)
    starts, ends, kinds = words.runs(data, _KIND)
    tokens = words.hash_runs(data, starts, ends)
    if not len(starts):
        return tokens, tokens, np.searchsorted(starts, begins)

    def has(table):
        total = np.concatenate([[0], np.cumsum(table[data])])
        return (total[ends] - total[starts]) > 0

    length = np.minimum((ends - starts) // 3, 5)
    shape = ((has(_UPPER) * 2 + has(_LOWER)) * 2 + has(_DIGIT)) * 8 + length
    shapes = np.where(kinds[starts] == 2, tokens, words.mix64(shape.astype(np.uint64)))
    return tokens, shapes, np.searchsorted(starts, begins)


def features(raws, bits):
    """Per group: (hashed index of each n-gram, offsets per text)."""
    tokens, shapes, offsets = _tokens(raws)
    out = []
    for number, (stream, n) in enumerate(GROUPS):
        grams, at = words.ngrams((tokens, shapes)[stream], offsets, n)
        salted = words.mix64(grams ^ words.mix64(np.uint64([number + 1])))
        out.append(((salted >> np.uint64(64 - bits)).astype(np.int64), at))
    return out


def dot_products(texts, weights, bits, scale):
    """Bias plus the weighted shares of every text; weights[-1] is the bias."""
    out = np.full(len(texts), weights[-1], dtype=np.float64)
    for first, raws in words.slices(texts):
        for index, at in features(raws, bits):
            total = np.concatenate([[0.0], np.cumsum(weights[index], dtype=np.float64)])
            count = np.diff(at)
            sums = total[at[1:]] - total[at[:-1]]
            out[first:first + len(raws)] += scale * sums / np.maximum(count, 1)
    return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def shares(text, config):
    """(indices, values) of one text for training."""
    (_, raws), = list(words.slices([text]))
    parts = []
    for index, at in features(raws, config.bits):
        found, n = np.unique(index, return_counts=True)
        parts.append((found, config.scale * n / max(len(index), 1)))
    return (np.concatenate([p[0] for p in parts]).astype(np.int32),
            np.concatenate([p[1] for p in parts]).astype(np.float32))


def train(rows, config):
    """FTRL-proximal over (indices, values, label) rows; returns the weights and the bias."""
    size = 2 ** config.bits + 1
    z, n, bias = np.zeros(size), np.zeros(size), size - 1

    def weight(at):
        zi = z[at]
        rate = (config.beta + np.sqrt(n[at])) / config.alpha + config.l2
        return np.where(np.abs(zi) <= config.l1, 0.0, (np.sign(zi) * config.l1 - zi) / rate)

    rows = [(np.append(i, bias), np.append(v, 1.0), y) for i, v, y in rows]
    for _ in range(config.epochs):
        for index, value, label in rows:
            # An index may stand in two groups; its updates add up.
            w = weight(index)
            slope = (sigmoid(np.dot(w, value)) - label) * value
            grown = n[index] + slope * slope
            sigma = (np.sqrt(grown) - np.sqrt(n[index])) / config.alpha
            np.add.at(z, index, slope - sigma * w)
            np.add.at(n, index, slope * slope)
    return weight(np.arange(size)).astype(np.float32)


def fit(docs, labels, config=QualityModelConfig(), id_col="doc_id", text_col="text",
        label_col="quality"):
    """Weights (2**bits + 1 floats, the bias last) learnt from a bounded sample of ``labels``."""
    chosen = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
              .dropna().withColumn("at", F.xxhash64(F.col("id").cast("string")))
              .orderBy("at", "id").limit(config.max_rows))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("at", "id", "text", "y")

    def prepare(batches):
        for b in batches:
            made = [shares(t, config) for t in b["text"]]
            yield pd.DataFrame({"at": b["at"], "id": b["id"].astype(str), "y": b["y"],
                                "i": [m[0].tobytes() for m in made],
                                "v": [m[1].tobytes() for m in made]})

    def learn(batches):
        data = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y)
                for b in batches for i, v, y in zip(b["i"], b["v"], b["y"])]
        yield pd.DataFrame({"w": [train(data, config).tobytes()]})

    model = (rows.mapInPandas(prepare, "at long, id string, y double, i binary, v binary")
             .repartition(1).sortWithinPartitions("at", "id", "y")
             .mapInPandas(learn, "w binary").collect())
    return np.frombuffer(model[0]["w"], np.float32) if model else np.zeros(
        2 ** config.bits + 1, np.float32)


def score(docs, weights, config=QualityModelConfig(), text_col="text", out_col="quality_score"):
    """``docs`` with the probability of label 1 in ``out_col``."""

    @F.pandas_udf("double")
    def probability(text: pd.Series) -> pd.Series:
        return pd.Series(sigmoid(dot_products(list(text), weights, config.bits, config.scale)))

    return docs.withColumn(out_col, probability(F.col(text_col)))


def held_out(id_col="doc_id"):
    """True for the rows that no training may see: crc32 of the id's text divisible by 5."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def classify(docs, labels, config=QualityModelConfig()):
    """(doc_id, held_out, score, predicted) for every document."""
    weights = fit(docs, labels.filter(~held_out()), config)
    scored = score(docs.select("doc_id", "text"), weights, config, out_col="score")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= config.threshold).cast("int").alias("predicted"))


def keep_good(docs, labels, config=QualityModelConfig()):
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    weights = fit(docs, labels.filter(~held_out()), config)
    name = "_quality_score"
    while name in docs.columns:
        name += "_"
    return score(docs, weights, config, out_col=name).filter(
        F.col(name) >= config.threshold).drop(name)
