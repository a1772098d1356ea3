"""Benchmark decontamination: BM25 over test items with block-max bounds, then verified overlap.

The test items are the indexed documents, every passage of every training text is a query.  A
passage is a window of twice the longest item's (or piece's) words, advancing by half, so each possible copy of
an item lies in one passage whole.  Scores are divided by the item's score against itself; a
passage retrieves all items of at least ``score``.

Retrieval is exact and skips as block-max WAND does.  Items are sorted and cut into blocks; each
term knows its largest contribution per block.  Per item, the most frequent terms are left out of
the pivot lists as long as together they stay below ``lazy`` of the threshold: without any pivot
term an item cannot reach it.  A passage adds up the block maxima of its pivot terms, skips the
blocks that cannot reach the threshold with all their other terms, does the same per item, and only
the remaining items are scored in full.

A retrieved item counts as contamination when at least ``overlap`` of its five-word shingles stand
in the passage, and both its question and its answer are covered by the passage's trigrams to
``part``.  The question is the text up to the last question mark, or all but the last sentence; the
answer is the rest, or the whole text where there is only one sentence.

The corpus is read once and never shuffled.  The index is built by aggregates and sent to the tasks
in hashed slices of about ``slice_items`` items of at most ``item_words`` words, whatever their
number.  More items mean more slices, each a further pass.  Longer items are cut into even pieces of
at most that length, all in one slice.  A piece only retrieves: shingles, question and answer are
those of the whole item, looked for from one item's length before the first retrieved passage to one
after the last, and the score is the mean of the pieces' scores.

Null or empty items are dropped, null or empty texts match nothing.  Repeated items are found under
each id, items of fewer than five words as one shingle of all their words, repeated rows of a document each give their matches.  Other columns are ignored.
"""

import re
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerwatch.llm import words
from ledgerwatch.llm.staging import stage


@dataclass(frozen=True)
class DecontamConfig:
    k1: float = 1.2
    b: float = 0.75
    score: float = 0.5
    lazy: float = 0.7
    block_items: int = 8
    shingle_words: int = 5
    overlap: float = 0.8
    part: float = 0.5
    slice_items: int = 5_000
    item_words: int = 512


def _hashes(text):
    (_, raws), = list(words.slices([text.lower()]))
    return words.word_hashes(raws)[0]


def _parts(text):
    """(question, answer); both the whole text where it has only one sentence."""
    at = text.rfind("?") + 1
    if not at or not text[at:].strip():
        ends = [m.end() for m in re.finditer(r"[.!?]+\s+", text.strip())]
        at = ends[-1] if ends else 0
    return (text[:at], text[at:]) if text[:at].strip() else (text, text)


def _grams(hashes, n):
    return words.ngrams(hashes, np.array([0, len(hashes)]), n)[0]


def pieces(items, config, id_col, text_col):
    """(item, version, piece, text, terms): word hashes in even pieces of at most ``item_words``.

    ``version`` tells the texts of one id apart; only the first piece carries the text.
    """
    kind = items.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            out = []
            for item, version, text in zip(b["item"], b["version"], b["text"]):
                terms = _hashes(text).view(np.int64)
                if len(terms):
                    out += [(item, version, k, None if k else text, part) for k, part in enumerate(
                        np.array_split(terms, ceil(len(terms) / config.item_words)))]
            yield pd.DataFrame(out, columns=["item", "version", "piece", "text", "terms"])

    plain = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).dropna()
    return plain.withColumn("version", F.xxhash64("text")).mapInPandas(
        run, f"item {kind}, version long, piece int, text string, terms array<long>")


def build(items, config=DecontamConfig(), id_col="item_id", text_col="text"):
    """Index slices: lists of (item, text, distinct terms, weights), weights summing to 1."""
    key = ["item", "version", "piece"]  # an id may come with several texts
    table = stage(pieces(items, config, id_col, text_col).distinct(), "items")
    count, mean = table.agg(F.count("*"), F.avg(F.size("terms"))).first()
    if not count:
        return []
    one = table.select(*key, F.size("terms").alias("n"), F.explode("terms").alias("term"))
    tf = one.groupBy(*key, "n", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log1p((count - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = config.k1 * (1 - config.b + config.b * F.col("n") / mean)
    scored = stage(tf.join(df, "term").select(
        *key, F.struct(
            (-F.col("df")).alias("rarity"), "term",
            (idf * F.col("tf") * (config.k1 + 1) / (F.col("tf") + norm)).alias("w")).alias("p"))
        .groupBy(*key).agg(F.sort_array(F.collect_list("p")).alias("p"))
        .join(table.select(*key, "text"), key), "index")
    slices = ceil(count / config.slice_items)
    part = F.pmod(F.xxhash64("item", "version"), F.lit(slices))  # all pieces in one slice
    for number in range(slices):
        rows = scored.filter(part == number).orderBy(*key).select(
            "item", "text", F.transform("p", lambda p: p["term"]),
            F.transform("p", lambda p: p["w"])).collect()
        if rows:
            yield Index(rows, config)


class Index:
    """Pivot lists with block maxima, and the full terms of every item."""

    def __init__(self, rows, config):
        self.config, self.items = config, [r[0] for r in rows]
        self.terms, self.weights, self.parts = [], [], []
        pivot, self.others = [], np.zeros(len(rows))
        # A row with a text begins an item; the rows up to the next one are its pieces.
        begins = [i for i, r in enumerate(rows) if r[1] is not None]
        upto = [*begins[1:], len(rows)]
        self.pieces = [p for p in map(range, begins, upto) for _ in p]
        self.longest = 1
        for i, (_, text, terms, w) in enumerate(rows):
            w = np.array(w) / np.sum(w)
            # Most frequent terms first (they come sorted); the first ones stay out of the pivots.
            lazy = np.cumsum(w) <= config.lazy * config.score
            self.others[i] = w[lazy].sum()
            terms = np.array(terms, np.int64)
            pivot += [(t, i, x) for t, x in zip(terms[~lazy], w[~lazy])]
            order = np.argsort(terms.view(np.uint64))
            self.terms.append(terms.view(np.uint64)[order])
            self.weights.append(w[order])
            self.parts.append(None)
            if text is None:
                continue
            whole = _hashes(text)
            question, answer = (_hashes(p) for p in _parts(text))
            n = min(config.shingle_words, len(whole))  # a short item is one shingle of its words
            self.parts[i] = (np.unique(_grams(whole, n)), question if len(question) else whole,
                             answer if len(answer) else whole, n, len(whole))
            longest = len(self.parts[i][1]) + len(self.parts[i][2])
            if len(self.pieces[i]) > 1:
                longest = config.item_words
            self.longest = max(self.longest, longest)
        term = np.array([p[0] for p in pivot], np.int64).view(np.uint64)
        item = np.array([p[1] for p in pivot], np.int64)
        weight = np.array([p[2] for p in pivot])
        order = np.lexsort((item, term))
        term, self.item, self.weight = term[order], item[order], weight[order]
        self.vocabulary, first = np.unique(term, return_index=True)
        self.at = np.append(first, len(term))
        block = self.item // config.block_items
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        start = np.flatnonzero(new)
        self.block, self.block_max = block[start], np.maximum.reduceat(self.weight, start)
        self.block_at = np.searchsorted(start, self.at)
        self.need = config.score - self.others - 1e-9
        blocks = int(block.max()) + 1
        self.block_need = np.full(blocks, np.inf)
        np.minimum.at(self.block_need, np.arange(len(rows)) // config.block_items, self.need)

    def _sums(self, passage, term, at, target, value, targets, need):
        """(passage, target) whose summed values reach the target's need."""
        n = at[term + 1] - at[term]
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin - at[term], n)
        key = np.repeat(passage, n) * targets + target[place]
        keys, inverse = np.unique(key, return_inverse=True)
        total = np.bincount(inverse, weights=value[place], minlength=len(keys))
        keys = keys[total >= need[keys % targets]]
        return keys // targets, keys % targets

    def candidates(self, hashes, word_at):
        """(text, first word, one past the last, item) of passages that may reach the threshold."""
        window = 2 * max(self.longest, 16)
        step = window // 2
        known = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[known] == hashes)
        text = np.searchsorted(word_at, hit, side="right") - 1
        local = (hit - word_at[text]) // step
        wide = max(int(local.max()) + 2, 2) if len(local) else 2
        # A word stands in the window that begins at its step and in the one before.
        passage = np.concatenate([text * wide + local, text * wide + local - 1])
        term = np.concatenate([known[hit], known[hit]])
        inside = np.concatenate([np.ones(len(hit), bool), local > 0])
        pair = np.unique(passage[inside] * len(self.vocabulary) + term[inside])
        passage, term = pair // len(self.vocabulary), pair % len(self.vocabulary)
        p, blocks = self._sums(passage, term, self.block_at, self.block, self.block_max,
                               len(self.block_need), self.block_need)
        if not len(p):
            return
        # Only the surviving blocks of the surviving passages are opened.
        stay = np.isin(passage, p)
        alive = set(zip(p.tolist(), blocks.tolist()))
        p, items = self._sums(passage[stay], term[stay], self.at, self.item, self.weight,
                              len(self.items), self.need)
        for one, item in zip(p.tolist(), items.tolist()):
            if (one, item // self.config.block_items) in alive:
                t = one // wide
                first = word_at[t] + (one % wide) * step
                yield t, first, min(first + window, word_at[t + 1]), item

    def score(self, passage, item):
        """Normalised BM25 of a passage's distinct terms."""
        return float(self.weights[item][np.isin(self.terms[item], passage)].sum())

    def overlaps(self, passage, item):
        shingles, question, answer, n, _ = self.parts[item]
        own = np.isin(shingles, _grams(passage, n)).mean()

        def covered(part):
            n = min(3, len(part))
            there = np.isin(_grams(part, n), _grams(passage, n))
            mark = np.zeros(len(part) + 1, np.int64)
            for i in np.flatnonzero(there):
                mark[i] += 1
                mark[i + n] -= 1
            return (np.cumsum(mark)[:len(part)] > 0).mean()

        return float(own), float(covered(question)), float(covered(answer))

    def find(self, texts):
        """{(text number, item number): (score, overlap, question, answer)}, contaminated only."""
        found, c = {}, self.config
        for start, raws in words.slices([t.lower() if isinstance(t, str) else None for t in texts]):
            hashes, word_at = words.word_hashes(raws)
            if not len(hashes) or not len(self.vocabulary):
                continue
            long = {}  # (text, first piece): first word and one past the last of its passages
            for t, first, last, item in self.candidates(hashes, word_at):
                passage = hashes[first:last]
                score = self.score(passage, item)
                if score < c.score:
                    continue
                if len(self.pieces[item]) > 1:
                    key = (t, self.pieces[item][0])
                    low, high = long.get(key, (first, last))
                    long[key] = min(low, first), max(high, last)
                    continue
                own, question, answer = self.overlaps(passage, item)
                if own >= c.overlap and question >= c.part and answer >= c.part:
                    key = (start + t, item)
                    found[key] = max(found.get(key, (0.0,)), (score, own, question, answer))
            # The whole of a long item is looked for around the passages that hold pieces of it.
            for (t, item), (first, last) in long.items():
                size = self.parts[item][4]
                passage = hashes[max(first - size, word_at[t]):min(last + size, word_at[t + 1])]
                own, question, answer = self.overlaps(passage, item)
                if own >= c.overlap and question >= c.part and answer >= c.part:
                    score = float(np.mean([self.score(passage, p) for p in self.pieces[item]]))
                    found[start + t, item] = score, own, question, answer
        return found


def matches(docs, items, config=DecontamConfig(), id_col="doc_id", text_col="text",
            item_col="item_id", item_text="text"):
    """(doc, item, score, overlap, question_overlap, answer_overlap) of every contaminated pair."""
    plain = docs.select(F.col(id_col).alias("d"), F.col(text_col).alias("text"))
    schema = (f"{id_col} {plain.schema['d'].dataType.simpleString()}, "
              f"{item_col} {items.schema[item_col].dataType.simpleString()}, score double, "
              "overlap double, question_overlap double, answer_overlap double")
    names = [f.split()[0] for f in schema.split(", ")]

    def search(index):
        def run(batches):
            for b in batches:
                found = index.find(list(b["text"]))
                yield pd.DataFrame([(b["d"].iloc[t], index.items[i], *v)
                                    for (t, i), v in found.items()], columns=names)

        return plain.mapInPandas(run, schema)

    out = None
    for index in build(items, config, item_col, item_text):
        out = search(index) if out is None else out.unionAll(search(index))
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    # An id with several texts is one item.
    return out.groupBy(id_col, item_col).agg(*[F.max(n).alias(n) for n in names[2:]])


def remove(docs, items, config=DecontamConfig(), text_col="text", item_col="item_id",
           item_text="text"):
    """The rows of ``docs`` that contain no test item, unchanged; nothing is shuffled."""

    def clean_of(index):
        @F.pandas_udf("boolean")
        def clean(text: pd.Series) -> pd.Series:
            hit = {t for t, _ in index.find(list(text))}
            return pd.Series([i not in hit for i in range(len(text))])

        return clean

    for index in build(items, config, item_col, item_text):
        docs = docs.filter(clean_of(index)(F.col(text_col)))
    return docs
