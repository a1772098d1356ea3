"""Token counts through a digest cache.

A count depends on the text and on the tokenizer, so the cache is keyed by both digests: SHA-256 of
the content (UTF-8, null as empty; nothing else is normalised, because it would change counts) and
SHA-256 of the tokenizer's file, library version and options.  Documents are joined to the stored
counts by digest; only distinct contents without a stored count are encoded, and their counts are
appended to the cache.

The first pass stores id, digest and size.  If the missing digests are few enough for a broadcast of
proven size, texts are filtered by it in place; otherwise contents are combined before the one
shuffle of texts.  Copies of one content, however many, are a row per map task.  The cache has one
partition folder per tokenizer; a repeated append of the same digest does no harm.

Null and empty texts have 0 tokens.  Repeated rows and null ids each give their row.  An empty table
gives no rows and leaves the cache as it is.  Other columns are ignored.
"""

import hashlib
import json
import os
import re

import pandas as pd
from pyspark.sql import functions as F

from ledgerwatch.llm import words
from ledgerwatch.llm.staging import stage

CACHE = "digest binary, n_tokens long, tokenizer string"
_SPACE = re.compile(r" (?=\S)")


def read_tokenizer(path):
    """(file text, version digest) of a tokenizer file; the driver reads it, tasks get the text."""
    import tokenizers

    with open(path, encoding="utf-8") as f:
        text = f.read()
    options = f"tokenizers {tokenizers.__version__}; no special tokens, truncation or padding"
    return text, hashlib.sha256(f"{options}\n{text}".encode()).hexdigest()


class TokenCounter:
    """Counts as the library gives them, with a memo of pieces.

    A byte-level BPE splits texts by a fixed pattern in which a space before a non-space always
    begins a new piece, so counts add up over the pieces between such spaces; each distinct piece of
    a slice is encoded once.  Any other kind of tokenizer encodes whole texts.
    """

    def __init__(self, text, memo_pieces=400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(text)
        before = spec.get("pre_tokenizer") or {}
        plain = [not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"]
                 and not t["single_word"] for t in spec.get("added_tokens") or []]
        self.additive = (before.get("type") == "ByteLevel" and before.get("use_regex", True)
                         and not before.get("add_prefix_space") and not spec.get("normalizer")
                         and all(plain))
        self.memo, self.memo_pieces = {}, memo_pieces

    def _encode(self, texts):
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts):
        if not self.additive:
            return self._encode(texts)
        out = []
        for _, raws in words.slices(texts):
            split = [_SPACE.split(r.decode("utf-8")) for r in raws]
            fresh = list(set().union(*(s[1:] for s in split)) - self.memo.keys())
            self.memo.update(zip(fresh, self._encode([" " + p for p in fresh])))
            heads = self._encode([s[0] for s in split])
            out += [h + sum(map(self.memo.__getitem__, s[1:])) for h, s in zip(heads, split)]
            if len(self.memo) > self.memo_pieces:
                self.memo = {}
        return out


def _digest(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def read_cache(spark, path, version):
    """(digest, n_tokens) stored for one tokenizer version; empty where there is no cache yet."""
    from pyspark.errors import AnalysisException

    try:
        stored = spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], CACHE)
    return stored.filter(F.col("tokenizer") == version).groupBy("digest").agg(
        F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs, narrow, cache_path, tokenizer_text, version, text_col, broadcast_rows):
    """Encode the contents of ``docs`` that the cache lacks and append them; returns their number."""
    spark = docs.sparkSession
    missing = stage(narrow.select("digest").distinct().join(
        read_cache(spark, cache_path, version), "digest", "left_anti"), "missing")
    count = missing.count()
    if not count:
        return 0
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(_digest(text).alias("digest"), text.alias("text"))
    if count <= broadcast_rows:  # 32 bytes a row
        chosen = texts.join(F.broadcast(missing), "digest", "left_semi").dropDuplicates(["digest"])
    else:
        chosen = texts.dropDuplicates(["digest"]).join(missing, "digest", "left_semi")

    def encode(batches):
        counter = TokenCounter(tokenizer_text)
        for b in batches:
            yield pd.DataFrame({"digest": b["digest"], "n_tokens": counter.count(list(b["text"]))})

    (chosen.mapInPandas(encode, "digest binary, n_tokens long")
     .withColumn("tokenizer", F.lit(version))
     .write.mode("append").partitionBy("tokenizer").parquet(cache_path))
    return count


def count_tokens(docs, tokenizer_path, cache_path, limit=512, id_col="doc_id", text_col="text",
                 broadcast_rows=100_000):
    """(id, n_bytes, n_tokens, over_limit) of every row; ``cache_path`` is read and extended."""
    tokenizer_text, version = read_tokenizer(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = stage(docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
        _digest(text).alias("digest")), "digests")
    fill_cache(docs, narrow, cache_path, tokenizer_text, version, text_col, broadcast_rows)
    # Stored, so that both sides of the join are plain exchanges and a hot digest can be split.
    stored = stage(read_cache(docs.sparkSession, cache_path, version), "counts")
    return narrow.join(stored, "digest").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
