"""One query per operator, over whole tables, and the SQL twins where SQL can say the same."""

import zlib

from pyspark.sql import functions as F

from ledgerwatch.llm import (
    blocknames, bytebpe, decontam, deobfuscate, mixing, periodic, probminhash, quality, redirects,
    resample, splitters, tokencount, warc,
)
from ledgerwatch.llm.staging import table
from ledgerwatch.session import fresh_dir

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"

QUERIES = {}
SQL = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(warc.SQL)
def op1_warc(spark, d):
    path = fresh_dir(spark, "llm-archives")
    warc.write_archives(table(spark, d, "pages"), path)
    return warc.catalogue(warc.read_archives(spark, path))


@query()
def op2_probminhash(spark, d):
    return probminhash.classes(table(spark, d, "documents"))


@query()
def op3_token_counts(spark, d):
    """Starts from an empty cache, so that every distinct content is encoded."""
    import public_tokenizers

    return tokencount.count_tokens(
        table(spark, d, "documents"), public_tokenizers.path(TOKENIZER),
        fresh_dir(spark, "llm-token-cache"))


@query(mixing.SQL)
def op4_mixing(spark, d):
    return mixing.allocate(table(spark, d, "documents")).drop("copies")


@query(blocknames.SQL)
def op5_block_names(spark, d):
    return blocknames.deduplicate(table(spark, d, "documents"))


@query()
def op6_decontamination(spark, d):
    return decontam.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


@query(redirects.SQL)
def op7_redirects(spark, d):
    return redirects.judge(table(spark, d, "pages"), RULES)


@query()
def op8_splitters(spark, d):
    return splitters.assign(table(spark, d, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query()
def op9_quality(spark, d):
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query()
def op10_deobfuscation(spark, d):
    found = deobfuscate.detect(table(spark, d, "documents"))

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [of(kind).alias(f"n_{kind}") for kind in deobfuscate.KINDS]
    base = F.filter("spans", lambda s: s["plain"])
    return found.select(
        "doc_id", *counts, F.sha2(deobfuscate.as_text(base), 256).alias("base_sha256"),
        deobfuscate.as_text(F.col("spans")).alias("spans"))


def periodic_tail(doc_id, found):
    """One text in ten, by its id, gets a periodic tail; a null id has none."""
    if doc_id is None or not found:
        return found
    h, n = zlib.crc32(str(doc_id).encode()), len(found)
    g = h // 10
    if h % 10:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + i % p] for i in range(n - a)]


@query()
def op11_recompression(spark, d):
    found = periodic.detect(table(spark, d, "documents"), rewrite=periodic_tail)
    best = periodic.longest(F.col("runs"))
    length = -best["n"]
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        length.alias("length"), best["period"].alias("period"),
        F.floor(length * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query()
def op12_byte_bpe(spark, d):
    """Every text to ids and back."""
    import public_tokenizers

    vocabulary = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    ids = bytebpe.encode(table(spark, d, "documents"), *vocabulary)
    return bytebpe.decode(ids, *vocabulary).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query(resample.SQL)
def op13_resampling(spark, d):
    return resample.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))
