"""Exact deduplication by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes.  The distinct blocks are sorted,
and a block's rank is its integer name; then adjacent names are paired, the distinct pairs are
sorted and ranked, and so on until every document has one name.  Equal names on a level mean equal
bytes, and documents that end on different levels differ in length: the identity is free of
collisions.

Ranks are taken within buckets of the sort key (bucket number and rank make one integer), so no
sort passes through one task.  Blocks sort by (64-bit hash, bytes).  The bytes decide only where
two different blocks share a hash, so whole blocks are shuffled once, combined before the shuffle,
to find the hashes that hold more than one block; only the blocks of those are sorted by bytes.
Everything else moves integers.  A block or pair that stands in a third of all rows is one row of
the ranking, and its occurrences get the name by a join that AQE can split.  Each level is stored.

Null counts as empty; empty texts are equal.  Of equal texts the row with the most code points in
the original stays, then the smallest id (null ids last), then one of the repeated rows.  An empty
table gives no rows.  Other columns are ignored.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.llm.staging import stage


@dataclass(frozen=True)
class NamingConfig:
    block_bytes: int = 8192
    bucket_rows: int = 50_000  # names ranked in one sorted group
    hash_bits: int = 64  # fewer bits only mean more ties


def normalised(text):
    """The text without spaces, tabs, line ends and the other characters of [\\x20\\x09-\\x0D]."""
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), " \n\r\t\x0b\x0c",
                  F.coalesce(text, F.lit("")))


def blocks(docs, config, id_col, text_col):
    """A row per block: the document's row number and measures, and the block with its hash."""
    base = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("chars"),
        normalised(F.col(text_col)).cast("binary").alias("body"))
    n = F.greatest(F.ceil(F.octet_length("body") / config.block_bytes), F.lit(1)).cast("int")
    cut = base.select("*", F.sha2("body", 256).alias("text_sha256"), n.alias("n"),
                      F.explode(F.sequence(F.lit(0), n - 1)).alias("at"))
    block = F.col("body").substr(F.col("at") * config.block_bytes + 1, F.lit(config.block_bytes))
    return cut.withColumn("block", block).drop("body").withColumn(
        "hash", F.shiftright(F.xxhash64("block"), 64 - config.hash_bits))


def _ranked(distinct, keys, buckets):
    """``distinct`` rows with the integer ``name`` of their place in sorted order."""
    bucket = F.pmod(F.xxhash64(F.col(keys[0]), F.lit(len(keys))), F.lit(buckets))
    order = Window.partitionBy("bucket").orderBy(*keys)
    return distinct.withColumn("bucket", bucket).withColumn(
        "name", F.row_number().over(order).cast("long") * buckets + F.col("bucket")).drop("bucket")


def name_blocks(docs, config, buckets, id_col, text_col):
    """(hash, block, name): names of the distinct blocks; ``block`` only where hashes tie."""
    whole = blocks(docs, config, id_col, text_col).select("hash", "block")
    held = whole.distinct().groupBy("hash").agg(F.count("*").alias("blocks"))
    held = stage(held, "block-hashes")
    tied = held.filter("blocks > 1").select("hash")
    one = held.filter("blocks = 1").select("hash", F.lit(None).cast("binary").alias("block"))
    if tied.isEmpty():
        return stage(_ranked(one, ["hash", "block"], buckets), "block-names"), False
    more = whole.join(tied, "hash").distinct()
    return stage(_ranked(one.unionAll(more), ["hash", "block"], buckets), "block-names"), True


def name_pairs(named, buckets):
    """The next level: (row, n, at, name) with half as many names per row."""
    half = (named.groupBy("row", "n", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(
        F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
    half = stage(half, "pairs")
    names = _ranked(half.select("a", "b").distinct(), ["a", "b"], buckets)
    return stage(half.join(names, ["a", "b"]).select(
        "row", ((F.col("n") + 1) / 2).cast("int").alias("n"), "at", "name"), "pair-names")


def identify(docs, config=NamingConfig(), id_col="doc_id", text_col="text"):
    """(row, id, chars, text_sha256, level, name) of every row of ``docs``."""
    placed = stage(blocks(docs, config, id_col, text_col).select(
        "row", "id", "chars", "n", "at", "hash", "text_sha256"), "blocks")
    total = placed.count()
    buckets = max(1, -(-total // config.bucket_rows))
    names, tied = name_blocks(docs, config, buckets, id_col, text_col)
    plain = names.filter("block IS NULL").select("hash", "name") if tied else names.select(
        "hash", "name")
    named = placed.select("row", "n", "at", "hash").join(plain, "hash")
    if tied:
        # The bytes of a tied block are read again; its rows are known by text and place.
        ties = names.filter("block IS NOT NULL")
        exact = (blocks(docs, config, id_col, text_col)
                 .join(ties.select("hash").distinct(), "hash", "left_semi")
                 .select("text_sha256", "at", "hash", "block").distinct()
                 .join(ties, ["hash", "block"]).select("text_sha256", "at", "hash", "name"))
        named = named.unionByName(placed.join(exact, ["text_sha256", "at", "hash"]).select(
            "row", "n", "at", "hash", "name"))
    named = stage(named.drop("hash"), "level-0")
    done, level = named.filter("n = 1").select("row", F.lit(0).alias("level"), "name"), 0
    rest = named.filter("n > 1")
    while not rest.isEmpty():
        level += 1
        up = name_pairs(rest, buckets)
        done = done.unionAll(up.filter("n = 1").select("row", F.lit(level), "name"))
        rest = up.filter("n > 1")
    return placed.filter("at = 0").select("row", "id", "chars", "text_sha256").join(done, "row")


def deduplicate(docs, config=NamingConfig(), id_col="doc_id", text_col="text"):
    """(id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too."""
    known = stage(identify(docs, config, id_col, text_col), "identities")
    # Stored, so that both sides of the join are plain exchanges and a hot name can be split.
    groups = stage(known.groupBy("level", "name").agg(
        F.count("*").alias("group_size"),
        F.min(F.struct((-F.col("chars")).alias("less"), F.col("id").isNull().alias("none"), "id",
                       "row")).alias("best")), "groups")
    return known.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")


SQL = r"""
WITH normal AS (
  SELECT doc_id, length(COALESCE(text, '')) AS chars,
    regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY body) AS group_size,
  row_number() OVER (PARTITION BY body ORDER BY chars DESC, doc_id) = 1 AS kept,
  sha256(body) AS text_sha256
FROM normal
"""
