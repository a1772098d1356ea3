"""Mixing sources to target weights by capped water-filling.

The words of the mix are shared by weight; a source that would be read more than ``max_epochs``
times is clamped there and what it leaves is shared again among the others by weight, until no
share is above its cap.  The level is found by a few combined aggregates over the table of
sources; the documents are not read for it again.

A source whose target is r times its size gives every document floor(r) whole times, and one more
time to a seeded fraction: documents in the order of their place, up to the one at which the running
size is nearest to what is still missing.  A place is the md5 of id and seed, then a hash of the text.
Nothing is sorted: the sizes are summed by a few digits of the place, the bucket in which that point
lies is summed by more digits, and so on, until one place is left.  Rows of that place (equal id and
text) are counted, and as many of them are taken as fit.  So a source, or an id, with any share of the
rows never meets in one task, and a source's taken words miss the target by at most half a document.

Null texts have no words, and a null source is a source of its own.  Very long texts count whole.
Rows of null or repeated ids are told apart by their texts; of equal rows any may be the ones taken.
Sources without words get target 0.  An empty table gives no rows.  Columns beside id, text and
source are ignored.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.ranking import numbered, ranked
from ledgerwatch.llm.staging import stage


@dataclass(frozen=True)
class MixConfig:
    weights: tuple = (3, 1, 2)
    share: float = 1.5
    max_epochs: int = 2
    seed: int = 20240101
    digits: int = 3  # of a place, looked at together: 16 ** 3 sums a source and step


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _key(source):
    """A source's name that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))


PLACE_DIGITS = 32 + 16 + 12


def _place(id_col, text_col, seed):
    """Where a row stands in the order: digits of the md5 of its id, then of its text."""
    name = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.concat(F.md5(name.cast("binary")), F.lpad(F.lower(F.hex(F.xxhash64(text))), 16, "0"),
                    F.lpad(F.lower(F.hex(F.octet_length(text))), 12, "0"))


def cyclic_weights(sources, weights):
    """Weights dealt in turn to the sources in code-point order, null last."""
    sources = stage(sources.withColumn("nameless", F.col("source").isNull()), "mix-named")
    turn = ((F.col("rank") - 1) % len(weights) + 1).cast("int")
    return ranked(sources, ["nameless", "source"], sources.count()).select(
        *[c for c in sources.columns if c != "nameless"],
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"))


def water_fill(sources, total, max_epochs):
    """``sources`` (source_size, weight) with their ``target``: min(cap, level * weight)."""
    cap = F.col("source_size") * F.lit(max_epochs)
    level = None
    while True:
        above = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap
        full, free = sources.agg(
            F.sum(F.when(above, cap).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        if not free:  # every source that has a weight is clamped
            return sources.withColumn("target", F.when(
                F.col("weight") > 0, cap.cast("double")).otherwise(0.0))
        before, level = level, (total - full) / free
        if level == before:
            break
    reach = F.lit(level) * F.col("weight")
    return sources.withColumn("target", F.when(reach > cap, cap.cast("double")).otherwise(reach))


def plan(docs, config=MixConfig(), weights=None, id_col="doc_id", text_col="text",
         source_col="source"):
    """(sizes, sources): the narrow table of documents and one row per source with its cut.

    ``weights`` (source, weight) replaces the dealt ones; a source it lacks weighs 0.
    """
    sizes = stage(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), _key(source_col).alias("skey"),
        word_count(F.col(text_col)).alias("size"), _place(id_col, text_col, config.seed).alias("place"),
    ), "mix-sizes")
    sources = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sources = cyclic_weights(sources, config.weights)
    else:
        given = weights.select(_key("source").alias("skey"), F.col("weight").cast("double"))
        sources = sources.join(given, "skey", "left").fillna(0.0, ["weight"])
    sources = stage(sources, "mix-sources")
    total = config.share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    filled = water_fill(sources, total, config.max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    filled = filled.withColumn("whole", F.coalesce(whole, F.lit(0))).withColumn(
        "quota", F.col("target") - F.col("whole") * F.col("source_size"))

    return sizes, stage(_cuts(sizes, stage(filled, "mix-filled"), config), "mix-cuts")


def _cuts(sizes, filled, config):
    """``filled`` with the end of the quota: all places up to ``cut``, and ``some`` rows of ``edge``.

    ``cut`` and ``edge`` may be null: then no place, or every place, is within the quota.
    """
    # What is not decided: rows of the bucket that passes the quota, and the size before it.
    left = sizes.filter("size > 0").join(filled.select("skey", "quota"), "skey").withColumn(
        "before", F.lit(0).cast("long"))
    found, digits = [], 0
    while True:
        digits = min(digits + config.digits, PLACE_DIGITS)
        order = Window.partitionBy("skey").orderBy("bucket")
        buckets = left.groupBy("skey", F.substring("place", 1, digits).alias("bucket")).agg(
            F.sum("size").alias("n"), F.count("*").alias("rows"), F.max("size").alias("size"),
            F.min("place").alias("low"), F.max("place").alias("high"),
            F.first("before").alias("before"), F.first("quota").alias("quota"))
        buckets = buckets.withColumn("before", F.col("before") + F.sum("n").over(order) - F.col("n"))
        edge = stage(buckets.filter("before + n > quota").groupBy("skey").agg(
            F.min(F.struct("bucket", "before", "rows", "size", "low", "high", "quota")).alias("e"))
            .select("skey", "e.*"), "mix-edge")
        found.append(edge.filter("low = high"))
        open_ = edge.filter("low < high").select("skey", "bucket", "before", "quota")
        if open_.isEmpty():
            break
        left = stage(left.drop("before", "quota").join(open_, "skey").filter(
            F.col("place").startswith(F.col("bucket"))).drop("bucket"), "mix-left")
    # Of ``rows`` equal rows at the edge, the j-th is taken if the middle of it is within the quota.
    fit = F.floor((2 * (F.col("quota") - F.col("before")) + F.col("size")) / (2 * F.col("size")))
    edges = reduce(DataFrame.unionAll, found).select(
        "skey", F.col("low").alias("edge"), F.least(F.greatest(fit, F.lit(0)), "rows").alias("some"), "rows")
    return filled.join(edges, "skey", "left").select(
        "skey", "source_size", "target", "whole", "edge", "some",
        (F.col("some").isNotNull() & (F.col("some") > 0) & (F.col("some") < F.col("rows"))).alias("split"))


def _with_copies(rows, sources):
    """``rows`` (place, whole, edge, some, split) with ``copies``: whole ones, and one more within the quota."""
    place, edge = F.col("_mix_place"), F.col("_mix_edge")

    def copies(more):
        return (F.col("_mix_whole") + F.when(more, 1).otherwise(0)).cast("long")

    within = edge.isNull() | (place < edge) | ((place == edge) & (F.col("_mix_some") > 0))
    if sources.filter("split").isEmpty():
        return rows.withColumn("_mix_copies", copies(within))
    cut = F.coalesce(F.col("_mix_split") & (place == edge), F.lit(False))
    some = numbered(rows.filter(cut), "_mix_skey")
    return rows.filter(~cut).withColumn("_mix_copies", copies(within)).unionByName(some.withColumn(
        "_mix_copies", copies(F.col("number") <= F.col("_mix_some"))).drop("number"))


def _renamed(sources):
    return sources.select(*[F.col(c).alias(f"_mix_{c}") for c in sources.columns])


def allocate(docs, config=MixConfig(), weights=None, id_col="doc_id", text_col="text",
             source_col="source"):
    """(id, size, source_size, target, taken, copies) of every row."""
    sizes, sources = plan(docs, config, weights, id_col, text_col, source_col)
    rows = sizes.join(_renamed(sources), F.col("skey") == F.col("_mix_skey")).withColumnRenamed(
        "place", "_mix_place")
    return _with_copies(rows, sources).select(
        F.col("id").alias(id_col), "size", F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"), (F.col("size") * F.col("_mix_copies")).alias("taken"),
        F.col("_mix_copies").alias("copies"))


def mix(docs, config=MixConfig(), weights=None, id_col="doc_id", text_col="text",
        source_col="source"):
    """The rows of ``docs``, each as often as the mix takes it, with their own columns."""
    _, sources = plan(docs, config, weights, id_col, text_col, source_col)
    rows = docs.withColumn("_mix_place", _place(id_col, text_col, config.seed)).join(
        _renamed(sources), _key(source_col) == F.col("_mix_skey"))
    repeated = _with_copies(rows, sources).filter("_mix_copies > 0").withColumn(
        "_mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_copies"))))
    return repeated.select(*[repeated[f"`{c}`"] for c in docs.columns])


SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source,
    CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5(CAST(doc_id AS VARCHAR) || ':20240101') AS place
  FROM documents
), sources AS (
  SELECT source, size, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM sizes GROUP BY source)
), level(i, x) AS (
  SELECT 0, (SELECT CAST(1.5 AS DOUBLE) * CAST(sum(size) AS BIGINT) / sum(weight) FROM sources)
  UNION ALL
  SELECT i + 1, (SELECT (CAST(1.5 AS DOUBLE) * CAST(sum(size) AS BIGINT)
      - CAST(sum(CASE WHEN level.x * weight > 2 * size THEN 2 * size ELSE 0 END) AS BIGINT))
      / sum(CASE WHEN level.x * weight > 2 * size THEN 0 ELSE weight END) FROM sources)
  FROM level WHERE i < 40 AND x IS NOT NULL
), filled AS (
  SELECT source, size AS source_size, least(2.0::DOUBLE * size, (SELECT max(x) FROM level) * weight)
    AS target
  FROM sources
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
    AS whole
  FROM filled
), ordered AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole,
    p.target - p.whole * p.source_size AS quota,
    CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sizes s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN 2 * upto - size <= 2 * quota THEN 1 ELSE 0 END) AS taken
FROM ordered
"""
