"""Sharding by sampled splitters, with DataFrame functions only.

Records are ordered by (key, id), where the key is the CRC-32 of the text: copies are neighbours.
Key samples, drawn with a chance that grows with the record's size, give quantile boundaries that
cut the order into many more ranges than shards.  One combined aggregate measures the ranges
exactly; a range that came out overfull (a hot key, a huge record) is subdivided by samples of
(key, id).  Sizes are then summed up inside each range only, and the totals of the ranges before
turn that into a global position: a shard takes an equal part of all bytes.

A shard's bytes differ from the mean by at most one record or held group.  A group of equal keys of
at most ``hold`` of a shard goes to one shard whole; larger groups are split at the boundary.  All
tables after the first pass are narrow (no text), the splitters and range totals are bounded by
parameters, and a hot key is spread over as many ranges as it fills.

Null texts count as empty, null ids come first among equal texts.  Repeated rows are separate
records of equal rank.  An empty table gives no rows.  Other columns are ignored.
"""

from dataclasses import dataclass
from math import ceil, isqrt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.llm.staging import stage

LOWEST = -(2 ** 63)


@dataclass(frozen=True)
class ShardConfig:
    shards: int = 16
    ranges_per_shard: int = 16
    range_rows: int = 2_000_000  # more ranges where each would hold more rows than this
    samples: int = 32  # per range
    overfull: float = 1.5  # times the mean range
    hold: float = 0.02  # of a shard: groups up to this stay whole
    seed: int = 7


def _range_of(splitters):
    """How many splitters are not above (key, tie); two levels, so the cost is a square root."""
    if not splitters:
        return F.lit(0)
    width = isqrt(len(splitters) - 1) + 1
    blocks = [splitters[i:i + width] for i in range(0, len(splitters), width)]
    kind = "array<struct<k:bigint,t:bigint>>"

    def text(pairs):
        return ",".join(f'{{"k":{k},"t":{t}}}' for k, t in pairs)

    heads = F.from_json(F.lit(f"[{text([b[0] for b in blocks])}]"), kind)
    table = F.from_json(F.lit("[" + ",".join(f"[{text(b)}]" for b in blocks) + "]"),
                        f"array<{kind}>")
    here = F.struct(F.col("key").alias("k"), F.col("tie").alias("t"))
    block = F.size(F.filter(heads, lambda s: s <= here))
    inside = F.filter(F.get(table, block - 1), lambda s: s <= here)
    return F.when(block == 0, 0).otherwise((block - 1) * width + F.size(inside))


def _sample(rows, wanted, total, seed):
    """Rows drawn with chance wanted * size / total, and the bytes each stands for."""
    step = total / wanted
    chance = F.pmod(F.xxhash64("id", "key", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return rows.filter(chance < F.col("size") / step).withColumn(
        "stands_for", F.greatest(F.col("size").cast("double"), F.lit(step)))


def _quantiles(sample, by, step, of=()):
    """The (key, tie) at which the summed sample passes a multiple of ``step``."""
    grouped = sample.groupBy(*of, *by).agg(F.sum("stands_for").alias("w"))
    upto = F.sum("w").over(Window.partitionBy(*of).orderBy(*by))
    return (grouped.withColumn("upto", upto)
            .filter(F.floor(F.col("upto") / step) > F.floor((F.col("upto") - F.col("w")) / step))
            .select(*by))


def assign(docs, config=ShardConfig(), id_col="doc_id", text_col="text", carry=()):
    """(id, size, text_crc32, shard, slot) of every record; slots of a shard count up from 0.

    ``carry`` names narrow columns of ``docs`` that come along.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    number = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    tie = F.col(id_col).cast("long") if number else F.xxhash64(id_col)
    rows = stage(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("key"),
        F.when(F.col(id_col).isNull(), F.lit(LOWEST)).otherwise(tie).alias("tie"), *carry,
    ), "shard-rows")
    count, total = rows.agg(F.count("*"), F.sum("size")).first()
    n = config.shards
    if not count:
        return rows.select(F.col("id").alias(id_col), "size", F.col("key").alias("text_crc32"),
                           F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), *carry)
    ranges = max(n * config.ranges_per_shard, ceil(count / config.range_rows))
    step = total / ranges
    first = _quantiles(_sample(rows, ranges * config.samples, total, config.seed), ["key"], step)
    splitters = sorted({(r[0], LOWEST) for r in first.collect()})

    def measured(splitters):
        return rows.withColumn("range", _range_of(splitters)).groupBy("range").agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()

    found = measured(splitters)
    overfull = [r["range"] for r in found if r["bytes"] > config.overfull * step]
    if overfull:
        large = rows.withColumn("range", _range_of(splitters)).filter(F.col("range").isin(overfull))
        held = sum(r["bytes"] for r in found if r["range"] in set(overfull))
        drawn = _sample(large, config.samples * ceil(held / step), held, config.seed + 1)
        more = {(r[0], r[1]) for r in _quantiles(drawn, ["key", "tie"], step, ["range"]).collect()}
        # Keys small enough to stay whole are cut at their beginning, not inside.
        sizes = rows.filter(F.col("key").isin([k for k, _ in more])).groupBy("key").agg(
            F.sum("size")).collect() if more else []
        small = {k for k, size in sizes if size <= config.hold * total / n}
        splitters = sorted({*splitters, *((k, LOWEST if k in small else t) for k, t in more)})
        found = measured(splitters)
    before, table = (0, 0), []
    for r in sorted(found, key=lambda r: r["range"]):
        table.append((r["range"], *before))
        before = (before[0] + r["bytes"], before[1] + r["rows"])
    starts = docs.sparkSession.createDataFrame(
        table, "range int, bytes_before long, rows_before long")  # one row per range

    order = Window.partitionBy("range").orderBy("key", "tie", "id", "size")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    group = Window.partitionBy("range", "key")
    placed = (rows.withColumn("range", _range_of(splitters))
              .join(F.broadcast(starts), "range")
              .withColumn("start", upto - F.col("size"))
              .withColumn("row", F.row_number().over(order) - 1 + F.col("rows_before"))
              .withColumn("group_size", F.sum("size").over(group))
              .withColumn("group_start", F.min("start").over(group)))
    held = F.col("group_size") <= config.hold * total / n
    at = F.col("bytes_before") + F.when(held, F.col("group_start")).otherwise(F.col("start"))
    shard = F.least(F.floor(at.cast("decimal(38,0)") * n / F.lit(total)).cast("int"), F.lit(n - 1))
    placed = stage(placed.select("id", "size", "key", shard.alias("shard"), "row", *carry), "shard-placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col), "size", F.col("key").alias("text_crc32"), "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"), *carry)


PLACED = ["size", "text_crc32", "shard", "slot"]


def with_shards(docs, config=ShardConfig(), id_col="doc_id", text_col="text", stored=False):
    """The rows of ``docs`` with all their columns, and ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Rows meet their places by their file and their number in it, so repeated rows each get one place.
    ``stored`` says that ``docs`` is a table as it was read from Parquet files; else it is stored first.
    Columns of ``docs`` with one of the four names give way.
    """
    table = docs if stored else stage(docs, "shard-docs")
    own = table.select(*[F.col(f"`{c}`") for c in docs.columns if c not in PLACED],
                       F.xxhash64("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_row"))
    places = assign(own, config, id_col, text_col, ["_file", "_row"])
    return own.join(places.select("_file", "_row", *PLACED), ["_file", "_row"]).drop("_file", "_row")


def write_shards(docs, path, config=ShardConfig(), id_col="doc_id", text_col="text", stored=False):
    """Write ``with_shards`` as a folder for each shard below ``path``, in order of the slots.

    Large shards are written by several tasks.  Returns the written table.
    """
    return write_placed(with_shards(docs, config, id_col, text_col, stored), path)


def write_placed(rows, path):
    """Write rows that have their ``shard`` and ``slot`` as ``write_shards`` does."""
    rows.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)
