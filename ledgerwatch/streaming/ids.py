"""Ids that have been written, whatever their date and whichever checkpoint wrote them.

Ids fall into hash buckets.  A batch adds its new ids sorted by bucket, and one Bloom filter per bucket; a
compaction merges them into a folder per bucket.  A lookup tests the batch's ids against the filters of
their buckets and reads the ids of those buckets alone in which a filter says "perhaps", so a batch
without repetitions reads no ids.  Filters only save reading: what they let through is compared by the
id itself.
"""

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

BUCKETS = 256
BITS_PER_ID, HASHES = 12, 8
IDS = "transaction_id string, bucket int, batch_id long"
FILTERS = "bucket int, bits binary, batch_id long"


def with_bucket(ids):
    return ids.select("transaction_id", F.pmod(F.xxhash64("transaction_id"), F.lit(BUCKETS)).cast(
        "int").alias("bucket"))


def _hashes(ids):
    return ids.withColumns({"h": F.xxhash64("transaction_id", F.lit(1)), "g": F.xxhash64("transaction_id", F.lit(2))})


def positions(h, g, bits):
    """The places of ids in a filter of ``bits`` bits, one row of HASHES each."""
    with np.errstate(over="ignore"):
        steps = h[:, None].astype(np.uint64) + np.arange(HASHES, dtype=np.uint64) * (g[:, None].astype(np.uint64) | np.uint64(1))
    return (steps % np.uint64(bits)).astype(np.int64)


def filters(ids):
    """(bucket, bits): the Bloom filter of each bucket of ``ids`` (transaction_id, bucket)."""

    def build(rows):
        bits = max(64, -(-len(rows) * BITS_PER_ID // 8) * 8)
        made = np.zeros(bits, bool)
        made[positions(rows["h"].to_numpy(), rows["g"].to_numpy(), bits).ravel()] = True
        return pd.DataFrame({"bucket": rows["bucket"].iloc[:1], "bits": [np.packbits(made).tobytes()]})

    return _hashes(ids).groupBy("bucket").applyInPandas(build, "bucket int, bits binary")


def perhaps(ids, known):
    """Those of ``ids`` that a filter of their bucket does not rule out."""

    def test(rows, found):
        hit = np.zeros(len(rows), bool)
        for bits in found["bits"]:
            made = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
            hit |= made[positions(rows["h"].to_numpy(), rows["g"].to_numpy(), len(made))].all(axis=1)
        return rows.loc[hit, ["transaction_id", "bucket"]]

    return _hashes(ids).groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(
        test, "transaction_id string, bucket int")


def _buckets(rows):
    """The distinct buckets: at most BUCKETS numbers."""
    return [r[0] for r in rows.select("bucket").distinct().collect()]


def repeated(commits, state, ids):
    """(transaction_id) of ``ids`` that a committed batch has written."""
    ids = with_bucket(ids.select("transaction_id").filter("transaction_id IS NOT NULL").distinct())
    none = commits.spark.createDataFrame([], "transaction_id string")
    if not state.folders.get("ids") and not state.folders.get("ids_packed"):
        return none
    ids = ids.persist()
    touched = _buckets(ids)
    known = [commits.read(t, FILTERS, state).filter(F.col("bucket").isin(touched)).select("bucket", "bits")
             for t in ("id_filters", "id_filters_packed")]
    some = perhaps(ids, known[0].unionAll(known[1])).persist()
    buckets = _buckets(some)
    ids.unpersist()
    if not buckets:
        return none
    stored = [commits.read(t, IDS, state).filter(F.col("bucket").isin(buckets)).select("transaction_id")
              for t in ("ids", "ids_packed")]
    return some.select("transaction_id").join(stored[0].unionAll(stored[1]), "transaction_id", "left_semi")


def write(put, ids):
    """Write the new ids of a batch and their filters; ``put(df, table)`` writes one folder."""
    ids = with_bucket(ids.filter("transaction_id IS NOT NULL")).persist()
    put(ids.repartitionByRange(F.col("bucket")).sortWithinPartitions("bucket"), "ids")
    put(filters(ids), "id_filters")
    ids.unpersist()


def compact(commits, most_folders=8):
    """Merge the ids into a folder per bucket with one filter each, in one commit."""
    state = commits.state()
    tables = ["ids", "ids_packed", "id_filters", "id_filters_packed"]
    old = {t: list(state.folders.get(t, [])) for t in tables}
    if len(old["ids"]) <= most_folders:
        return False
    name = f"run=compacted-{uuid.uuid4().hex[:12]}/batch_id=-1"
    every = commits.read("ids", IDS, state).unionByName(commits.read("ids_packed", IDS, state))
    every.drop("batch_id").hint("rebalance", "bucket").write.partitionBy("bucket").parquet(
        f"{commits.root}/ids_packed/{name}")
    packed = commits.spark.read.schema("transaction_id string, bucket int").parquet(
        f"{commits.root}/ids_packed/{name}")
    filters(packed).repartition("bucket").write.partitionBy("bucket").parquet(
        f"{commits.root}/id_filters_packed/{name}")

    def change(now):
        if any(set(old[t]) - set(now.folders.get(t, [])) for t in tables):
            return None
        return {"remove": old, "add": {"ids_packed": [name], "id_filters_packed": [name]}}

    return name in commits.commit(change).folders.get("ids_packed", [])
