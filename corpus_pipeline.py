"""The corpus pipeline: filter, deduplicate, decontaminate, mix and shard ``documents``.

Each stage takes the whole output of the one before, is written as Parquet below the cluster's
shared folder and read back, so a stage never recomputes its predecessors.
"""

from ledgerwatch.llm import decontam, mixing, probminhash, quality, splitters
from ledgerwatch.llm.staging import stage, table
from ledgerwatch.session import fresh_dir


def quality_filter(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark, docs, sf_dir):
    """One document of each near-duplicate class stays."""
    return probminhash.keep_one(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a test item go."""
    return decontam.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Documents are repeated, kept or left out as the target weights of their sources ask."""
    return mixing.mix(docs)


def shard(spark, docs, sf_dir):
    """Every remaining row, with its columns, gets its shard and its place in it."""
    return splitters.with_shards(docs, stored=True)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Trained weights and signatures have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages; the last one's rows are written as a folder for each shard."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return splitters.write_placed(STAGES[-1][1](spark, docs, sf_dir), fresh_dir(spark, "pipeline-shards"))
