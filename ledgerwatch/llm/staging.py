"""Hand-over tables in the cluster's shared folder.

Iterative operators write a round's result and read it back: lineage stays short and a lost
executor costs only the tasks of the current round.
"""

from ledgerwatch.session import fresh_dir


def stage(df, name, *, partitions=None):
    """Write ``df`` below ``spark.checkpoint.dir`` and return the stored table."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{name}")
    if partitions:
        df = df.coalesce(partitions)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
