"""Session settings and the shared folder for checkpoints and staged tables."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Rows that a join may send through the driver to every task.
BROADCAST_ROWS = 100_000


def build_session(app_name="ledgerwatch", master=None, shuffle_partitions=None, **conf):
    """A session with UTC time and AQE.

    On a cluster, master, memory and ``spark.checkpoint.dir`` come from
    ``spark-submit``; the arguments are for local runs.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark, *parts):
    """A path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` wins.  Only a local session without that setting
    gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="ledgerwatch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return "/".join([base.rstrip("/"), *parts])


def fresh_dir(spark, name):
    """A new, unused path below the shared folder."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def store(df, name):
    """``df`` written below the shared folder and read back: short lineage, one computation."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def beside(df, most=None):
    """The stored ``df`` as the side of a join that the planner may broadcast only if it holds few rows.

    Files and shuffles are measured packed: ten megabytes of hashes, days or ids that resemble each other are
    gigabytes of rows in the driver.
    """
    few = df.count() <= (BROADCAST_ROWS if most is None else most)
    return df if few else df.hint("merge")


def store_clustered(df, name, key, buckets):
    """The name of a table that holds ``df`` in buckets of ``key``: what groups by it is not shuffled.

    It lies below the shared folder.  Compressed columns take a fraction of the bytes of shuffled rows.  A
    task keeps a file open for each bucket, so it neither sorts nor spills the rows.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, buckets)
    try:
        df.write.bucketBy(buckets, key).saveAsTable(table, "parquet", path=path, compression="zstd")
    finally:
        spark.conf.set(writers, before)
    return table
