"""Places of rows in an order or in a group, without one task for all of them."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.llm.staging import stage

RANGE_ROWS = 1_000_000


def ranked(rows, keys, count, range_rows=RANGE_ROWS):
    """``rows`` with ``rank``, 1 for the first by ``keys`` (a total order of ``count`` rows).

    Rows are range-partitioned and sorted inside a range; the exact counts of the ranges before are
    added.  The driver sees one number a range.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / range_rows))
    ranges = stage(rows.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()),
                   "ranges")
    before, starts = 0, []
    for r in ranges.groupBy("_range").count().orderBy("_range").collect():
        starts.append((r["_range"], before))
        before += r["count"]
    starts = spark.createDataFrame(starts, "_range int, _before long")
    order = Window.partitionBy("_range").orderBy(*keys)
    return ranges.join(F.broadcast(starts), "_range").withColumn(
        "rank", F.row_number().over(order) + F.col("_before")).drop("_range", "_before")


def numbered(rows, group):
    """``rows`` with ``number``, counting from 1 in every ``group``, in no particular order.

    A group is counted task by task, so it may hold any share of the rows.
    """
    held = stage(rows.withColumns({"_part": F.spark_partition_id(),
                                   "_row": F.monotonically_increasing_id()}), "numbered")
    order = Window.partitionBy(group).orderBy("_part")
    parts = held.groupBy(group, "_part").agg(F.count("*").alias("_n")).select(
        group, "_part", (F.sum("_n").over(order) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy(group, "_part").orderBy("_row")
    return held.join(parts, [group, "_part"]).withColumn(
        "number", F.row_number().over(inside) + F.col("_before")).drop("_part", "_row", "_before")
