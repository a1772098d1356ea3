"""Duplicate keys: report, flag, keep the first."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_first(df, keys, order):
    """One row per key, the first by ``order``.

    ``row_number() = 1`` is limited per key before the shuffle (window group
    limit), so a key with a third of the rows sends one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")


def repeated_keys(df, keys):
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def flag_duplicates(df, keys, order):
    """Every row, with ``is_duplicate`` on all but the first of its key.

    Identical rows are first counted into one (map-side combined) and expanded
    again at the end, and only the first row per key is looked up by a join, so
    no window ever holds all copies of a key.
    """
    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)]
    plain = df.withColumns({m: F.array_sort(F.map_entries(m)) for m in maps})
    counted = plain.groupBy(*plain.columns).agg(F.count("*").alias("_copies"))
    whole = F.xxhash64(*[F.col(c) for c in plain.columns])
    firsts = keep_first(counted.withColumn("_row", whole), keys, [*order, "_row"]).select(
        *keys, F.col("_row").alias("_first")
    )
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"f.{k}")) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    marked = (
        counted.withColumn("_row", whole).alias("r")
        .join(firsts.alias("f"), condition)
        .select("r.*", (F.col("r._row") == F.col("f._first")).alias("_is_first"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("is_duplicate", ~(F.col("_is_first") & (F.col("_copy") == 1)))
    )
    return marked.withColumns({m: F.map_from_entries(m) for m in maps}).select(
        *df.columns, "is_duplicate"
    )
