"""Building blocks that keep every window group bounded.

A plain ``Window.partitionBy(customer)`` puts a whole customer into one task,
and a sliding RANGE frame costs (rows in frame) per row.  The helpers here work
in groups that are bounded whatever the distribution:

* ``by_size`` gives keys of few rows to plain windows and the others to the helpers below,
* ``buckets_for`` is the number of buckets in which keys of few rows are stored, for steps without a shuffle,
* ``running_sums`` is a cumulative sum split over (key, block) groups,
* ``sliding_sums`` turns a sliding frame into +/- events and a running sum,
* ``exact_median`` ranks pre-counted values with the same running sum.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.session import store

# Rows of a bucket, as long as there are no more buckets than shuffle partitions.
BUCKET_ROWS = 50_000


def apart(rows, key, most):
    """(the rows of keys with at most ``most`` rows, those of the others or None if there are none).

    At most one key in ``most`` rows is a large one; they are stored, so that the join with them is
    planned by their measured size.
    """
    large = store(rows.groupBy(key).agg(F.count("*").alias("_size")).filter(F.col("_size") > most).select(key),
                  "large-keys")
    if large.isEmpty():
        return rows, None
    return rows.join(large, key, "left_anti"), rows.join(large, key, "left_semi")


def by_size(rows, key, most, whole, split):
    """``whole`` over the rows of keys with at most ``most`` rows, ``split`` over those of the others.

    Both keep a row per row and their columns are the same.
    """
    small, large = apart(rows, key, most)
    return whole(small) if large is None else whole(small).unionByName(split(large))


def buckets_for(rows, of=BUCKET_ROWS):
    """The number of buckets of ``of`` rows for ``rows``, which are counted."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(most, -(-rows.count() // of)))


def running_sums(df, keys, at, columns, block_width):
    """Add ``<column>`` cumulative sums over ``at`` per key, current row included.

    ``df`` has one row per (keys, at).  The sum is split into blocks of
    ``block_width`` units: totals of earlier blocks plus the sum inside the
    block.  A group is at most one block, a prefix group one row per block.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", F.floor(F.col(at) / block_width))
    totals = blocked.groupBy(*keys, "_block").agg(*[F.sum(c).alias(f"_t_{c}") for c in columns])
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    prefix = totals.select(
        *keys, "_block",
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_p_{c}") for c in columns],
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(at).rowsBetween(
        Window.unboundedPreceding, 0
    )
    summed = blocked.withColumns({c: F.sum(c).over(inside) for c in columns})
    return (
        # the rows lie by block already; the prefixes grow with them, so they do not go through the driver
        summed.join(prefix.hint("merge"), [*keys, "_block"])
        .withColumns({c: F.col(c) + F.col(f"_p_{c}") for c in columns})
        .drop("_block", *[f"_p_{c}" for c in columns])
    )


def sliding_sums(rows, keys, at, measures, block_width=86400):
    """Sums over trailing RANGE frames, one row per (keys, at).

    ``measures`` maps a name to (value column, span) for the frame
    [at - span, at]; a span of None means "everything up to at".  Each row adds
    its value at ``at`` and takes it back at ``at + span + 1``, so the frame
    becomes a running sum whose cost does not depend on the frame's width.
    Values must be exact types (integers, decimals) so that they cancel.
    """
    keys = list(keys)
    spans = sorted({span for _, span in measures.values() if span is not None})
    values = rows.select(*keys, at, *[v.alias(name) for name, (v, _) in measures.items()])
    types = dict(values.dtypes)

    def event(instant, real, signed):
        return F.struct(
            instant.alias("_at"), F.lit(real).alias("_real"),
            *[signed(name).cast(types[name]).alias(name) for name in measures],
        )

    def leaving(span):
        return lambda name: -F.col(name) if measures[name][1] == span else F.lit(0)

    enter = event(F.col(at), 1, F.col)
    leave = [event(F.col(at) + span + 1, 0, leaving(span)) for span in spans]
    events = values.select(*keys, F.explode(F.array(enter, *leave)).alias("_e")).select(
        *keys, "_e.*"
    )
    summed = events.groupBy(*keys, "_at").agg(
        F.max("_real").alias("_real"), *[F.sum(name).alias(name) for name in measures]
    )
    return (
        running_sums(summed, keys, "_at", list(measures), block_width)
        .filter(F.col("_real") == 1)
        .drop("_real")
        .withColumnRenamed("_at", at)
    )


def exact_median(df, group, value, block_width=100):
    """Exact median per group from counted values; a group never meets in one buffer.

    Values are counted map-side first, so the ranking works on distinct values
    in blocks of ``block_width``.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(
        F.count("*").alias("_n")
    )
    return counted_median(counted, group, value, block_width)


def counted_median(counted, group, value, block_width=100):
    """``exact_median`` of values that are counted: ``_n`` of each (group, value).  They are read three times."""
    ranked = running_sums(counted.withColumn("_upto", F.col("_n")), [group], value, ["_upto"],
                          block_width)
    total = counted.groupBy(group).agg(F.sum("_n").alias("_total"))
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor(F.col("_total") / 2) + 1
    first = F.col("_upto") - F.col("_n") + 1
    holds = lambda rank: (first <= rank) & (rank <= F.col("_upto"))
    return (
        ranked.join(total, group)
        .filter(holds(low) | holds(high))
        .groupBy(group)
        .agg((
            (F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2
        ).alias(f"median_{value}"))
    )
