"""The eight fraud patterns as boolean columns.

Customers of at most ``whole_rows`` rows are one window group each: their rows
are shuffled once.  For larger ones every trailing window is a running sum of
per-second counts (``skew.sliding_sums``), joined back on (customer, second),
so no group is a whole large customer and none of their frames is swept row by
row.  Only the measures of the patterns asked for are computed; patterns of a
row's own features alone need no shuffle.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.config import DetectorConfig
from ledgerwatch.operators import skew
from ledgerwatch.operators.features import CUSTOMER
from ledgerwatch.schema import UNKNOWN_CUSTOMER

PATTERNS = [
    "account_takeover", "card_testing", "velocity_attack", "impossible_travel",
    "amount_probing", "merchant_collusion", "synthetic_identity", "bust_out",
]
ROW_PATTERNS = {"velocity_attack", "impossible_travel"}  # they read the row's own features only
DAY = 86400


def _holds(condition):
    return F.coalesce(condition, F.lit(False))


def _one_if(condition):
    return F.when(condition, 1).otherwise(0).cast("long")


def row_traits(cfg):
    """Row conditions the windows count that need no other row."""
    amount = F.col("amount")
    return {
        "_small": _holds(amount < cfg.testing_amount),
        "_small_declined": _holds(
            (amount < cfg.testing_amount) & (F.col("status") == "DECLINED")),
        "_risky_category": _holds(
            F.col("merchant_category").isin(list(cfg.collusion_categories))
            & F.col("merchant_id").isNotNull() & amount.isNotNull()),
        "_large": _holds(amount >= cfg.identity_amount),
    }


def _traits(cfg):
    """Row conditions the windows count."""
    unusual_place = F.col("is_international") | (
        F.col("distance_from_last_km") > cfg.distance_km)
    return {
        "_takeover": _holds(
            (F.col("amount") >= cfg.takeover_amount) & ~F.col("customer_present") & unusual_place),
        **row_traits(cfg),
    }


# Which additive windows a pattern reads.
MEASURES_OF = {
    "account_takeover": ["_n_takeover"], "card_testing": ["_n_small", "_n_small_declined"],
    "synthetic_identity": ["_n_large"],
    "bust_out": ["_n_day", "_sum_day", "_n_month", "_sum_month"],
}


def _window_measures(cfg):
    """name -> (value, span in seconds) of every additive trailing window."""
    amount = F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(28,2)")
    counted = _one_if(F.col("amount").isNotNull())
    month = cfg.bustout_days * DAY
    return {
        "_n_takeover": (_one_if(F.col("_takeover")), cfg.takeover_minutes * 60),
        "_n_small": (_one_if(F.col("_small")), cfg.testing_minutes * 60),
        "_n_small_declined": (_one_if(F.col("_small_declined")), cfg.testing_minutes * 60),
        "_n_large": (_one_if(F.col("_large")), cfg.identity_hours * 3600),
        "_n_day": (counted, DAY),
        "_sum_day": (amount, DAY),
        "_n_month": (counted, month),
        "_sum_month": (amount, month),
    }


def _pattern_columns(cfg):
    """The patterns, from the traits and window columns."""
    declined_share = F.col("_n_small_declined") / F.col("_n_small")
    travel_hours = F.col("time_since_last_minutes") / 60
    far = F.col("distance_from_last_km") > cfg.travel_min_km
    earlier_n = F.col("_n_month") - F.col("_n_day")
    earlier_sum = F.col("_sum_month") - F.col("_sum_day")
    factor = F.lit(cfg.bustout_factor)
    # mean(day) >= factor * mean(earlier), without dividing
    spike = (
        F.col("_sum_day").cast("double") * earlier_n
        >= factor * earlier_sum.cast("double") * F.col("_n_day")
    )
    return {
        "account_takeover": F.col("_takeover") & (F.col("_n_takeover") >= cfg.takeover_rows),
        "card_testing": F.col("_small") & (F.col("_n_small") >= cfg.testing_rows)
        & (declined_share >= cfg.testing_declined_share),
        "velocity_attack": F.col("velocity_1h") + 1 >= cfg.attack_rows,
        "impossible_travel": far & (
            F.col("distance_from_last_km") > cfg.travel_speed_kmh * travel_hours),
        "amount_probing": F.col("_rising_run"),
        "merchant_collusion": F.col("_risky_category")
        & (F.col("_merchants") >= cfg.collusion_merchants)
        & (F.col("_max_amount") - F.col("_min_amount") <= cfg.collusion_spread),
        "synthetic_identity": F.col("_large")
        & (F.col("_sec") <= F.col("_first_sec") + cfg.identity_hours * 3600)
        & (F.col("_n_large") >= cfg.identity_rows),
        "bust_out": (earlier_n >= cfg.bustout_earlier_rows)
        & (F.col("_n_day") >= cfg.bustout_recent_rows) & spike,
    }


def _rising_run(group, cfg):
    """(whether a row rises, whether it ends a run of rising amounts within the allowed gaps).

    The run is a fixed look-back of ``probing_rows`` rows, so no running counter
    over the whole group is needed.
    """
    ordered = Window.partitionBy(*group).orderBy("_sec", "timestamp", "transaction_id")
    rises = _one_if(
        (F.col("amount") > F.lag("amount").over(ordered))
        & (F.col("_sec") - F.lag("_sec").over(ordered) <= cfg.probing_gap_minutes * 60)
    )
    steps = cfg.probing_rows - 1
    return rises, F.sum("_rises").over(ordered.rowsBetween(-(steps - 1), 0)) == steps


def _collusion(rows, cfg):
    """Distinct merchants and amount spread of the trailing hour, one row per second.

    A merchant counts from one of its rows until its next row or the end of the
    hour, whichever is first; summing those +1/-1 events counts each merchant
    once without ever holding a set.
    """
    span = cfg.collusion_minutes * 60
    risky = rows.filter("_risky_category")
    per_merchant = risky.groupBy(CUSTOMER, "merchant_id", "_sec").agg(
        F.max("amount").alias("_hi"), F.min("amount").alias("_lo")
    ).withColumn("_span_block", F.floor(F.col("_sec") / span))
    # next row of the same merchant, if within the hour: it lies in this block or the next
    reachable = per_merchant.withColumn(
        "_own", F.explode(F.array(F.col("_span_block"), F.col("_span_block") - 1))
    )
    ahead = Window.partitionBy(CUSTOMER, "merchant_id", "_own").orderBy("_sec")
    leaving = (
        reachable.withColumn("_next", F.lead("_sec").over(ahead))
        .filter(F.col("_own") == F.col("_span_block"))
        .withColumn("_end", F.least(
            F.coalesce("_next", F.col("_sec") + span + 1), F.col("_sec") + span + 1))
    )
    events = leaving.select(
        CUSTOMER,
        F.explode(F.array(
            F.struct(F.col("_sec").alias("_sec"), F.lit(1).cast("long").alias("_merchants"),
                     F.lit(1).alias("_real")),
            F.struct(F.col("_end").alias("_sec"), F.lit(-1).cast("long").alias("_merchants"),
                     F.lit(0).alias("_real")),
        )).alias("_e"),
    ).select(CUSTOMER, "_e.*")
    counted = skew.running_sums(
        events.groupBy(CUSTOMER, "_sec").agg(
            F.sum("_merchants").alias("_merchants"), F.max("_real").alias("_real")),
        [CUSTOMER], "_sec", ["_merchants"], DAY,
    ).filter("_real = 1").drop("_real")

    per_second = per_merchant.groupBy(CUSTOMER, "_sec").agg(
        F.max("_hi").alias("_hi"), F.min("_lo").alias("_lo"),
    ).withColumn("_span_block", F.floor(F.col("_sec") / span)).withColumn(
        "_own", F.explode(F.array(F.col("_span_block"), F.col("_span_block") + 1)))
    frame = Window.partitionBy(CUSTOMER, "_own").orderBy("_sec").rangeBetween(-span, 0)
    spread = (
        per_second.withColumns({
            "_max_amount": F.max("_hi").over(frame), "_min_amount": F.min("_lo").over(frame)})
        .filter(F.col("_own") == F.col("_span_block"))
        .select(CUSTOMER, "_sec", "_max_amount", "_min_amount")
    )
    return counted.join(spread, [CUSTOMER, "_sec"])


def _rising_runs(rows, cfg):
    """Amount probing on (customer, merchant, block) groups.

    A run of n rows spans at most (n - 1) gaps, so rows of the last such stretch
    of a block are repeated in the next one.
    """
    reach = (cfg.probing_rows - 1) * cfg.probing_gap_minutes * 60
    own = F.floor(F.col("_sec") / reach)
    blocked = rows.withColumn("_own", own).withColumn(
        "_block", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    rises, run = _rising_run([CUSTOMER, "merchant_id", "_block"], cfg)
    return (
        blocked.withColumn("_rises", rises).withColumn("_rising_run", run)
        .filter(F.col("_own") == F.col("_block")).drop("_own", "_block")
    )


def _measures_of(cfg, patterns):
    wanted = {m for p in patterns for m in MEASURES_OF.get(p, [])}
    return {n: m for n, m in _window_measures(cfg).items() if n in wanted}


def _whole(df, cfg, patterns, clustered=False):
    """The window columns that ``patterns`` read, with a customer as one group."""
    by_second = Window.partitionBy(CUSTOMER).orderBy("_sec")
    frame = lambda span: by_second.rangeBetween(-span, 0)
    columns = {name: F.sum(value).over(frame(span)) for name, (value, span) in _measures_of(cfg, patterns).items()}
    if "merchant_collusion" in patterns:
        hour = frame(cfg.collusion_minutes * 60)
        risky = lambda c: F.when(F.col("_risky_category"), F.col(c))
        columns |= {
            "_merchants": F.size(F.collect_set(risky("merchant_id")).over(hour)),
            "_max_amount": F.max(risky("amount")).over(hour), "_min_amount": F.min(risky("amount")).over(hour)}
    if "synthetic_identity" in patterns:
        columns["_first_sec"] = F.min("_sec").over(by_second.rangeBetween(Window.unboundedPreceding, 0))
    out = df.withColumns(columns) if columns else df
    if "amount_probing" in patterns:
        # a window over customers comes first: its shuffle serves the one over customers and merchants, too
        out = out if columns or clustered else out.repartition(CUSTOMER)
        rises, run = _rising_run([CUSTOMER, "merchant_id"], cfg)
        out = out.withColumn("_rises", rises).withColumn("_rising_run", run)
    return out


def _split(df, cfg, patterns):
    """The window columns that ``patterns`` read, in groups smaller than a customer."""
    out = df
    if "amount_probing" in patterns:
        out = _rising_runs(out, cfg)
    measures = _measures_of(cfg, patterns)
    if measures:
        out = out.join(skew.sliding_sums(df, [CUSTOMER], "_sec", measures), [CUSTOMER, "_sec"])
    if "merchant_collusion" in patterns:
        out = out.join(_collusion(df, cfg), [CUSTOMER, "_sec"], "left").withColumn(
            "_merchants", F.coalesce("_merchants", F.lit(0)))
    if "synthetic_identity" in patterns:
        out = out.join(df.groupBy(CUSTOMER).agg(F.min("_sec").alias("_first_sec")), CUSTOMER)
    return out


def add_row_patterns(df, cfg=DetectorConfig()):
    """The two patterns that follow from the row's own features, for use on streams."""
    columns = _pattern_columns(cfg)
    return df.withColumns(
        {name: _holds(columns[name]) for name in sorted(ROW_PATTERNS)})


def add_patterns(df, cfg=DetectorConfig(), patterns=PATTERNS, clustered=False):
    """Add pattern columns (all eight, or those named) to rows that carry the features.

    "First seen" (synthetic identity) means first in ``df``: pass the whole
    history.  Patterns of rows without a known customer are false.  The input
    is read several times: pass a stored table.

    ``clustered``: ``df`` holds known customers of few rows each, in buckets of customers
    (``features.feature_tables``, ``features.clustered_rows``); they are neither counted nor shuffled.
    """
    known = F.col(CUSTOMER).isNotNull() & (F.col(CUSTOMER) != UNKNOWN_CUSTOMER) \
        & F.col("timestamp").isNotNull()
    rows = df.withColumns({"_sec": F.unix_seconds("timestamp"), **_traits(cfg)})
    columns = _pattern_columns(cfg)
    wanted = [*df.columns, *[_holds(columns[name]).alias(name) for name in patterns]]
    if clustered:
        return _whole(rows, cfg, patterns, clustered).select(wanted)
    unknown = df.filter(~known | known.isNull()).withColumns(
        {name: F.lit(False) for name in patterns})
    windowed = rows.filter(known)
    if set(patterns) - ROW_PATTERNS:
        windowed = skew.by_size(
            windowed, CUSTOMER, cfg.whole_rows,
            lambda some: _whole(some, cfg, patterns).select(wanted),
            lambda some: _split(some, cfg, patterns).select(wanted))
    else:
        windowed = windowed.select(wanted)
    return windowed.unionByName(unknown)
