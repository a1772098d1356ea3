"""Per-customer features: velocity, amount z-score, distance and time since the last row.

Customers of at most ``whole_rows`` rows are one window group each: their rows
are shuffled and sorted once.  For larger ones velocities are running sums
over (customer, day) groups of per-second counts, so a frame costs the same
whatever its width; the same sums give every row its rank, and ROWS frames run
over (customer, rank / chunk_rows) groups, each preceded by the 50 rows it
looks back on.  No window holds a whole large customer.

Rows without a usable customer id keep the row-level features; their window
features are NULL and they take part in no shuffle.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerwatch.config import FeatureConfig
from ledgerwatch.functions.geo import distance_km
from ledgerwatch.operators import skew
from ledgerwatch.schema import UNKNOWN_CUSTOMER
from ledgerwatch.session import store_clustered

CUSTOMER = "customer_id_hash"

# Default merchant risk by category.
CATEGORY_RISK = {"ONLINE": 0.4, "OTHER": 0.35, "ENTERTAINMENT": 0.3}
OTHER_CATEGORY_RISK = 0.2

HELPERS = ["_sec", "_n", "_mean", "_sd", "_prev_lat", "_prev_lon", "_prev_ts"]


def velocity_names(cfg):
    return [f"velocity_{h}h" for h in cfg.velocity_hours]


def merchant_risk():
    given = F.col("metadata").getItem("merchant_risk_score").try_cast("double")
    by_category = F.lit(OTHER_CATEGORY_RISK)
    for category, risk in reversed(CATEGORY_RISK.items()):
        by_category = F.when(F.col("merchant_category") == category, risk).otherwise(by_category)
    return F.coalesce(given, by_category)


def add_row_features(df):
    """Features that need no other row."""
    weekday = F.dayofweek("timestamp")
    return df.withColumns({
        "hour_of_day": F.hour("timestamp"),
        "day_of_week": weekday,
        "is_weekend": F.coalesce(weekday.isin(1, 7), F.lit(False)),
        "merchant_risk_score": merchant_risk(),
    })


def _history_columns(ordered, cfg):
    """Look-back columns over rows already grouped and ordered."""
    past = ordered.rowsBetween(-cfg.history_rows, -1)
    amount = F.col("amount")
    return {
        # sum and count of an exact decimal: the mean does not depend on summation order
        "_mean": F.sum(amount).over(past).cast("double") / F.count(amount).over(past),
        "_sd": F.stddev_samp(amount.cast("double")).over(past),
        "_prev_lat": F.lag("location.latitude").over(ordered),
        "_prev_lon": F.lag("location.longitude").over(ordered),
        "_prev_ts": F.lag("timestamp").over(ordered),
    }


def _finish(df, cfg):
    """Turn look-back columns into features."""
    lat, lon = F.col("location.latitude"), F.col("location.longitude")
    known = F.col("_prev_lat").isNotNull() & F.col("_prev_lon").isNotNull() \
        & lat.isNotNull() & lon.isNotNull()
    seconds = F.unix_seconds("timestamp") - F.unix_seconds("_prev_ts")
    return df.withColumns({
        "amount_zscore": F.when(
            F.col("_sd") > 0, (F.col("amount").cast("double") - F.col("_mean")) / F.col("_sd")
        ).otherwise(0.0),
        "distance_from_last_km": F.when(
            known,
            distance_km(F.col("_prev_lat"), F.col("_prev_lon"), lat, lon, cfg.earth_radius_km),
        ).otherwise(0.0),
        "time_since_last_minutes": F.when(
            F.col("_prev_ts").isNotNull(), seconds / F.lit(60.0)
        ).otherwise(0.0),
        "customer_avg_amount": F.col("_mean"),
        "customer_stddev_amount": F.col("_sd"),
    }).drop(*HELPERS)


def _whole(rows, cfg):
    """Window features with a customer as one group."""
    ordered = Window.partitionBy(CUSTOMER).orderBy("_sec", "timestamp", "transaction_id")
    by_second = Window.partitionBy(CUSTOMER).orderBy("_sec")
    looked_back = rows.withColumns(_history_columns(ordered, cfg))
    return _finish(looked_back.withColumns({
        f"velocity_{h}h": F.count(F.lit(1)).over(by_second.rangeBetween(-3600 * h, 0)) - 1
        for h in cfg.velocity_hours}), cfg)


def _split(rows, cfg):
    """Window features in groups smaller than a customer."""
    one = F.lit(1).cast("long")
    measures = {f"velocity_{h}h": (one, 3600 * h) for h in cfg.velocity_hours}
    measures["_n"] = (one, None)
    counts = skew.sliding_sums(rows, [CUSTOMER], "_sec", measures)

    # Rank of each row: rows in earlier seconds plus the place inside its own second.
    same_second = Window.partitionBy(CUSTOMER, "_sec").orderBy("timestamp", "transaction_id")
    size = F.count(F.lit(1)).over(Window.partitionBy(CUSTOMER, "_sec"))
    ranked = (
        rows.join(counts, [CUSTOMER, "_sec"])
        .withColumn("_rank", F.col("_n") - size + F.row_number().over(same_second) - 1)
        .withColumns({name: F.col(name) - 1 for name in velocity_names(cfg)})
    )

    # A chunk needs the rows ranked up to history_rows before it.
    own = F.floor(F.col("_rank") / cfg.chunk_rows)
    reached = F.floor((F.col("_rank") + cfg.history_rows) / cfg.chunk_rows)
    chunked = ranked.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.sequence(F.col("_own"), reached))
    )
    ordered = Window.partitionBy(CUSTOMER, "_chunk").orderBy("_rank")
    looked_back = chunked.withColumns(_history_columns(ordered, cfg))
    kept = looked_back.filter(F.col("_chunk") == F.col("_own")).drop("_own", "_chunk", "_rank")
    return _finish(kept, cfg)


def _without_customer(df, cfg):
    empty = {name: F.lit(None).cast("long") for name in velocity_names(cfg)}
    for name in ["amount_zscore", "distance_from_last_km", "time_since_last_minutes",
                 "customer_avg_amount", "customer_stddev_amount"]:
        empty[name] = F.lit(None).cast("double")
    return df.withColumns(empty)


def _known():
    return F.col(CUSTOMER).isNotNull() & (F.col(CUSTOMER) != UNKNOWN_CUSTOMER) & F.col("timestamp").isNotNull()


def _columns(df, cfg):
    return [*df.columns, "hour_of_day", "day_of_week", "is_weekend", "merchant_risk_score", *velocity_names(cfg),
            "amount_zscore", "distance_from_last_km", "time_since_last_minutes"]


def clustered_rows(df, name, kept, cfg=FeatureConfig()):
    """``df`` for ``add_features`` in two parts: (name of a stored table, features of the other rows).

    The table holds the columns ``kept`` of the customers of few rows, in buckets of customers, so that
    windows and groups over it need no shuffle; what follows from ``kept`` need not be stored.
    ``clustered_features`` adds the features as they are read.  ``df`` is read several times, as by
    ``add_features``.
    """
    known = _known()
    few, large = skew.apart(df.filter(known), CUSTOMER, min(cfg.whole_rows, cfg.chunk_rows))
    columns = _columns(df, cfg)
    rest = _without_customer(add_row_features(df.filter(~known | known.isNull())), cfg).select(columns)
    if large is not None:
        split = _split(large.withColumn("_sec", F.unix_seconds("timestamp")), cfg)
        rest = add_row_features(split).select(columns).unionByName(rest)
    return store_clustered(few.select(kept), name, CUSTOMER, skew.buckets_for(few)), rest


def clustered_features(rows, cfg=FeatureConfig()):
    """The features of rows in buckets of known customers of few rows each, without a shuffle."""
    windowed = _whole(rows.withColumn("_sec", F.unix_seconds("timestamp")), cfg)
    return add_row_features(windowed).select(_columns(rows, cfg))


def feature_tables(df, name, cfg=FeatureConfig()):
    """The features of ``add_features`` in two parts: (name of a stored table, rows).

    As ``clustered_rows``, with the features of the customers of few rows stored, too.
    """
    table, rest = clustered_rows(df, f"{name}-rows", df.columns, cfg)
    rows = df.sparkSession.table(table)
    return store_clustered(clustered_features(rows, cfg), name, CUSTOMER, skew.buckets_for(rows)), rest


def add_features(df, cfg=FeatureConfig(), keep_statistics=False):
    """All features for rows with timestamp, amount, location, metadata and a hashed customer.

    The input is read three times, once at this call for two columns only (and three times more if it
    holds large customers): give it a table or a projection of one, and store a costly join first
    (``session.store``).
    """
    known = _known()
    windowed = skew.by_size(
        df.filter(known).withColumn("_sec", F.unix_seconds("timestamp")), CUSTOMER,
        min(cfg.whole_rows, cfg.chunk_rows), lambda rows: _whole(rows, cfg), lambda rows: _split(rows, cfg))
    windowed = add_row_features(windowed)
    columns = _columns(df, cfg)
    if keep_statistics:
        columns += ["customer_avg_amount", "customer_stddev_amount"]
    unknown = add_row_features(df.filter(~known | known.isNull()))
    return windowed.select(columns).unionByName(_without_customer(unknown, cfg).select(columns))
