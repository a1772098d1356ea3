"""Quality flags of the ingest path and the medallion projections.

All of these are projections and filters: no shuffle, and simple predicates
still reach the scan.
"""

from pyspark.sql import functions as F

from ledgerwatch.config import QualityConfig
from ledgerwatch.functions.times import hours, moment

FLAGS = ["dq_missing_required", "dq_invalid_amount", "dq_future_timestamp", "dq_invalid_status"]


def _true_only(condition):
    return F.coalesce(condition, F.lit(False))


def missing_required():
    return (
        F.col("transaction_id").isNull()
        | F.col("customer_id").isNull()
        | F.col("amount").isNull()
        | F.col("merchant_id").isNull()
    )


def invalid_amount(cfg):
    amount = F.col("amount")
    return _true_only((amount <= 0) | (amount > F.lit(cfg.flag_max_amount)))


def future_timestamp(cfg, as_of=None):
    return _true_only(F.col("timestamp") > moment(as_of) + hours(cfg.future_tolerance_hours))


def invalid_status(cfg):
    return _true_only(~F.col("status").isin(list(cfg.statuses)))


def late_arrival(cfg, as_of=None):
    return _true_only(F.col("timestamp") < moment(as_of) - hours(cfg.late_after_hours))


def add_quality_flags(df, cfg=QualityConfig(), as_of=None):
    """Four flags, the 0/1 score and the lateness flag."""
    flagged = df.withColumns({
        "dq_missing_required": missing_required(),
        "dq_invalid_amount": invalid_amount(cfg),
        "dq_future_timestamp": future_timestamp(cfg, as_of),
        "dq_invalid_status": invalid_status(cfg),
        "is_late_arrival": late_arrival(cfg, as_of),
    })
    any_flag = F.lit(False)
    for name in FLAGS:
        any_flag = any_flag | F.col(name)
    return flagged.withColumn("data_quality_score", F.when(any_flag, 0.0).otherwise(1.0))


def passing_quality(df, cfg=QualityConfig()):
    """Rows clean enough for silver (strictly above the threshold)."""
    return df.filter(F.col("data_quality_score") > F.lit(cfg.silver_min_score))


def bronze_projection(df):
    """Raw layer: hashed id as the customer, struct and map as JSON text."""
    return df.select(
        "transaction_id", "timestamp", F.col("customer_id_hash").alias("customer_id"),
        "card_number_last4", "card_type", "amount", "currency", "merchant_id", "merchant_name",
        "merchant_category_code", "merchant_category",
        F.to_json("location").alias("location"),
        "channel", "status", "risk_score", "authorization_code", "processor_response_code",
        "is_international", "customer_present", "entry_method",
        F.to_json("metadata").alias("metadata"),
        "created_at", "version",
        "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at",
    )


def silver_projection(df, as_of=None, extra=()):
    """Clean layer: 41 columns, location flattened, one date column to partition by.

    ``extra`` columns are carried along.
    """
    original = (
        F.col("customer_id_original") if "customer_id_original" in df.columns
        else F.lit(None).cast("string")
    )
    return df.select(
        "transaction_id",
        F.to_date("timestamp").alias("transaction_date"),
        F.col("timestamp").alias("transaction_timestamp"),
        "customer_id_hash", original.alias("customer_id_original"),
        "card_number_last4", "card_type", "amount", "currency",
        "merchant_id", "merchant_name", "merchant_category_code", "merchant_category",
        "location.country", "location.state", "location.city", "location.zip_code",
        "location.latitude", "location.longitude",
        "channel", "status", "authorization_code", "processor_response_code",
        "is_international", "customer_present", "entry_method",
        "velocity_1h", "velocity_6h", "velocity_24h", "amount_zscore",
        "distance_from_last_km", "time_since_last_minutes", "merchant_risk_score",
        "is_weekend", "hour_of_day", "day_of_week",
        "is_late_arrival", F.lit(False).alias("is_duplicate"), "data_quality_score",
        moment(as_of).alias("processed_at"), "created_at", *extra,
    )
