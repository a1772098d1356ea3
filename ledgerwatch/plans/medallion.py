"""The batch composition: typed transactions to bronze, silver, alerts and gold."""

from pyspark.sql import functions as F

from ledgerwatch.config import PipelineConfig
from ledgerwatch.functions.privacy import protect_customer
from ledgerwatch.operators import alerts as alert_ops
from ledgerwatch.operators import dedup, detect, features, gold, quality
from ledgerwatch.session import store
from ledgerwatch.sources import tables


def secured(transactions, cfg=PipelineConfig(), as_of=None, hashed=False):
    """Quality flags and hashed customer: projections only."""
    return protect_customer(
        quality.add_quality_flags(transactions, cfg.quality, as_of), cfg.privacy, hashed)


def enriched(transactions, cfg=PipelineConfig(), as_of=None):
    """Secured rows with features.  Windows see all rows; the quality filter comes after."""
    return features.add_features(secured(transactions, cfg, as_of), cfg.features)


def first_of_each(transactions):
    """One row per transaction id, the first by time and origin; rows without an id stay."""
    order = [c for c in ("timestamp", "kafka_partition", "kafka_offset") if c in transactions.columns]
    named = transactions.filter(F.col("transaction_id").isNotNull())
    return dedup.keep_first(named, ["transaction_id"], order).unionByName(
        transactions.filter(F.col("transaction_id").isNull()))


def silver(transactions, cfg=PipelineConfig(), as_of=None):
    """The silver rows; a transaction that arrives twice is one row and counts once."""
    once = first_of_each(transactions)
    passing = quality.passing_quality(enriched(once, cfg, as_of), cfg.quality)
    return quality.silver_projection(passing, as_of)


def refill(silver_rows, transactions, cfg=PipelineConfig(), as_of=None):
    """Stream-written silver rows with the window features of a batch run.

    A late row gets the features the stream could not give it, and rows that
    were written before it arrived now count it.  ``transactions`` are the full
    typed rows of the days in question and of the look-back before them.
    """
    return with_fresh_features(silver_rows, enriched(first_of_each(transactions), cfg, as_of), cfg)


def with_fresh_features(silver_rows, enriched_rows, cfg=PipelineConfig(), few=False):
    """Silver rows with the window features of the enriched rows of the same id; others stay.

    Only ``few`` enriched rows may be broadcast: what they take in the driver is many times what a shuffle measures.
    """
    windowed = ["amount_zscore", "distance_from_last_km", "time_since_last_minutes",
                *features.velocity_names(cfg.features)]
    fresh = enriched_rows.select("transaction_id", *[F.col(c).alias(f"_{c}") for c in windowed])
    fresh = fresh if few else fresh.hint("merge")
    found = silver_rows.join(fresh.withColumn("_found", F.lit(True)), "transaction_id", "left")
    return found.withColumns({
        **{c: F.when(F.col("_found"), F.col(f"_{c}")).otherwise(F.col(c)) for c in windowed},
        "features_complete": F.coalesce("_found", "features_complete"),
    }).select(*silver_rows.columns)


def bronze(transactions, cfg=PipelineConfig(), as_of=None):
    return quality.bronze_projection(secured(transactions, cfg, as_of))


def refresh_daily(spark, table, silver_rows, alerts, touched):
    """Bring the daily summary up to date for the dates of ``touched`` rows only.

    The days are recomputed from silver and upserted by date, so a late row or
    a rerun replaces its day and never counts twice.
    """
    days = store(touched.select("transaction_date").distinct(), "touched-days")  # read with each pass over silver
    rows = silver_rows.join(days, "transaction_date", "left_semi")
    tables.upsert(spark, table, gold.daily_summary(rows, alerts), ["transaction_date"])


def silver_alerts(silver_rows, cfg=PipelineConfig(), as_of=None):
    """Alerts of a silver table: patterns over the whole history, then all rules."""
    rows = silver_rows.withColumnRenamed("transaction_timestamp", "timestamp")
    patterned = detect.add_patterns(rows, cfg.detectors)
    return alert_ops.build_alerts(patterned, cfg.detectors, as_of)
