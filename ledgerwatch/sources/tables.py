"""Tables: medallion layout, bulk load, upsert, audited export, SQL over views."""

from functools import reduce

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from ledgerwatch import schema
from ledgerwatch.session import fresh_dir

LAYERS = ("bronze", "silver", "gold")
WRITE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}

MONEY = "DECIMAL(18,2)"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"

# Columns of the gold tables.
GOLD_DAILY = f"""
    transaction_date DATE, total_transactions BIGINT, total_amount {MONEY},
    approved_transactions BIGINT, approved_amount {MONEY}, declined_transactions BIGINT,
    declined_amount {MONEY}, fraud_alerts BIGINT, high_risk_transactions BIGINT,
    unique_customers BIGINT, unique_merchants BIGINT, international_transactions BIGINT,
    international_amount {MONEY}, avg_transaction_amount DOUBLE,
    median_transaction_amount DOUBLE, max_transaction_amount DECIMAL(10,2),
    created_at TIMESTAMP, updated_at TIMESTAMP
"""
GOLD_CUSTOMERS = f"""
    customer_id_hash STRING, analysis_date DATE, total_transactions BIGINT,
    total_amount {MONEY}, avg_transaction_amount DOUBLE,
    preferred_merchant_categories ARRAY<STRING>, preferred_channels ARRAY<STRING>,
    typical_transaction_hours ARRAY<STRING>, home_country STRING, home_state STRING,
    home_city STRING, international_transaction_pct DOUBLE, weekend_transaction_pct DOUBLE,
    risk_profile STRING, fraud_score DOUBLE, last_transaction_date DATE,
    created_at TIMESTAMP, updated_at TIMESTAMP
"""
GOLD_MERCHANTS = f"""
    merchant_id STRING, merchant_name STRING, merchant_category STRING, analysis_date DATE,
    total_transactions BIGINT, total_amount {MONEY}, unique_customers BIGINT,
    avg_transaction_amount DOUBLE, decline_rate DOUBLE, fraud_rate DOUBLE, risk_score DOUBLE,
    country STRING, state STRING, city STRING, created_at TIMESTAMP, updated_at TIMESTAMP
"""


def _columns(struct, extra=""):
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct.fields)
    return body + extra


def medallion_tables():
    """Table name -> (column DDL, partition column)."""
    day = ", `ingest_date` DATE"
    return {
        "bronze.transactions_raw": (_columns(schema.BRONZE, day), "ingest_date"),
        "silver.transactions_clean": (_columns(schema.SILVER), "transaction_date"),
        "silver.fraud_alerts": (
            _columns(schema.ALERT, ", `updated_at` TIMESTAMP, `alert_date` DATE"), "alert_date"),
        "gold.daily_transaction_summary": (GOLD_DAILY, None),
        "gold.customer_transaction_patterns": (GOLD_CUSTOMERS, None),
        "gold.merchant_analytics": (GOLD_MERCHANTS, None),
    }


def create_medallion(spark, prefix="", location=None):
    """Create the three schemas and six tables where they do not exist."""
    for layer in LAYERS:
        at = f" LOCATION '{location}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}`{at}")
    names = []
    for name, (columns, partition) in medallion_tables().items():
        by = f" PARTITIONED BY ({partition})" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{name} ({columns}) USING parquet{by}")
        names.append(prefix + name)
    return names


def clustered(df, date_column, *sort_columns):
    """Rows laid out for pruning: partitioned by date, sorted inside each task.

    A date may hold any share of the rows, so it is spread over tasks by the
    sort columns too; AQE then coalesces or splits by size (rebalance).
    """
    return df.hint("rebalance", date_column, *sort_columns).sortWithinPartitions(
        date_column, *sort_columns)


def bulk_load(df, table, mode="append", rows_per_file=0):
    """Load into a catalog table: append, replace, or fail if it exists."""
    writer = df.write.mode(WRITE_MODES[mode])
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.saveAsTable(table)


def merge_frames(target, source, keys, update_columns=None, now=None):
    """The target after an upsert: matched rows updated, new rows added.

    ``update_columns`` defaults to every non-key column.  ``updated_at`` is set
    on updated rows if the target has it.  One full outer join on the keys.  A
    key that the source holds twice ends the job: which row wins is undefined.
    """
    rest = [c for c in target.columns if c not in keys]
    updated = rest if update_columns is None else list(update_columns)
    copies = F.count("*").over(Window.partitionBy(*keys))
    once = F.when(copies > 1, F.raise_error(F.lit(
        f"the source of an upsert holds a key more than once: {', '.join(keys)}"))).otherwise(True)
    t, s = target.withColumn("_t", F.lit(True)), source.withColumn("_s", once.cast("boolean"))
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    in_target, in_source = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    stamp = F.current_timestamp() if now is None else now

    def value(c):
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}") if c in source.columns else F.lit(None)
        if c == "updated_at" and c not in (update_columns or []):
            return F.when(in_target & in_source, stamp).when(in_target, old).otherwise(
                F.coalesce(new, stamp))
        if c in updated and c in source.columns:
            return F.when(in_source, new).otherwise(old)
        return F.when(in_target, old).otherwise(new)

    return t.alias("t").join(s.alias("s"), on, "full_outer").select(
        *[F.coalesce(f"t.{k}", f"s.{k}").alias(k) for k in keys],
        *[value(c).alias(c) for c in rest],
    ).select(*target.columns)


def upsert(spark, table, source, keys, update_columns=None, partition=None):
    """Upsert a frame into a Parquet table.

    With ``partition`` only partitions the source touches are read and
    rewritten, provided a key never moves between partitions.  The result is
    written aside before the table is overwritten, because a Parquet table
    cannot be read and replaced in one job.
    """
    target = spark.table(table)
    if partition:
        touched = source.select(partition).distinct()
        target = target.join(touched, partition, "left_semi").select(*target.columns)
    merged = merge_frames(target, source, keys, update_columns)
    aside = fresh_dir(spark, "upsert")
    merged.write.parquet(aside)
    # insertInto takes the overwrite mode from the session only, not from a writer option; a
    # session of its own shares the tables and leaves concurrent writes alone
    own = spark.newSession()
    own.conf.set(OVERWRITE_MODE, "dynamic" if partition else "static")
    (own.read.schema(merged.schema).parquet(aside)
     .write.mode("overwrite").insertInto(table))
    spark.catalog.refreshTable(table)


def export(df, path_or_table, user, audit_table, as_table=False, mode="append"):
    """Write a frame and append one audit row; the count is observed during the write."""
    spark = df.sparkSession
    seen = Observation("export")
    writer = df.observe(seen, F.count(F.lit(1)).alias("row_count")).write.mode(mode)
    if as_table:
        writer.saveAsTable(path_or_table)
    else:
        writer.parquet(path_or_table)
    audit = spark.range(1).select(
        F.current_timestamp().alias("event_time"),
        F.lit(user).alias("user_id"),
        F.lit(path_or_table).alias("table_name"),
        F.lit(seen.get["row_count"]).cast("long").alias("row_count"),
        F.lit("DATA_EXPORT").alias("event_type"),
    )
    audit.write.mode("append").saveAsTable(audit_table)
    return audit


def run_sql(spark, query, params=None, **frames):
    """Run SQL with bound parameters over temporary views of the given frames."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(query, args=params) if params else spark.sql(query)
