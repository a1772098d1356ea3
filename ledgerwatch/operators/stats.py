"""Table statistics."""

from pyspark.sql import functions as F


def table_stats(df, customer="customer_id", ts="timestamp", amount="amount", approximate=False):
    """Rows, distinct customers, first and last time, total amount of any transaction table."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        F.count("*").alias("row_count"),
        distinct(F.col(customer)).alias("unique_customers"),
        F.min(ts).alias("earliest_transaction"),
        F.max(ts).alias("latest_transaction"),
        F.sum(amount).alias("total_amount"),
    )
