"""A cross-section of the catalogue against its SQL twins; ``compare.py`` runs all of it."""

import pytest

import compare
from ledgerwatch.plans import catalog

SF = "/root/testdata/sf0.001"
CHOSEN = [
    "parse_messages", "validated_messages", "error_frequencies", "health_report",
    "bronze_table", "silver_table", "customer_features_split_path", "flag_duplicates",
    "masked_records", "mask_address", "upsert_all_columns", "detect_bust_out",
    "detect_all_split_path", "risk_scores", "alert_rows", "daily_summary", "customer_patterns",
    "merchant_analytics", "labelled_fraud", "stream_alerts",
]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, name):
    left = compare.spark_result(catalog.QUERIES[name](spark, SF))
    right = compare.duck_result(compare.duck(SF), catalog.SQL[name])
    assert compare.difference(left, right) is None and left[1]


def test_events_of_one_row_group_are_worked_on_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F
    from ledgerwatch.plans import standins

    spark.range(60_000).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", "id % 50 AS user_id", "'view' AS event_type",
        "CAST(id % 90 AS DOUBLE) AS value", "'{\"k\": 3}' AS props").coalesce(1).write.parquet(
            str(tmp_path / "events.parquet"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        rows = standins.txn_events(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
        assert rows.select("task").distinct().count() > 1
        log = standins.message_log(spark, str(tmp_path)).withColumn("file", F.col("_metadata.file_name"))
        assert log.select("file").distinct().count() > 1 and log.count() == 60_000
    finally:
        spark.conf.set(merge, "true")


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.SQL)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 964 and len(df.columns) == 41
    assert set(entry.queries()) >= set(entry.oracle_sql())
