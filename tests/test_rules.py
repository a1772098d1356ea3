import json

import pytest
from pyspark.sql import functions as F

from ledgerwatch.config import QualityConfig
from ledgerwatch.operators import monitor, quality, validate
from ledgerwatch.sources import messages

NOW = "2024-01-30 12:00:00"
GOOD = {
    "transaction_id": "00000000-0000-4000-8000-000000000001", "timestamp": 1706600000000,
    "customer_id": "c", "amount": "150.50", "currency": "USD", "merchant_id": "m",
    "status": "APPROVED",
}


def errors_of(spark, change=None, drop=None):
    message = {**GOOD, **(change or {})}
    message.pop(drop, None)
    df = spark.createDataFrame([(json.dumps(message),)], "value string")
    row = validate.validate_messages(df, as_of=NOW).first()
    assert row["is_valid"] == (len(row["errors"]) == 0)
    return {(e["code"], e["field"]) for e in row["errors"]}, row["has_critical"]


@pytest.mark.parametrize("change, drop, expected, critical", [
    ({}, None, set(), False),
    ({}, "merchant_id", {("REQUIRED_MISSING", "merchant_id")}, True),
    ({"customer_id": None}, None, {("REQUIRED_NULL", "customer_id")}, True),
    ({"customer_id": "   "}, None, {("REQUIRED_EMPTY", "customer_id")}, True),
    ({"amount": 12}, None, {("WRONG_TYPE", "amount")}, False),
    ({"amount": 12.5}, None, set(), False),
    ({"merchant_id": 7}, None, {("WRONG_TYPE", "merchant_id")}, False),
    ({"amount": "abc"}, None, {("NOT_NUMERIC", "amount"), ("AMOUNT_FORMAT", "amount")}, True),
    ({"amount": "30000"}, None, {("AMOUNT_ABOVE_MAX", "amount")}, False),
    ({"amount": "60000"}, None, {("AMOUNT_ABOVE_MAX", "amount"), ("OUT_OF_RANGE", "amount")}, True),
    ({"amount": "0.01"}, None, set(), False),
    ({"amount": "50000", "currency": "EUR"}, None, {("AMOUNT_ABOVE_MAX", "amount")}, False),
    ({"currency": "XYZ"}, None, {("NOT_ALLOWED", "currency")}, False),
    ({"status": "LOST"}, None, {("NOT_ALLOWED", "status")}, False),
    ({"transaction_id": "x"}, None, {("PATTERN_MISMATCH", "transaction_id")}, False),
    ({"timestamp": "2024-01-30T14:00:00Z"}, None, {("TIMESTAMP_FUTURE", "timestamp")}, True),
    ({"timestamp": "2024-01-30T12:59:00+00:00"}, None, set(), False),
    ({"timestamp": "yesterday"}, None, {("TIMESTAMP_FORMAT", "timestamp")}, False),
    ({"amount": "10.5", "currency": "JPY"}, None, {("CURRENCY_DECIMALS", "amount")}, False),
    ({"amount": "10.555"}, None, {("CURRENCY_DECIMALS", "amount")}, False),
])
def test_message_rules(spark, change, drop, expected, critical):
    got = errors_of(spark, change, drop)
    assert got == (expected, critical)


def test_absent_column_is_missing(spark):
    df = spark.createDataFrame([("a",)], "alert_id string")
    row = validate.validate_alerts(df).first()
    assert {e["field"] for e in row["errors"]} == set(validate.ALERT_REQUIRED) - {"alert_id"}


def test_split_valid(spark):
    df = spark.createDataFrame(
        [(json.dumps(GOOD), 1), (json.dumps({**GOOD, "status": "?"}), 2)], "value string, n int")
    valid, invalid = validate.split_valid(validate.validate_messages(df, as_of=NOW), "n")
    assert [r["n"] for r in valid.collect()] == [1]
    assert [r["n"] for r in invalid.collect()] == [2]


def test_flags_on_boundaries(spark):
    df = spark.sql("""SELECT id, 't' AS transaction_id, 'c' AS customer_id, 'm' AS merchant_id,
        CAST(amount AS DECIMAL(10,2)) AS amount, status, CAST(ts AS TIMESTAMP) AS timestamp
        FROM VALUES (1, 50000, 'APPROVED', '2024-01-30 13:00:00'),
                    (2, 50000.01, 'NEW', '2024-01-30 13:00:01'),
                    (3, 0, NULL, '2024-01-30 10:00:00'),
                    (4, NULL, 'DECLINED', '2024-01-30 09:59:59') AS t(id, amount, status, ts)""")
    rows = {r["id"]: r for r in quality.add_quality_flags(df, as_of=NOW).collect()}
    assert [rows[i]["dq_invalid_amount"] for i in (1, 2, 3, 4)] == [False, True, True, False]
    assert [rows[i]["dq_future_timestamp"] for i in (1, 2)] == [False, True]
    assert [rows[i]["dq_invalid_status"] for i in (1, 2, 3)] == [False, True, False]
    assert [rows[i]["is_late_arrival"] for i in (3, 4)] == [False, True]
    assert [rows[i]["data_quality_score"] for i in (1, 2, 3, 4)] == [1.0, 0.0, 0.0, 0.0]


def test_parse_times_places_and_malformed(spark):
    lines = [
        {"transaction_id": "a", "timestamp": 1706600000123, "created_at": 1706600001000,
         "amount": "1.005", "location": {"lat": 1.5, "lon": 2.5}},
        {"transaction_id": "b", "timestamp": "2024-01-30T07:33:20Z", "amount": "5",
         "location": {"latitude": 3, "longitude": 4}},
        {"transaction_id": "c", "created_at": "1706600001000", "amount": "99999999999"},
    ]
    values = [(json.dumps(x), i) for i, x in enumerate(lines)] + [("{broken", 3), ("", 4)]
    df = spark.createDataFrame(values, "value string, kafka_offset long")
    good, bad = messages.split_malformed(messages.parse_messages(df))
    rows = {r["transaction_id"]: r for r in messages.flatten(good).select(
        "transaction_id", F.unix_millis("timestamp").alias("ms"), "amount", "location").collect()}
    assert rows["a"]["ms"] == 1706600000123 and rows["b"]["ms"] == 1706600000000
    assert rows["c"]["ms"] == 1706600001000 and rows["c"]["amount"] is None
    assert (rows["a"]["location"]["latitude"], rows["b"]["location"]["longitude"]) == (1.5, 4.0)
    assert {r["raw"] for r in bad.collect()} == {"{broken", ""}


def test_keyed_messages(spark):
    df = spark.createDataFrame([("k", 1)], "customer_id string, n int")
    assert tuple(messages.as_messages(df, "customer_id", ["n"]).first()) == ("k", '{"n":1}')


def _batches(spark, scores):
    rows = [(f"2024-01-{1 + i // 24:02d} {i % 24:02d}:00:00", s) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "t string, quality_score double")
    return df.withColumn("metric_time", F.col("t").cast("timestamp"))


@pytest.mark.parametrize("scores, trend", [
    ([], "NO_DATA"), ([0.5], "INSUFFICIENT_DATA"), ([0.1, 0.9], "STABLE"),
    ([0.5] * 5 + [0.9] * 10, "IMPROVING"), ([0.9] * 5 + [0.5] * 10, "DEGRADING"),
    ([0.9] * 5 + [0.91] * 10, "STABLE"),
])
def test_trend(spark, scores, trend):
    row = monitor.quality_trend(_batches(spark, scores), 240, as_of="2024-01-02 00:00:00").first()
    assert row["trend"] == trend and row["data_points"] == len(scores)
    assert row["latest_score"] == (scores[-1] if scores else None)


def test_quality_alerts(spark):
    history = _batches(spark, [0.99] * 20 + [0.7])
    found = monitor.quality_alerts(history, as_of="2024-01-01 20:30:00").collect()
    assert [(r["alert_type"], r["severity"]) for r in found] == [
        ("QUALITY_THRESHOLD_BREACH", "HIGH")]
    assert "0.700, wanted 0.95" in found[0]["message"]


def test_score_report_and_empty_batch(spark):
    df = spark.sql("""SELECT * FROM VALUES (true, false), (true, false), (true, false),
        (true, false), (true, false), (false, true), (false, false), (false, false)
        AS t(is_valid, has_critical)""")
    s = monitor.batch_summary(df, seconds=2).first()
    assert (s["batch_size"], s["valid_count"], s["validation_rate"]) == (8, 5, 5 / 8)
    assert s["quality_score"] == 5 / 8 - 1 / 8 and s["rows_per_second"] == 4.0
    report = monitor.health_report(monitor.batch_summary(df)).first()
    assert report["status"] == "CRITICAL" and len(report["recommendations"]) == 5
    empty = monitor.batch_summary(df.limit(0)).first()
    assert (empty["validation_rate"], empty["quality_score"]) == (0.0, 0.0)
    assert monitor.health_report(monitor.batch_summary(df.limit(0))).first()["status"] == "NO_DATA"


def test_history_keeps_the_newest(spark):
    kept = monitor.newest(_batches(spark, [i / 100 for i in range(30)]), 5).collect()
    assert sorted(r["quality_score"] for r in kept) == [0.25, 0.26, 0.27, 0.28, 0.29]
    assert QualityConfig().history_rows == 1000
