"""Schemas and enumerations of the transaction and alert contracts."""

from functools import lru_cache

from pyspark.sql import types as T

# Enumerations of the event contract.
CARD_TYPES = ["CREDIT", "DEBIT", "PREPAID"]
MERCHANT_CATEGORIES = [
    "GROCERY", "GAS_STATION", "RESTAURANT", "RETAIL", "ONLINE",
    "ATM", "HOTEL", "AIRLINE", "PHARMACY", "AUTOMOTIVE",
    "ENTERTAINMENT", "HEALTHCARE", "EDUCATION", "UTILITIES", "OTHER",
]
CHANNELS = ["ONLINE", "POS", "ATM", "MOBILE", "PHONE"]
STATUSES = ["PENDING", "APPROVED", "DECLINED", "CANCELLED", "REFUNDED"]
ENTRY_METHODS = ["CHIP", "SWIPE", "CONTACTLESS", "MANUAL", "ONLINE"]
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "JPY"]

# Enumerations of the alert contract.
ALERT_TYPES = [
    "VELOCITY_ANOMALY", "AMOUNT_ANOMALY", "GEOGRAPHIC_ANOMALY", "MERCHANT_RISK",
    "TIME_PATTERN_ANOMALY", "CROSS_BORDER", "HIGH_RISK_LOCATION", "SUSPICIOUS_PATTERN",
]
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
ACTIONS = ["MONITOR", "REVIEW", "BLOCK", "DECLINE", "REQUEST_VERIFICATION"]
ALERT_STATUSES = ["OPEN", "IN_REVIEW", "RESOLVED", "FALSE_POSITIVE", "CONFIRMED_FRAUD"]

UNKNOWN_CUSTOMER = "UNKNOWN"

LOCATION_DDL = (
    "country string, state string, city string, zip_code string, latitude double, longitude double"
)

# What a message carries.  Times stay text because producers send either epoch
# milliseconds or ISO text; coordinates come under either spelling.
WIRE_DDL = (
    """
    transaction_id string, timestamp string, customer_id string, card_number string,
    card_number_last4 string, card_type string, amount decimal(10,2), currency string,
    merchant_id string, merchant_name string, merchant_category_code string,
    merchant_category string,
    location struct<country: string, state: string, city: string, zip_code: string,
                    latitude: double, longitude: double, lat: double, lon: double>,
    channel string, status string, risk_score double, authorization_code string,
    processor_response_code string, is_international boolean, customer_present boolean,
    entry_method string, metadata map<string,string>, created_at string, version string
    """
)

# A parsed transaction.
TRANSACTION_DDL = (
    """
    transaction_id string, timestamp timestamp, customer_id string,
    card_number_last4 string, card_type string, amount decimal(10,2), currency string,
    merchant_id string, merchant_name string, merchant_category_code string,
    merchant_category string,
    location struct<country: string, state: string, city: string, zip_code: string,
                    latitude: double, longitude: double>,
    channel string, status string, risk_score double, authorization_code string,
    processor_response_code string, is_international boolean, customer_present boolean,
    entry_method string, metadata map<string,string>, created_at timestamp, version string
    """
)

# Where a message came from.
MESSAGE_ORIGIN_DDL = (
    "kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, "
    "ingested_at timestamp"
)

BRONZE_DDL = (
    """
    transaction_id string, timestamp timestamp, customer_id string, card_number_last4 string,
    card_type string, amount decimal(10,2), currency string, merchant_id string,
    merchant_name string, merchant_category_code string, merchant_category string,
    location string, channel string, status string, risk_score double,
    authorization_code string, processor_response_code string, is_international boolean,
    customer_present boolean, entry_method string, metadata string, created_at timestamp,
    version string, kafka_topic string, kafka_partition int, kafka_offset long,
    kafka_timestamp timestamp, ingested_at timestamp
    """
)

SILVER_DDL = (
    """
    transaction_id string, transaction_date date, transaction_timestamp timestamp,
    customer_id_hash string, customer_id_original string, card_number_last4 string,
    card_type string, amount decimal(10,2), currency string, merchant_id string,
    merchant_name string, merchant_category_code string, merchant_category string,
    country string, state string, city string, zip_code string, latitude double,
    longitude double, channel string, status string, authorization_code string,
    processor_response_code string, is_international boolean, customer_present boolean,
    entry_method string, velocity_1h long, velocity_6h long, velocity_24h long,
    amount_zscore double, distance_from_last_km double, time_since_last_minutes double,
    merchant_risk_score double, is_weekend boolean, hour_of_day int, day_of_week int,
    is_late_arrival boolean, is_duplicate boolean, data_quality_score double,
    processed_at timestamp, created_at timestamp
    """
)

ALERT_DDL = (
    """
    alert_id string, transaction_id string, customer_id_hash string, alert_timestamp timestamp,
    alert_type string, severity string, risk_score double, confidence_score double,
    features struct<velocity_1h: int, velocity_6h: int, velocity_24h: int,
                    amount_zscore: double, distance_from_last_km: double,
                    time_since_last_minutes: double, merchant_risk_score: double,
                    hour_of_day: int, day_of_week: int, is_weekend: boolean>,
    transaction_summary struct<amount: decimal(10,2), currency: string,
                               merchant_category: string, location_country: string,
                               channel: string>,
    rules_triggered array<string>, recommended_action string, investigator_assigned string,
    status string, metadata map<string,string>, created_at timestamp, version string
    """
)


@lru_cache
def _struct(ddl):
    return T.StructType.fromDDL(ddl)


def __getattr__(name):
    """``schema.SILVER`` and friends: the struct of ``SILVER_DDL``, parsed once a session exists."""
    ddl = globals().get(f"{name}_DDL")
    if ddl is None:
        raise AttributeError(name)
    return _struct(ddl)
