"""ANSI SQL twins of the catalogue, for DuckDB over the same tables.

Built from shared CTE fragments: the stand-in transactions, features, patterns
and alerts are each written once.
"""

from ledgerwatch.config import DetectorConfig, PrivacyConfig, QualityConfig
from ledgerwatch.operators.alerts import PATTERN_WEIGHT, WEIGHTS
from ledgerwatch.operators.detect import PATTERNS as DETECTED
from ledgerwatch.plans.standins import AS_OF, COUNTRIES, PATTERNS
from ledgerwatch import schema

NOW = f"TIMESTAMP '{AS_OF}'"
Q = QualityConfig()
SALT = PrivacyConfig().salt


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def hmac_sql(c, salt=SALT, length=16):
    key = salt.encode().ljust(64, b"\0")
    blob = lambda pad: "'" + "".join(f"\\x{b ^ pad:02X}" for b in key) + "'::BLOB"
    inner = f"unhex(sha256({blob(0x36)} || encode({c})))"
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'UNKNOWN' "
            f"ELSE substr(sha256({blob(0x5C)} || {inner}), 1, {length}) END")


def sha2_sql(c, salt=SALT):
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'UNKNOWN' ELSE sha256('{salt}' || {c}) END"


BASE_EVENTS = f"""
raw_e AS (
  SELECT *, event_id AS e, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(value AS DECIMAL(12,2)) AS v
  FROM events
),
txn AS (
  SELECT e,
    CASE WHEN e % 89 = 0 THEN 'txn-' || e
         ELSE '00000000-0000-4000-8000-' || lpad(lower(to_hex(e)), 12, '0') END AS transaction_id,
    ts, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
    CASE WHEN e % 211 = 0 THEN NULL WHEN e % 223 = 0 THEN '' ELSE 'cust_' || user_id END
      AS customer_id,
    lpad(CAST(e % 10000 AS VARCHAR), 4, '0') AS card_number_last4,
    {_list(schema.CARD_TYPES)}[e % 3 + 1] AS card_type,
    CAST(CASE WHEN e % 97 = 0 THEN -v WHEN e % 101 = 0 THEN v * 1000 WHEN e % 103 = 0 THEN NULL
         ELSE v END AS DECIMAL(10,2)) AS amount,
    CASE WHEN e % 109 = 0 THEN 'XXX' WHEN e % 113 = 0 THEN 'usd'
         ELSE {_list(schema.CURRENCIES)}[k % 5 + 1] END AS currency,
    'merch_' || k AS merchant_id,
    '<Shop> "' || k || '" & Son''s' AS merchant_name,
    lpad(CAST(k + 5000 AS VARCHAR), 4, '0') AS merchant_category_code,
    {_list(schema.MERCHANT_CATEGORIES)}[k % 15 + 1] AS merchant_category,
    {_list(COUNTRIES)}[k % 5 + 1] AS country, 'S' || (k % 7) AS state,
    'City' || (k % 20) AS city, lpad(CAST(k * 37 AS VARCHAR), 5, '0') AS zip_code,
    CAST((k * 7) % 120 - 60 AS DOUBLE) AS latitude,
    CAST((k * 13) % 360 - 180 AS DOUBLE) AS longitude,
    {_list(schema.CHANNELS)}[e % 5 + 1] AS channel,
    CASE WHEN e % 127 = 0 THEN 'LOST' WHEN event_type = 'purchase' THEN 'APPROVED'
         WHEN event_type = 'error' THEN 'DECLINED' WHEN event_type = 'view' THEN 'PENDING'
         WHEN event_type = 'click' THEN 'CANCELLED' ELSE 'REFUNDED' END AS status,
    CAST(e % 100 AS DOUBLE) / 100 AS risk_score,
    'AUTH' || e AS authorization_code,
    CASE WHEN event_type = 'error' THEN '05' ELSE '00' END AS processor_response_code,
    k % 10 = 0 AS is_international, e % 4 <> 0 AS customer_present,
    {_list(schema.ENTRY_METHODS)}[e % 5 + 1] AS entry_method,
    CASE WHEN k % 7 = 0 THEN '0.9' WHEN k % 7 = 1 THEN 'n/a' END AS m_risk,
    'user.' || user_id || '@mail.shop.com' AS m_email,
    '415-555-' || lpad(CAST(e % 10000 AS VARCHAR), 4, '0') AS m_phone,
    CASE WHEN e % 50 = 0 THEN {_list(PATTERNS)}[(e // 50) % 8 + 1] END AS m_fraud,
    ts + INTERVAL 1 SECOND AS created_at, e % 6 AS kafka_partition, event_type, user_id
  FROM raw_e
)"""

BASE_ORDERS = f"""
txn AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
           || CAST(l_quantity AS INTEGER) AS transaction_id,
    o_orderdate + INTERVAL 9 HOUR + to_minutes(l_linenumber * 8) AS ts,
    CAST(floor(epoch(o_orderdate + INTERVAL 9 HOUR + to_minutes(l_linenumber * 8))) AS BIGINT)
      AS sec,
    'cust_' || o_custkey AS customer_id,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, 'USD' AS currency,
    'merch_' || l_suppkey AS merchant_id, 'Store ' || l_suppkey AS merchant_name,
    {_list(schema.MERCHANT_CATEGORIES)}[l_partkey % 15 + 1] AS merchant_category,
    'N' || c_nationkey AS country, c_mktsegment AS state, 'City' || (l_suppkey % 20) AS city,
    CAST((l_suppkey * 7) % 120 - 60 AS DOUBLE) AS latitude,
    CAST((l_suppkey * 13) % 360 - 180 AS DOUBLE) AS longitude,
    {_list(schema.CHANNELS)}[l_linenumber % 5 + 1] AS channel,
    CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' WHEN l_returnflag = 'A' THEN 'APPROVED'
         WHEN l_linestatus = 'O' THEN 'DECLINED' ELSE 'PENDING' END AS status,
    l_partkey % 4 = 0 AS is_international, l_suppkey % 3 = 0 AS customer_present,
    CAST(NULL AS VARCHAR) AS m_risk
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey
)"""

FLAGS = f"""
flagged AS (
  SELECT *,
    transaction_id IS NULL OR customer_id IS NULL OR amount IS NULL OR merchant_id IS NULL
      AS dq_missing_required,
    coalesce(amount <= 0 OR amount > {Q.flag_max_amount}, false) AS dq_invalid_amount,
    coalesce(ts > {NOW} + INTERVAL {Q.future_tolerance_hours} HOUR, false) AS dq_future_timestamp,
    coalesce(status NOT IN {_in(Q.statuses)}, false) AS dq_invalid_status,
    coalesce(ts < {NOW} - INTERVAL {Q.late_after_hours} HOUR, false) AS is_late_arrival
  FROM txn
),
scored AS (
  SELECT *, CASE WHEN dq_missing_required OR dq_invalid_amount OR dq_future_timestamp
                      OR dq_invalid_status THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
            AS data_quality_score
  FROM flagged
)"""


def haversine_sql(lat1, lon1, lat2, lon2):
    half_lat, half_lon = f"(radians({lat2} - {lat1}) / 2)", f"(radians({lon2} - {lon1}) / 2)"
    h = (f"sin({half_lat}) * sin({half_lat}) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* sin({half_lon}) * sin({half_lon})")
    return f"12742.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, {h})))"


FEATURES = f"""
looked AS (
  SELECT *, customer_id IS NOT NULL AND customer_id <> '' AS known,
    count(*) OVER (v RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) - 1 AS v1,
    count(*) OVER (v RANGE BETWEEN 21600 PRECEDING AND CURRENT ROW) - 1 AS v6,
    count(*) OVER (v RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) - 1 AS v24,
    CAST(sum(amount) OVER (o ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS DOUBLE)
      / count(amount) OVER (o ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS mean,
    stddev_samp(CAST(amount AS DOUBLE)) OVER (o ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS sd,
    lag(latitude) OVER o AS prev_lat, lag(longitude) OVER o AS prev_lon, lag(sec) OVER o AS prev_sec
  FROM scored
  WINDOW v AS (PARTITION BY customer_id ORDER BY sec),
         o AS (PARTITION BY customer_id ORDER BY sec, ts, transaction_id)
),
feat AS (
  SELECT *,
    CASE WHEN known THEN v1 END AS velocity_1h, CASE WHEN known THEN v6 END AS velocity_6h,
    CASE WHEN known THEN v24 END AS velocity_24h,
    CASE WHEN known THEN mean END AS customer_avg_amount,
    CASE WHEN known THEN sd END AS customer_stddev_amount,
    CASE WHEN NOT known THEN NULL
         WHEN sd > 0 THEN (CAST(amount AS DOUBLE) - mean) / sd ELSE 0.0 END AS amount_zscore,
    CASE WHEN NOT known THEN NULL WHEN prev_lat IS NOT NULL AND prev_lon IS NOT NULL
              AND latitude IS NOT NULL AND longitude IS NOT NULL
         THEN {haversine_sql('prev_lat', 'prev_lon', 'latitude', 'longitude')} ELSE 0.0 END
      AS distance_from_last_km,
    CASE WHEN NOT known THEN NULL WHEN prev_sec IS NOT NULL
         THEN CAST(sec - prev_sec AS DOUBLE) / 60.0::DOUBLE ELSE 0.0 END
      AS time_since_last_minutes,
    CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
    dayofweek(ts) IN (0, 6) AS is_weekend,
    coalesce(TRY_CAST(m_risk AS DOUBLE),
      CASE merchant_category WHEN 'ONLINE' THEN 0.4 WHEN 'OTHER' THEN 0.35
           WHEN 'ENTERTAINMENT' THEN 0.3 ELSE 0.2 END)::DOUBLE AS merchant_risk_score
  FROM looked
)"""


def patterns_sql(c=DetectorConfig()):
    month = c.bustout_days * 86400
    steps = c.probing_rows - 1
    risky = (f"(coalesce(merchant_category IN {_in(c.collusion_categories)}, false) "
             "AND merchant_id IS NOT NULL AND amount IS NOT NULL)")
    span = lambda s: f"(c RANGE BETWEEN {s} PRECEDING AND CURRENT ROW)"
    hour = span(c.collusion_minutes * 60)
    return f"""
traits AS (
  SELECT *,
    coalesce(amount >= {c.takeover_amount} AND NOT customer_present
      AND (is_international OR distance_from_last_km > {c.distance_km}), false) AS takeover,
    coalesce(amount < {c.testing_amount}, false) AS small,
    coalesce(amount < {c.testing_amount} AND status = 'DECLINED', false) AS small_declined,
    {risky} AS risky, coalesce(amount >= {c.identity_amount}, false) AS large,
    CASE WHEN amount > lag(amount) OVER m AND sec - lag(sec) OVER m
              <= {c.probing_gap_minutes * 60} THEN 1 ELSE 0 END AS rises
  FROM feat
  WINDOW m AS (PARTITION BY customer_id, merchant_id ORDER BY sec, ts, transaction_id)
),
windows AS (
  SELECT *,
    sum(takeover::INT) OVER {span(c.takeover_minutes * 60)} AS n_takeover,
    sum(small::INT) OVER {span(c.testing_minutes * 60)} AS n_small,
    sum(small_declined::INT) OVER {span(c.testing_minutes * 60)} AS n_small_declined,
    sum(large::INT) OVER {span(c.identity_hours * 3600)} AS n_large,
    count(amount) OVER {span(86400)} AS n_day, count(amount) OVER {span(month)} AS n_month,
    coalesce(sum(amount) OVER {span(86400)}, 0) AS sum_day,
    coalesce(sum(amount) OVER {span(month)}, 0) AS sum_month,
    min(sec) OVER (PARTITION BY customer_id) AS first_sec,
    count(DISTINCT CASE WHEN risky THEN merchant_id END) OVER {hour} AS merchants,
    max(CASE WHEN risky THEN amount END) OVER {hour} AS max_amount,
    min(CASE WHEN risky THEN amount END) OVER {hour} AS min_amount,
    sum(rises) OVER (m ROWS BETWEEN {steps - 1} PRECEDING AND CURRENT ROW) AS run
  FROM traits
  WINDOW c AS (PARTITION BY customer_id ORDER BY sec),
         m AS (PARTITION BY customer_id, merchant_id ORDER BY sec, ts, transaction_id)
),
pat AS (
  SELECT *,
    known AND takeover AND n_takeover >= {c.takeover_rows} AS account_takeover,
    known AND small AND n_small >= {c.testing_rows}
      AND CAST(n_small_declined AS DOUBLE) / n_small >= {c.testing_declined_share} AS card_testing,
    known AND coalesce(velocity_1h + 1 >= {c.attack_rows}, false) AS velocity_attack,
    known AND coalesce(distance_from_last_km > {c.travel_min_km} AND distance_from_last_km
      > {c.travel_speed_kmh} * (time_since_last_minutes / 60), false) AS impossible_travel,
    known AND run = {steps} AS amount_probing,
    known AND risky AND merchants >= {c.collusion_merchants}
      AND coalesce(max_amount - min_amount <= {c.collusion_spread}, false) AS merchant_collusion,
    known AND large AND sec <= first_sec + {c.identity_hours * 3600}
      AND n_large >= {c.identity_rows} AS synthetic_identity,
    known AND n_month - n_day >= {c.bustout_earlier_rows} AND n_day >= {c.bustout_recent_rows}
      AND CAST(sum_day AS DOUBLE) * (n_month - n_day) >= {c.bustout_factor}::DOUBLE
          * CAST(sum_month - sum_day AS DOUBLE) * n_day AS bust_out
  FROM windows
)"""


def rules_sql(c=DetectorConfig()):
    velocity = " OR ".join(f"velocity_{h}h > {limit}" for h, limit in c.velocity_limits)
    first, last = c.night_hours
    return {
        "VELOCITY_ANOMALY": f"({velocity})",
        "AMOUNT_ANOMALY": f"abs(amount_zscore) > {c.amount_sigmas}",
        "GEOGRAPHIC_ANOMALY": f"distance_from_last_km > {c.distance_km}",
        "MERCHANT_RISK": f"merchant_risk_score > {c.merchant_risk}",
        "TIME_PATTERN_ANOMALY": f"hour_of_day BETWEEN {first} AND {last}",
        "CROSS_BORDER": "is_international",
        "HIGH_RISK_LOCATION": f"country IN {_in(c.risky_countries)}" if c.risky_countries
        else "false",
    }


def alerts_sql(c=DetectorConfig(), source="pat", patterns=DETECTED):
    """CTEs ``rated`` (scores per row) and ``alert`` (one row per transaction and type)."""
    rules = rules_sql(c)
    conditions = {**rules, **{p: p for p in patterns}}
    score = " + ".join(
        f"CASE WHEN {x} THEN {WEIGHTS.get(n, PATTERN_WEIGHT)}::DOUBLE ELSE 0.0::DOUBLE END"
        for n, x in conditions.items())
    fired = " + ".join(f"CASE WHEN {x} THEN 1 ELSE 0 END" for x in conditions.values())
    evaluable = " + ".join(f"CASE WHEN ({x}) IS NOT NULL THEN 1 ELSE 0 END"
                           for x in conditions.values())
    triggered = ", ".join(f"CASE WHEN {x} THEN '{n}' END" for n, x in conditions.items())
    any_pattern = " OR ".join(patterns) or "false"
    types = ", ".join([f"CASE WHEN {x} THEN '{n}' END" for n, x in rules.items()]
                      + [f"CASE WHEN {any_pattern} THEN 'SUSPICIOUS_PATTERN' END"])
    low, mid, high = c.severity_cuts
    return f"""
rated AS (
  SELECT * EXCLUDE (s), CASE WHEN alert_risk >= {high} THEN 'CRITICAL'
       WHEN alert_risk >= {mid} THEN 'HIGH' WHEN alert_risk >= {low} THEN 'MEDIUM' ELSE 'LOW' END
       AS severity
  FROM (
    SELECT *, round(least(1.0::DOUBLE, s), 4) AS alert_risk FROM (
      SELECT *, 0.0::DOUBLE + {score} AS s,
        round(CAST({fired} AS DOUBLE) / greatest({evaluable}, 1), 4) AS confidence,
        array_to_string(list_filter([{triggered}], lambda x: x IS NOT NULL), ',') AS rules_triggered,
        list_filter([{types}], lambda x: x IS NOT NULL) AS alert_types
      FROM {source}))
),
alert AS (
  SELECT *, unnest(alert_types) AS alert_type,
    CASE severity WHEN 'CRITICAL' THEN 'BLOCK' WHEN 'HIGH' THEN 'REQUEST_VERIFICATION'
         WHEN 'MEDIUM' THEN 'REVIEW' ELSE 'MONITOR' END AS recommended_action
  FROM rated
)"""


def with_ctes(*parts, select):
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select
