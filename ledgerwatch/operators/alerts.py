"""From fired rules to alert rows."""

from pyspark.sql import functions as F

from ledgerwatch import schema
from ledgerwatch.config import DetectorConfig
from ledgerwatch.functions.times import moment
from ledgerwatch.operators.detect import PATTERNS
from ledgerwatch.operators.features import CUSTOMER

# Weights of the risk score (ours; the contract only asks for a value in 0..1).
WEIGHTS = {
    "VELOCITY_ANOMALY": 0.2,
    "AMOUNT_ANOMALY": 0.25,
    "GEOGRAPHIC_ANOMALY": 0.2,
    "MERCHANT_RISK": 0.15,
    "TIME_PATTERN_ANOMALY": 0.1,
    "CROSS_BORDER": 0.1,
    "HIGH_RISK_LOCATION": 0.2,
}
PATTERN_WEIGHT = 0.5
ACTION_BY_SEVERITY = {
    "CRITICAL": "BLOCK", "HIGH": "REQUEST_VERIFICATION", "MEDIUM": "REVIEW", "LOW": "MONITOR",
}


def anomaly_rules(cfg=DetectorConfig()):
    """Rule -> condition; NULL where an input is missing, so "not evaluable" stays visible."""
    velocity = F.lit(False)
    for h, limit in cfg.velocity_limits:
        velocity = velocity | (F.col(f"velocity_{h}h") > limit)
    first, last = cfg.night_hours
    return {
        "VELOCITY_ANOMALY": velocity,
        "AMOUNT_ANOMALY": F.abs("amount_zscore") > cfg.amount_sigmas,
        "GEOGRAPHIC_ANOMALY": F.col("distance_from_last_km") > cfg.distance_km,
        "MERCHANT_RISK": F.col("merchant_risk_score") > cfg.merchant_risk,
        "TIME_PATTERN_ANOMALY": F.col("hour_of_day").between(first, last),
        "CROSS_BORDER": F.col("is_international"),
        "HIGH_RISK_LOCATION": F.col("country").isin(list(cfg.risky_countries))
        if cfg.risky_countries else F.lit(False),
    }


def _flat(df):
    """Country as a column whether the location is still a struct or already flat."""
    return df if "country" in df.columns else df.withColumn("country", F.col("location.country"))


def add_scores(df, cfg=DetectorConfig()):
    """``rules_triggered``, ``alert_types``, ``risk_score``, ``confidence_score``, severity, action.

    Pattern columns are used where present; without them only the row rules count.
    """
    rows = _flat(df)
    rules = anomaly_rules(cfg)
    patterns = [p for p in PATTERNS if p in rows.columns]
    conditions = {**rules, **{p: F.col(p) for p in patterns}}
    fired = {name: F.coalesce(c, F.lit(False)) for name, c in conditions.items()}
    score, evaluable, n_fired = F.lit(0.0), F.lit(0), F.lit(0)
    for name, condition in conditions.items():
        weight = WEIGHTS.get(name, PATTERN_WEIGHT)
        score = score + F.when(fired[name], weight).otherwise(0.0)
        n_fired = n_fired + F.when(fired[name], 1).otherwise(0)
        evaluable = evaluable + F.when(condition.isNotNull(), 1).otherwise(0)
    any_pattern = F.lit(False)
    for p in patterns:
        any_pattern = any_pattern | fired[p]
    types = [F.when(fired[name], name) for name in rules] + [
        F.when(any_pattern, "SUSPICIOUS_PATTERN")
    ]
    low, mid, high = cfg.severity_cuts
    risk = F.col("risk_score")
    severity = (
        F.when(risk >= high, "CRITICAL").when(risk >= mid, "HIGH")
        .when(risk >= low, "MEDIUM").otherwise("LOW")
    )
    action = F.lit(None).cast("string")
    for name, value in ACTION_BY_SEVERITY.items():
        action = F.when(F.col("severity") == name, value).otherwise(action)
    return (
        rows.withColumns({
            "rules_triggered": F.array_compact(
                F.array(*[F.when(f, name) for name, f in fired.items()])),
            "alert_types": F.array_compact(F.array(*types)),
            "risk_score": F.round(F.least(F.lit(1.0), score), 4),
            "confidence_score": F.round(n_fired / F.greatest(evaluable, F.lit(1)), 4),
        })
        .withColumn("severity", severity)
        .withColumn("recommended_action", action)
    )


def build_alerts(df, cfg=DetectorConfig(), as_of=None, ts="timestamp"):
    """One alert per transaction and alert type.

    The id is a digest of the two, so a rerun writes the same alerts again.
    """
    now = moment(as_of)
    scored = add_scores(df, cfg).filter(F.size("alert_types") > 0)
    alert = scored.withColumn("alert_type", F.explode("alert_types")).select(
        F.sha2(F.concat_ws("|", "transaction_id", "alert_type"), 256).alias("alert_id"),
        "transaction_id",
        F.col(CUSTOMER),
        now.alias("alert_timestamp"),
        "alert_type", "severity", "risk_score", "confidence_score",
        F.struct(
            F.col("velocity_1h").cast("int").alias("velocity_1h"),
            F.col("velocity_6h").cast("int").alias("velocity_6h"),
            F.col("velocity_24h").cast("int").alias("velocity_24h"),
            "amount_zscore", "distance_from_last_km", "time_since_last_minutes",
            "merchant_risk_score", "hour_of_day",
            (F.weekday(ts) + 1).alias("day_of_week"),  # 1 = Monday in the alert contract
            "is_weekend",
        ).alias("features"),
        F.struct(
            "amount", "currency", "merchant_category",
            F.col("country").alias("location_country"), "channel",
        ).alias("transaction_summary"),
        "rules_triggered", "recommended_action",
        F.lit(None).cast("string").alias("investigator_assigned"),
        F.lit("OPEN").alias("status"),
        F.create_map().cast("map<string,string>").alias("metadata"),
        now.alias("created_at"),
        F.lit("1.0").alias("version"),
    )
    return alert.select(*[F.col(f.name).cast(f.dataType) for f in schema.ALERT.fields])


def with_alert_flag(transactions, alerts):
    """Transactions with ``has_alert``; each transaction once however many alerts it has."""
    ids = alerts.select("transaction_id").distinct().withColumn("_hit", F.lit(True))
    return (
        transactions.join(ids, "transaction_id", "left")
        .withColumn("has_alert", F.coalesce("_hit", F.lit(False))).drop("_hit")
    )


def alerted(transactions, alerts):
    """Only the transactions that have an alert."""
    return transactions.join(alerts.select("transaction_id"), "transaction_id", "left_semi")
