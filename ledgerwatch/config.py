"""Thresholds and switches, as small immutable dataclasses."""

from dataclasses import dataclass, field

from ledgerwatch import schema


DEVELOPMENT_SALT = "development-only"


@dataclass(frozen=True)
class QualityConfig:
    # Limits of the quality flags, the row rules and the health report.
    flag_max_amount: float = 50000.0
    range_min_amount: float = 0.01
    range_max_amount: float = 50000.0
    business_min_amount: float = 0.01
    business_max_amount: float = 25000.0
    daily_max_per_customer: float = 10000.0
    future_tolerance_hours: int = 1
    late_after_hours: int = 2
    silver_min_score: float = 0.8
    healthy_pass_rate: float = 0.95
    warning_pass_rate: float = 0.8
    penalty_ceiling: float = 0.2
    trend_step: float = 0.02
    trend_recent_points: int = 10
    history_rows: int = 1000
    statuses: tuple = tuple(schema.STATUSES)
    currencies: tuple = tuple(schema.CURRENCIES)


@dataclass(frozen=True)
class PrivacyConfig:
    # The salt becomes a literal of the plan and so shows in event logs: keep these private.
    salt: str = DEVELOPMENT_SALT
    hash_length: int = 16
    algorithm: str = "hmac"  # or "sha2": sha256(salt + id), 64 hex digits
    masking_enabled: bool = True
    production: bool = False

    def __post_init__(self):
        if self.production and self.salt == DEVELOPMENT_SALT:
            raise ValueError("production needs a salt of its own")


@dataclass(frozen=True)
class FeatureConfig:
    velocity_hours: tuple = (1, 6, 24)
    history_rows: int = 50
    earth_radius_km: float = 6371.0
    # Rows per window group (see operators.features).
    chunk_rows: int = 50_000
    # Customers of up to so many rows (and chunk_rows) are one window group.
    whole_rows: int = 1_000


@dataclass(frozen=True)
class DetectorConfig:
    takeover_minutes: int = 120
    takeover_rows: int = 5
    takeover_amount: float = 500.0
    testing_minutes: int = 30
    testing_rows: int = 10
    testing_amount: float = 5.0
    testing_declined_share: float = 0.5
    attack_rows: int = 20
    travel_speed_kmh: float = 900.0
    travel_min_km: float = 100.0
    probing_rows: int = 5
    probing_gap_minutes: int = 10
    collusion_minutes: int = 60
    collusion_merchants: int = 3
    collusion_spread: float = 100.0
    collusion_categories: tuple = ("RETAIL", "ONLINE", "OTHER")
    identity_hours: int = 12
    identity_rows: int = 3
    identity_amount: float = 1500.0
    bustout_days: int = 30
    bustout_earlier_rows: int = 5
    bustout_recent_rows: int = 3
    bustout_factor: float = 10.0
    velocity_limits: tuple = ((1, 10), (6, 30), (24, 60))
    amount_sigmas: float = 3.0
    distance_km: float = 100.0
    merchant_risk: float = 0.7
    night_hours: tuple = (2, 4)
    risky_countries: tuple = ()
    severity_cuts: tuple = (0.3, 0.6, 0.85)
    # Customers of up to so many rows are one window group (see operators.detect).
    whole_rows: int = 1_000


@dataclass(frozen=True)
class PipelineConfig:
    quality: QualityConfig = field(default_factory=QualityConfig)
    privacy: PrivacyConfig = field(default_factory=PrivacyConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    detectors: DetectorConfig = field(default_factory=DetectorConfig)
