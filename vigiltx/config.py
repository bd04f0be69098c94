"""Parameters of every stage; the defaults are the monitored programme's values."""

from __future__ import annotations

from dataclasses import dataclass, field

# Units of each currency per US dollar.
RATES = {"USD": 1.00, "PEN": 3.35, "EUR": 0.86, "GBP": 0.74, "JPY": 159.35, "CNY": 6.72}

# Accepted spellings of an event time, tried in this order.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy HH:mm:ss")

# A single cash movement from this amount on has to be declared.
REPORTING_LIMIT = 10_000.0


@dataclass(frozen=True)
class FeatureConfig:
    # Channel patterns.
    cash_channels: str = "(?i)Efectivo|ATM|Cajero|Ventanilla"
    crypto_channels: str = "(?i)Crypto|Exchange|Bridge"
    platform_channels: str = "(?i)Plataforma|Terceros"
    # Stand-ins where a ratio has no denominator.
    nothing_received: float = 999.0
    undeclared_income: float = 1000.0


@dataclass(frozen=True)
class RuleThresholds:
    structuring_sends: tuple[int, int] = (3, 10)
    structuring_max: float = 3000.0
    structuring_total: tuple[float, float] = (8000.0, 10500.0)
    fan_in_received: int = 40
    fan_in_index: float = 0.70
    fan_in_share_sent: float = 0.70
    fan_in_sent_below: float = 10000.0
    crypto_sends: int = 3
    crypto_max: float = 2600.0
    crypto_ratio: float = 0.50
    kyc_ratio: float = 3.0
    kyc_sent_above: float = 5000.0


@dataclass(frozen=True)
class ScoreConfig:
    weight_structuring: float = 40.0
    weight_fan_in: float = 35.0
    weight_crypto: float = 35.0
    weight_kyc: float = 25.0
    rule_cap: float = 100.0
    ml_share: float = 0.50
    rule_share: float = 0.50
    high_from: float = 70.0
    medium_from: float = 40.0
    # Level labels.
    high_label: str = "ALTO RIESGO - ALERTA ROS"
    medium_label: str = "MEDIO RIESGO - MONITOREO"
    low_label: str = "BAJO RIESGO - NORMAL"


@dataclass(frozen=True)
class ModelConfig:
    trees: int = 150
    max_samples: int = 256
    contamination: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class DashboardConfig:
    since: str = "2026-08-01"
    above: float = 5000.0
    # Fixed values: (amount strictly above, label), first match wins.
    rule_bands: tuple[tuple[float, str], ...] = (
        (9500.0, "KYC Deviation"),
        (9000.0, "Structuring (Pitufeo)"),
        (8000.0, "Crypto Mixer"),
        (6000.0, "Fan-In Platform"),
    )
    other_rule: str = "Other Rule"
    red_above: float = 9000.0
    red_label: str = "ALTO RIESGO - ALERTA ROJA"
    watch_label: str = "MEDIO RIESGO - MONITOREO"


@dataclass(frozen=True)
class MonitorConfig:
    features: FeatureConfig = field(default_factory=FeatureConfig)
    rules: RuleThresholds = field(default_factory=RuleThresholds)
    scores: ScoreConfig = field(default_factory=ScoreConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
