"""Options of the operators, with the defaults every job starts from."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace


@dataclass(frozen=True)
class Topics:
    input: str = "user-behavior-events"
    recommendations: str = "recommendations"
    fraud_alerts: str = "fraud-alerts"
    metrics: str = "processing-metrics"


@dataclass(frozen=True)
class Broker:
    bootstrap_servers: str = "localhost:9092"
    consumer_group: str = "flink-recommendation-group"
    max_records_per_trigger: int = 5_000_000
    topics: Topics = field(default_factory=Topics)


@dataclass(frozen=True)
class Processing:
    allowed_lateness_seconds: int = 300
    max_delay_seconds: int = 1800
    watermark_delay_seconds: int = 5
    window_size_minutes: int = 10


@dataclass(frozen=True)
class Recommending:
    min_score: float = 0.3
    max_count: int = 10
    cache_ttl_seconds: int = 300


@dataclass(frozen=True)
class Recovery:
    """Trigger interval and restart behaviour; the rest is Spark's own checkpointing."""

    checkpoint_interval: int = 1000
    checkpoint_timeout: int = 60000
    restart_attempts: int = 3
    restart_delay: int = 10000


@dataclass(frozen=True)
class Settings:
    environment: str = "development"
    kafka: Broker = field(default_factory=Broker)
    processing: Processing = field(default_factory=Processing)
    recommendation: Recommending = field(default_factory=Recommending)
    recovery: Recovery = field(default_factory=Recovery)


def merge_settings(base, overrides: dict):
    """A copy of ``base`` with the nested ``overrides`` laid over it; unknown names are ignored."""
    changes = {}
    for item in fields(base):
        if item.name not in overrides:
            continue
        current, new = getattr(base, item.name), overrides[item.name]
        changes[item.name] = merge_settings(current, new or {}) if is_dataclass(current) else new
    return replace(base, **changes)


def load_settings(path: str | None = None) -> Settings:
    """Defaults merged with a YAML (or JSON) file; a missing file leaves the defaults."""
    if path is None:
        return Settings()
    try:
        with open(path, encoding="utf-8") as source:
            text = source.read()
    except FileNotFoundError:
        return Settings()
    try:
        import yaml

        overrides = yaml.safe_load(text)
    except ImportError:
        import json

        overrides = json.loads(text)
    return merge_settings(Settings(), overrides or {})
