"""Settings from a YAML or JSON file and the environment, with defaults and checks."""

from __future__ import annotations

import dataclasses
import json
import os
import re
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

PREFIX = "ROUTELAKE_"


@dataclass
class Service:
    instance_id: str = "routelake-1"
    http_listen: str = ":8080"
    log_level: str = "info"
    shutdown_timeout_seconds: int = 30
    per_router_metrics: bool = True


@dataclass
class Consumer:
    group_id: str = ""
    topics: list[str] = field(default_factory=list)


@dataclass
class Tls:
    enabled: bool = False
    ca_file: str = ""
    cert_file: str = ""
    key_file: str = ""


@dataclass
class Sasl:
    enabled: bool = False
    mechanism: str = "PLAIN"
    username: str = ""
    password: str = ""


@dataclass
class Kafka:
    brokers: list[str] = field(default_factory=list)
    client_id: str = "routelake"
    fetch_max_bytes: int = 52428800
    tls: Tls = field(default_factory=Tls)
    sasl: Sasl = field(default_factory=Sasl)
    state: Consumer = field(default_factory=lambda: Consumer("routelake-state"))
    history: Consumer = field(default_factory=lambda: Consumer("routelake-history"))


@dataclass
class Storage:
    path: str = ""


@dataclass
class Ingest:
    raw_mode: bool = True
    batch_size: int = 1000
    flush_interval_ms: int = 200
    channel_buffer_size: int = 16
    max_payload_bytes: int = 16777216
    store_raw_bytes: bool = False
    store_raw_bytes_compress: bool = True


@dataclass
class Retention:
    days: int = 30
    timezone: str = "UTC"


@dataclass
class Router:
    name: str = ""
    location: str = ""


@dataclass
class Config:
    service: Service = field(default_factory=Service)
    kafka: Kafka = field(default_factory=Kafka)
    storage: Storage = field(default_factory=Storage)
    ingest: Ingest = field(default_factory=Ingest)
    retention: Retention = field(default_factory=Retention)
    routers: dict[str, Router] = field(default_factory=dict)

    def validate(self) -> None:
        positive = ["ingest.flush_interval_ms", "ingest.batch_size", "ingest.channel_buffer_size", "ingest.max_payload_bytes", "retention.days", "kafka.fetch_max_bytes", "service.shutdown_timeout_seconds"]
        needed = ["kafka.brokers", "storage.path", "kafka.state.group_id", "kafka.state.topics", "kafka.history.group_id", "kafka.history.topics"]
        for name in needed:
            if not self[name]:
                raise ValueError(f"{name} is required")
        for name in positive:
            if self[name] <= 0:
                raise ValueError(f"{name} must be positive, not {self[name]}")
        try:
            ZoneInfo(self.retention.timezone)
        except Exception as e:
            raise ValueError(f"retention.timezone is unknown: {self.retention.timezone}") from e
        if self.ingest.max_payload_bytes > self.kafka.fetch_max_bytes:
            raise ValueError("ingest.max_payload_bytes exceeds kafka.fetch_max_bytes")

    def __getitem__(self, name: str):
        value = self
        for part in name.split("."):
            value = getattr(value, part)
        return value


def typed(value, like):
    """A value of the kind that the default has; texts split at commas for lists."""
    if isinstance(like, bool):
        return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "on")
    if isinstance(like, int):
        return int(value)
    if isinstance(like, list):
        return [x.strip() for x in value.split(",")] if isinstance(value, str) else [y for x in value for y in (x.split(",") if len(value) == 1 else [x])]
    return "" if value is None else str(value)


def merge(into, values: dict) -> None:
    for key, value in values.items():
        if isinstance(into, dict):
            into[key] = Router(**{k: v for k, v in (value or {}).items() if k in ("name", "location")})
        elif any(f.name == key for f in dataclasses.fields(into)):
            old = getattr(into, key)
            if dataclasses.is_dataclass(old) or isinstance(old, dict):
                merge(old, value or {})
            else:
                setattr(into, key, typed(value, old))


def parse(text: str) -> dict:
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text) or {}


def load(path: str | None = None, environ: dict[str, str] | None = None) -> Config:
    """Defaults, then the file, then ROUTELAKE_SECTION__KEY variables; checked."""
    config = Config()
    if path:
        with open(path, encoding="utf-8") as f:
            merge(config, parse(f.read()))
    for name, value in (os.environ if environ is None else environ).items():
        if name.startswith(PREFIX):
            tree: dict | str = value
            for part in reversed(name.removeprefix(PREFIX).lower().split("__")):
                tree = {part: tree}
            merge(config, tree)
    config.validate()
    return config


def redacted(text: str) -> str:
    """A connection text without its password."""
    return re.sub(r"(password=)\S+", r"\1***", re.sub(r"(://[^:/@\s]+:)[^@\s]+@", r"\1***@", text))
