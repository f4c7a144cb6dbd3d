"""python -m routelake.cli serve | migrate | maintenance | scan | dump"""

from __future__ import annotations

import argparse
import signal
import time
from threading import Event

from .config import Config, load


def session(config: Config):
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName(config.service.instance_id).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def schema_steps(config: Config) -> dict:
    """Numbered schema steps. The first makes the tables' folders; a step that changes a table goes here."""
    from .streaming.ingest import Store

    return {1: lambda spark: Store(spark, config.storage.path).create()}


def serve(config: Config) -> None:
    from . import health
    from .maintenance import daily, migrate, run
    from .metrics import Metrics
    from .sources import frames
    from .streaming.ingest import Store, ingest

    spark = session(config)
    migrate(spark, config.storage.path, schema_steps(config))
    store = Store(spark, config.storage.path, config.retention.timezone, Metrics(config.service.per_router_metrics))
    meta = spark.createDataFrame([(k, r.name or None, r.location or None) for k, r in config.routers.items()], "router_id string, display_name string, location string") if config.routers else None
    trigger = {"processingTime": f"{config.ingest.flush_interval_ms} milliseconds"}

    def start(name: str, raw: bool):
        own = config[f"kafka.{name}"]
        stream = frames.kafka_stream(spark, frames.kafka_options(config.kafka, own.group_id, own.topics), config.ingest.batch_size * config.ingest.channel_buffer_size)
        decoder = {"most": config.ingest.max_payload_bytes} if raw else {}
        return ingest(store, stream, f"{config.storage.path}/_checkpoint_{name}", raw, trigger, meta, (name,), config.ingest.store_raw_bytes, config.ingest.store_raw_bytes_compress, **decoder)

    queries = [start("state", config.ingest.raw_mode), start("history", True)]
    stop = Event()
    daily(lambda: run(spark, store, config.retention.days, config.retention.timezone), config.retention.timezone, stop)
    server = health.serve(config.service.http_listen, queries, lambda: store.marks.version() >= -1, store.metrics)
    signal.signal(signal.SIGTERM, lambda *_: stop.set())
    try:
        while not stop.wait(1.0):
            for q in queries:
                if q.exception() is not None:
                    raise q.exception()
    finally:
        stop.set()
        drain(queries, config.service.shutdown_timeout_seconds)
        server.shutdown()


def drain(queries: list, seconds: float) -> None:
    """Waits until no query works on a batch, for the time that is allowed, then stops them; a batch that is cut off runs again."""
    end = time.monotonic() + seconds
    while time.monotonic() < end and any(q.isActive and q.status["isTriggerActive"] for q in queries):
        time.sleep(0.1)
    for q in queries:
        q.stop()


def scan(config: Config, most: int) -> None:
    """Prints what the state topics hold from the earliest offset on, as decoded events."""
    from .operators import decode
    from .sources import frames

    spark = session(config)
    records = frames.kafka_batch(spark, frames.kafka_options(config.kafka, f"{config.kafka.state.group_id}-scan", config.kafka.state.topics))
    decode.decode(records.limit(most), ["topic", "partition", "offset"], ids=False).show(most, truncate=False, vertical=True)


def dump(paths: list[str], most: int) -> None:
    """Prints what files of frames hold."""
    from .functions import wire

    for path in paths:
        with open(path, "rb") as f:
            for row in wire.rows(f.read(), most):
                print({k: v.hex() if isinstance(v, bytes) else v for k, v in row.items() if v is not None and k != "bmp_raw"})


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="routelake", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("serve", "migrate", "maintenance"):
        commands.add_parser(name).add_argument("--config")
    topics = commands.add_parser("scan")
    topics.add_argument("--config")
    topics.add_argument("--most", type=int, default=100)
    files = commands.add_parser("dump")
    files.add_argument("files", nargs="+")
    files.add_argument("--max", type=int, default=16 << 20)
    found = parser.parse_args(args)
    if found.command == "dump":
        dump(found.files, found.max)
        return 0
    config = load(found.config)
    if found.command == "serve":
        serve(config)
        return 0
    if found.command == "scan":
        scan(config, found.most)
        return 0
    from . import maintenance
    from .streaming.ingest import Store

    spark = session(config)
    if found.command == "migrate":
        print(*maintenance.migrate(spark, config.storage.path, schema_steps(config)))
    else:
        print(*maintenance.run(spark, Store(spark, config.storage.path, config.retention.timezone), config.retention.days, config.retention.timezone))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
