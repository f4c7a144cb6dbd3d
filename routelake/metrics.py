"""Counters and gauges of ingest, in the text format that scrapers read."""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names and kinds of the series; bounds of the histograms.
SERIES = {
    "kafka_messages_total": "counter",
    "db_write_duration_seconds": "histogram",
    "db_rows_affected_total": "counter",
    "history_dedup_conflicts_total": "counter",
    "parse_errors_total": "counter",
    "eor_seen": "gauge",
    "last_msg_timestamp_seconds": "gauge",
    "batch_size": "histogram",
    "batch_dropped_total": "counter",
    "routes_purged_total": "counter",
}
BOUNDS = {"db_write_duration_seconds": (0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1), "batch_size": (1, 10, 50, 100, 250, 500, 1000, 2000, 5000)}


# Stage and reason of errors, by how the error begins; the last is for all others.
ERRORS = (("UPDATE", "raw", "bgp_parse"), ("bits behind", "raw", "bgp_parse"), ("no message", "raw", "bmp_parse"), ("not a JSON", "json", "decode"), ("no router", "json", "decode"), ("no prefix", "json", "decode"), ("", "raw", "openbmp_decode"))


class Metrics:
    """per_router: whether eor_seen and last_msg_timestamp_seconds are kept by router and table; with very many of them, switch it off."""

    def __init__(self, per_router: bool = True):
        self.lock, self.values, self.seen, self.per_router = threading.Lock(), defaultdict(float), defaultdict(list), per_router

    def add(self, name: str, n: float = 1, **labels: str) -> None:
        with self.lock:
            self.values[name, tuple(sorted(labels.items()))] += n

    def set(self, name: str, n: float, **labels: str) -> None:
        with self.lock:
            self.values[name, tuple(sorted(labels.items()))] = n

    def sample(self, name: str, n: float, **labels: str) -> None:
        with self.lock:
            counts = self.seen[name, tuple(sorted(labels.items()))] or [0] * (len(BOUNDS[name]) + 1) + [0.0]
            counts[next((i for i, b in enumerate(BOUNDS[name]) if n <= b), len(BOUNDS[name]))] += 1
            counts[-1] += n
            self.seen[name, tuple(sorted(labels.items()))] = counts

    @contextmanager
    def timed(self, **labels: str):
        start = time.monotonic()
        yield
        self.sample("db_write_duration_seconds", time.monotonic() - start, **labels)

    def observe(self, pipeline: str, events: DataFrame) -> dict[tuple[str, str], int]:
        """Counts by topic, family and action, and, if they are kept, the last time of each table: one aggregate of a batch. Returns counts of routes by (loc or adj, action)."""
        topic = F.col("topic") if "topic" in events.columns else F.lit("")
        who = ["router_id", "table_name"] if self.per_router else [F.lit("").alias("router_id"), F.lit("").alias("table_name")]
        rows = events.where("kind <> 'error'").groupBy(topic.alias("topic"), *who, "afi", "kind", "action", "is_loc_rib").agg(F.count("*").alias("n"), F.max("time").cast("timestamp").alias("last")).collect()
        routes: dict[tuple[str, str], int] = defaultdict(int)
        for r in rows:
            afi, action = str(r.afi or ""), (r.action or "") if r.kind == "route" else r.kind
            self.add("kafka_messages_total", r.n, pipeline=pipeline, topic=r.topic or "", afi=afi, action=action if r.is_loc_rib else f"adj_{action}")
            if r.kind == "route":
                routes["loc" if r.is_loc_rib else "adj", action] += r.n
            if self.per_router:
                if r.kind == "eor" and r.is_loc_rib:
                    self.set("eor_seen", 1, router_id=r.router_id or "", table_name=r.table_name or "", afi=afi)
                if r.last is not None:
                    self.set("last_msg_timestamp_seconds", r.last.timestamp(), pipeline=pipeline, router_id=r.router_id or "", table_name=r.table_name or "", afi=afi)
        self.sample("batch_size", sum(r.n for r in rows), pipeline=pipeline)
        return routes

    def failed(self, errors: DataFrame) -> None:
        """Counts rows of kind error by stage and reason."""
        which = F.lit(len(ERRORS) - 1)
        for i in range(len(ERRORS) - 2, -1, -1):
            which = F.when(F.startswith("error", F.lit(ERRORS[i][0])), i).otherwise(which)
        for r in errors.groupBy(which.alias("i")).count().collect():
            self.add("parse_errors_total", r["count"], stage=ERRORS[r.i][1], reason=ERRORS[r.i][2])

    def text(self) -> str:
        label = lambda pairs: "{" + ",".join(f'{k}="{v}"' for k, v in pairs) + "}" if pairs else ""
        out, told = [], set()

        def kind(name: str) -> None:
            if name not in told:
                told.add(name)
                out.append(f"# TYPE {name} {SERIES.get(name, 'gauge')}")

        with self.lock:
            for (name, pairs), v in sorted(self.values.items()):
                kind(name)
                out.append(f"{name}{label(pairs)} {v:g}")
            for (name, pairs), counts in sorted(self.seen.items()):
                kind(name)
                total = 0
                for bound, n in zip((*BOUNDS[name], "+Inf"), counts, strict=False):
                    total += n
                    out.append(f"{name}_bucket{label((*pairs, ('le', bound)))} {total}")
                out += [f"{name}_sum{label(pairs)} {counts[-1]:g}", f"{name}_count{label(pairs)} {total}"]
        return "\n".join(out) + "\n"
