"""Daily upkeep: days past retention go, summaries are written anew, schema steps are applied in order."""

from __future__ import annotations

import datetime as dt
import logging
import re
import time
from collections.abc import Callable
from threading import Event, Thread
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession

from .operators import views
from .sources.tables import Daily, Files, Versioned

DAY = re.compile(r"\d{4}-\d{2}-\d{2}")
PARTITION = re.compile(r"^route_events_(\d{8})$")


def partition_name(day: dt.date) -> str:
    return f"route_events_{day:%Y%m%d}"


def is_partition(name: str) -> bool:
    return bool(PARTITION.match(name)) and not name.endswith("\n")


def today(timezone: str, now: dt.datetime | None = None) -> dt.date:
    return (now or dt.datetime.now(dt.UTC)).astimezone(ZoneInfo(timezone)).date()


def upcoming(timezone: str, now: dt.datetime | None = None) -> list[dt.date]:
    """Days that must be writable: today and tomorrow. Folders come with their first rows, so nothing is made ahead."""
    day = today(timezone, now)
    return [day, day + dt.timedelta(days=1)]


def expired(days: list[str], keep: int, timezone: str, now: dt.datetime | None = None) -> list[str]:
    """Days strictly before today less `keep` days; names that are no days stay."""
    cutoff = today(timezone, now) - dt.timedelta(days=keep)
    return [d for d in days if DAY.fullmatch(d) and dt.date.fromisoformat(d) < cutoff]


def drop_expired(table: Daily, keep: int, timezone: str = "UTC", now: dt.datetime | None = None) -> list[str]:
    gone = expired(table.days(), keep, timezone, now)
    for day in gone:
        table.drop(day)
    return gone


def refresh(spark: SparkSession, path: str, routes: DataFrame | None, adj: DataFrame | None) -> None:
    """Writes the next version of both summaries; one without its table is passed over."""
    for name, source, view in (("route_summary", routes, views.route_summary), ("adj_rib_in_summary", adj, views.adj_rib_in_summary)):
        if source is not None:
            made = view(source)
            table = Versioned(spark, f"{path}/{name}", made.schema)
            table.write(made, table.version() + 1)


def compact(table: Daily, timezone: str = "UTC", now: dt.datetime | None = None) -> list[str]:
    """Days before today whose batches were put together."""
    return [d for d in table.days() if DAY.fullmatch(d) and dt.date.fromisoformat(d) < today(timezone, now) and table.compact(d)]


def run(spark: SparkSession, store, keep: int, timezone: str = "UTC", now: dt.datetime | None = None) -> list[str]:
    gone = drop_expired(store.history, keep, timezone, now)
    compact(store.history, timezone, now)
    refresh(spark, store.path, store.current.read().drop("seq"), store.peers.read().drop("seq"))
    return gone


def until_midnight(timezone: str, now: dt.datetime | None = None) -> float:
    """Seconds to the next local day."""
    here = (now or dt.datetime.now(dt.UTC)).astimezone(ZoneInfo(timezone))
    return (dt.datetime.combine(here.date() + dt.timedelta(days=1), dt.time(), here.tzinfo) - here).total_seconds()


def daily(work: Callable[[], object], timezone: str, stop: Event) -> Thread:
    """A thread that works once a local day, from the next midnight on, until `stop` is set; one that fails is tried again the next day."""

    def loop() -> None:
        while not stop.wait(max(1.0, until_midnight(timezone))):
            try:
                work()
            except Exception:
                logging.getLogger(__name__).exception("daily upkeep failed")

    thread = Thread(target=loop, daemon=True)
    thread.start()
    return thread


def migrate(spark: SparkSession, path: str, steps: dict[int, Callable[[SparkSession], None]], wait: float = 60.0) -> list[int]:
    """Applies steps by number, each once; the number is kept beside the tables after the step.

    A lock file keeps two from migrating at a time; one that is held longer than `wait` seconds is an error. After a
    crash, the file schema_migrations/lock must be deleted by hand.
    """
    files, made, lock = Files(spark, path), [], f"{path}/schema_migrations/lock"
    end = time.monotonic() + wait
    while not files.claim(lock):
        if time.monotonic() >= end:
            raise TimeoutError(f"{lock} is held")
        time.sleep(0.5)
    try:
        done = {int(n) for n in files.names(f"{path}/schema_migrations") if n.isdigit()}
        for number in sorted(set(steps) - done):
            steps[number](spark)
            files.touch(f"{path}/schema_migrations/{number}")
            made.append(number)
    finally:
        files.delete(lock)
    return made
