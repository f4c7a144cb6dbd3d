"""Ingest as micro-batches: decode, fold into the current tables, append to the history.

Each batch is one step: snapshot and batch give the next snapshot, written as a version named by the batch; a batch
that runs again after a failure finds its version and changes nothing. Offsets are kept by the query's checkpoint,
after the batch, so records are read at least once and count once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..metrics import Metrics
from ..operators import decode, fold, history, jsonfeed, views
from ..schemas import ADJ_KEY, ATTRIBUTES, CURRENT_ROUTES, LOC_KEY, PEER_FACTS, ROUTERS
from ..sources import frames
from ..sources.tables import Daily, Parted, Versioned

FACTS = CURRENT_ROUTES.split("path_id BIGINT, ")[1]
SNAPSHOT = f"router_id STRING, table_name STRING, afi INT, prefix STRING, path_id BIGINT, {FACTS}, seq BIGINT"
PEERS = f"router_id STRING, peer_address STRING, is_post_policy BOOLEAN, table_name STRING, afi INT, prefix STRING, path_id BIGINT, peer_asn BIGINT, peer_bgp_id STRING, {FACTS}, seq BIGINT"
SESSIONS = "router_id STRING, table_name STRING, is_loc_rib BOOLEAN, peer_address STRING, time TIMESTAMP, seq BIGINT, kind STRING"
IDENTITIES = "router_hash STRING, router_id STRING"
STATUS = "router_id STRING, table_name STRING, afi INT, kind STRING, time TIMESTAMP, seq BIGINT"
HISTORY = "event_id BINARY, ingest_time TIMESTAMP, router_id STRING, table_name STRING, afi INT, prefix STRING, action STRING, nexthop STRING, as_path STRING, origin STRING, localpref BIGINT, med BIGINT, origin_asn BIGINT, communities_std ARRAY<STRING>, communities_ext ARRAY<STRING>, communities_large ARRAY<STRING>, attrs MAP<STRING,STRING>, path_id BIGINT, peer_address STRING, peer_asn BIGINT, peer_bgp_id STRING, is_post_policy BOOLEAN, bmp_raw BINARY, batch BIGINT, ingest_date DATE"
ORDER = ["t", "topic", "partition", "offset", "msg_index", "event_index"]
RAW_TIMES = "router_id STRING, table_name STRING, afi INT, raw TIMESTAMP"


def numbered(rows: DataFrame, first: int) -> tuple[DataFrame, int]:
    """Rows that stand in order, with seq from `first` on without gaps, and the number behind the last. Partitions are
    moved by the rows before them, so no task holds all rows and no room can run out. `rows` must be persisted."""
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    found = {r.p: r.n for r in rows.groupBy(F.shiftrightunsigned("_id", 33).cast("int").alias("p")).agg(F.count("*").alias("n")).collect()}
    before, total = [], first
    for p in range(max(found, default=0) + 1):
        before.append(total)
        total += found.get(p, 0)
    starts = F.array(*(F.lit(x).cast("bigint") for x in before))
    return rows.withColumn("seq", F.element_at(starts, F.shiftrightunsigned("_id", 33).cast("int") + 1) + place).drop("_id"), total


def in_order(records: DataFrame, by: list[str]) -> DataFrame:
    """Ranges of the order by partition, each sorted; no task holds all rows."""
    return records.repartitionByRange(*by).sortWithinPartitions(*by)


def raw_events(records: DataFrame, **options) -> DataFrame:
    """Decoded events of frames, in order. Records are sorted before they are decoded, so each is decoded once."""
    return decode.decode(in_order(frames.ordered(records), ORDER[:4]), ["topic", "partition", "offset", "t"], **options)


def json_events(records: DataFrame) -> DataFrame:
    """Decoded events of JSON records, in order."""
    events = jsonfeed.events(frames.ordered(records), ["topic", "partition", "offset", "t"]).withColumns({"msg_index": F.lit(0), "event_index": F.lit(0), "peer_address": F.lit(None).cast("string"), "is_post_policy": F.lit(None).cast("boolean")})
    return in_order(events, ORDER)


def named(events: DataFrame, known: DataFrame) -> DataFrame:
    """Numbered events with router_id; `known`: router_hash, router_id of earlier batches. A Peer Up of this batch wins."""
    rows = decode.identified(events, ["seq"])
    known = known.select(F.col("router_hash").alias("_hash"), F.col("router_id").alias("_router"))
    joined = rows.join(known, (F.col("router_hash") == F.col("_hash")) & ~F.col("is_loc_rib"), "left")
    return joined.withColumn("router_id", F.when(F.col("_router").isNotNull() & F.col("router_id").eqNullSafe(F.col("frame_ip")), F.col("_router")).otherwise(F.col("router_id"))).drop("_hash", "_router")


@dataclass
class Store:
    """The tables under one folder."""

    spark: SparkSession
    path: str
    timezone: str = "UTC"
    metrics: Metrics = field(default_factory=Metrics)

    def __post_init__(self):
        of = lambda name, schema: Versioned(self.spark, f"{self.path}/{name}", schema)
        parted = lambda name, schema: Parted(self.spark, f"{self.path}/{name}", schema)
        self.current, self.peers, self.sessions, self.marks = parted("current_routes", SNAPSHOT), parted("adj_rib_in", PEERS), parted("sessions", SESSIONS), parted("sync_marks", STATUS)
        self.routers, self.raw_times = of("routers", ROUTERS), of("raw_times", RAW_TIMES)
        # one of each for each query that reads records
        self.identities = {k: of(f"identities_{k}", IDENTITIES) for k in ("state", "history")}
        self.places = {k: of(f"places_{k}", "next BIGINT") for k in ("state", "history")}
        self.history = Daily(self.spark, f"{self.path}/route_events", HISTORY)

    def tables(self) -> list[Versioned | Parted | Daily]:
        return [self.current, self.peers, self.sessions, self.marks, self.routers, self.raw_times, *self.identities.values(), *self.places.values(), self.history]

    def create(self) -> None:
        """The folders of all tables."""
        for table in self.tables():
            table.files.make(table.path)

    def status(self) -> DataFrame:
        return fold.raw_time(fold.sync_status(self.marks.read()), self.raw_times.read())

    def numbered(self, rows: DataFrame, batch: int, pipeline: str) -> DataFrame:
        """Persisted rows in order with seq behind that of the batch before; a batch that runs again gets the same numbers."""
        table = self.places[pipeline]
        old = table.read(table.before(batch)).first()
        out, after = numbered(rows, old[0] if old else 0)
        table.write(self.spark.createDataFrame([(after,)], "next BIGINT"), batch)
        return out

    def fold_batch(self, events: DataFrame, batch: int) -> None:
        """Events with seq and time, into the next versions of the current tables: of the parts that hold the batch's routers."""
        if batch <= self.marks.version():
            return
        events = events.persist()
        try:
            loc, adj = decode.loc_rib(events), decode.adj_rib_in(events)
            parts, purged = self.marks.touched(events), {"": Observation(), "adj_": Observation()}
            old = self.sessions.read(parts)
            route = lambda df, key, facts: df.select("kind", "seq", "time", "action", "is_loc_rib", *dict.fromkeys([*key, *facts, "peer_address"])) if "peer_address" in df.columns else df
            with self.metrics.timed(pipeline="state", op="batch"):
                self.current.write(fold.current_routes(fold.carried(self.current.read(parts), route(loc, LOC_KEY, ATTRIBUTES).unionByName(old.where("is_loc_rib"), allowMissingColumns=True)), purged[""]), batch, parts)
            with self.metrics.timed(pipeline="state", op="adj_batch"):
                self.peers.write(fold.adj_rib_in(fold.carried(self.peers.read(parts).withColumn("is_loc_rib", F.lit(False)), route(adj, ADJ_KEY, [*PEER_FACTS, *ATTRIBUTES]).unionByName(old.where("not is_loc_rib"), allowMissingColumns=True)), purged["adj_"]), batch, parts)
            marked = self.marks.read(parts).unionByName(loc.select("router_id", "table_name", "afi", "kind", "time", "seq"))
            self.sessions.write(fold.last_sessions(events.select("kind", "router_id", "table_name", "is_loc_rib", "peer_address", F.col("time").cast("timestamp").alias("time"), "seq").unionByName(old)).select("router_id", "table_name", "is_loc_rib", "peer_address", "time", "seq", "kind"), batch, parts)
            self.marks.write(fold.condensed(marked), batch, parts)
            routes = self.metrics.observe("state", events)
            for key, table in (("loc", "current_routes"), ("adj", "adj_rib_in")):
                for action, op in (("A", "upsert"), ("D", "delete")):
                    self.metrics.add("db_rows_affected_total", routes[key, action], pipeline="state", table=table, op=op)
            for prefix, seen in purged.items() if parts else ():
                for reason, n in seen.get.items():
                    self.metrics.add("routes_purged_total", n, reason=prefix + reason)
        finally:
            events.unpersist()

    def append_batch(self, events: DataFrame, batch: int, dedup: str = "date", keep_raw: bool = True, compress: bool = False) -> None:
        """History rows of events, without those whose id the same date has (dedup "date"), or the batch ("batch")."""
        rows = history.deduplicated(history.rows(events, timezone=self.timezone, keep_raw=keep_raw, keep=["seq"]), ("ingest_date",) if dedup == "date" else (), "seq").drop("seq")
        if dedup == "date" and self.history.days():
            rows = history.fresh(rows, self.history.read().where(F.col("batch") < batch))
        written = Observation()
        with self.metrics.timed(pipeline="history", op="insert"):
            self.history.append((history.compressed(rows) if compress and keep_raw else rows).observe(written, F.count("*").alias("n")), batch)
        times = self.raw_times.read(self.raw_times.before(batch)).unionByName(fold.raw_times(history.rows(events, timezone=self.timezone, keep_raw=False)))
        self.raw_times.write(times.groupBy("router_id", "table_name", "afi").agg(F.max("raw").alias("raw")), batch)
        routes, inserted = self.metrics.observe("history", events), written.get["n"]
        self.metrics.add("db_rows_affected_total", inserted, pipeline="history", table="route_events", op="insert")
        self.metrics.add("history_dedup_conflicts_total", sum(routes.values()) - inserted)

    def merge_routers(self, events: DataFrame, batch: int, meta: DataFrame | None = None) -> None:
        self.routers.write(history.merged_routers(history.router_updates(events, meta), self.routers.read()).select(self.routers.read().columns), batch)

    def remember(self, events: DataFrame, batch: int, pipeline: str = "state") -> None:
        """The router that each hash last named."""
        table = self.identities[pipeline]
        ups = events.where("kind = 'peer_up' and not is_loc_rib and router_hash is not null and router_id is not null").groupBy("router_hash").agg(F.max_by("router_id", "seq").alias("router_id"))
        old = table.read().join(ups.select("router_hash"), "router_hash", "left_anti")
        table.write(old.unionByName(ups), batch)

    def views(self) -> dict[str, DataFrame]:
        routes, peers, status, routers = self.current.read().drop("seq"), self.peers.read().drop("seq"), self.status(), self.routers.read()
        return {"current_routes": routes, "adj_rib_in": peers, "route_summary": views.route_summary(routes), "adj_rib_in_summary": views.adj_rib_in_summary(peers), "rib_sync_status": status, "routers": routers, "route_events": self.history.read(), "peers_overview": views.peers_overview(peers, routers), "routers_overview": views.routers_overview(routers, status, routes, peers)}


def ingest(store: Store, records: DataFrame, checkpoint: str, raw: bool = True, trigger: dict | None = None, meta: DataFrame | None = None, pipelines: tuple[str, ...] = ("state", "history"), keep_raw: bool = True, compress: bool = False, **options):
    """Starts a query over a stream of records (sources.frames); trigger: {"availableNow": True} or {"processingTime": "200 milliseconds"}.

    `pipelines`: what the query feeds. State and history may each have a query of their own, with topics, checkpoint and
    names of routers apart, so that one goes on while the other stands still; history needs frames.
    """
    own = pipelines[0]

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = (raw_events(batch, **options) if raw else json_events(batch)).withColumn("_id", F.monotonically_increasing_id()).persist()
        try:
            events = store.numbered(rows, batch_id, own).withColumn("time", F.col("t"))
            bad = events.where("kind = 'error'")
            if not bad.isEmpty():
                bad.select("topic", "partition", "offset", "error").write.mode("overwrite").parquet(f"{store.path}/quarantine/pipeline={own}/batch={batch_id}")
                store.metrics.failed(bad)
            good = decode.routed(named(events, store.identities[own].read(store.identities[own].before(batch_id)))) if raw else events.where("kind <> 'error'")
            if raw:
                store.remember(good, batch_id, own)
            if raw and "history" in pipelines:
                store.merge_routers(good, batch_id, meta)
                store.append_batch(good, batch_id, keep_raw=keep_raw, compress=compress)
            if "state" in pipelines:
                store.fold_batch(good, batch_id)
        finally:
            rows.unpersist()

    return records.writeStream.queryName(f"{own}-{checkpoint}").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
