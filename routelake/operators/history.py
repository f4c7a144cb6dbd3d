"""Route history: rows of events, deduplicated by id, appended by day; routers merged from Peer Ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def local_date(time: Column, timezone: str = "UTC") -> Column:
    return F.to_date(F.from_utc_timestamp(F.to_utc_timestamp(time.cast("timestamp"), F.current_timezone()), timezone))


def rows(events: DataFrame, time: str = "time", timezone: str = "UTC", keep_raw: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """route_events of decoded, identified events, and columns `keep`: routes only; path id 0, and the peer of a Loc-RIB, are null."""
    peer = lambda c: F.when(~F.col("is_loc_rib") & F.col("peer_address").isNotNull(), F.col(c)).alias(c)
    plain = ["router_id", "table_name", "afi", "prefix", "action", "nexthop", "as_path", "origin", "localpref", "med", "origin_asn", "communities_std", "communities_ext", "communities_large", "attrs"]
    return events.where("kind = 'route'").select("event_id", F.col(time).cast("timestamp").alias("ingest_time"), local_date(F.col(time), timezone).alias("ingest_date"), *plain, F.nullif("path_id", F.lit(0).cast("bigint")).alias("path_id"), *(peer(c) for c in ("peer_address", "peer_asn", "peer_bgp_id", "is_post_policy")), (F.col("bmp_raw") if keep_raw else F.lit(None).cast("binary")).alias("bmp_raw"), *keep)


def deduplicated(history: DataFrame, by: Sequence[str] = ("ingest_date",), place: str | None = None) -> DataFrame:
    """The first row of each event id in its date (or batch).

    `place`: a column that tells rows apart. With it only ids, times and places are compared, combined before the
    shuffle, and whole rows meet the few that repeat; without it whole rows are shuffled by id.
    """
    if place is None:
        first = Window.partitionBy("event_id", *by).orderBy("ingest_time", "router_id")
        return history.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    per = history.groupBy("event_id", *by).agg(F.min(F.struct("ingest_time", "router_id", place)).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = per.select("event_id", *by, F.col(f"first.{place}").alias("_first"))
    return history.join(repeated, ["event_id", *by], "left").where(F.col("_first").isNull() | (F.col("_first") == F.col(place))).drop("_first")


def fresh(history: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose id isn't in `stored` for the same date. The dates of the rows come to the driver, so that the scan of `stored` reads only these days."""
    days = [r[0] for r in history.select("ingest_date").distinct().collect()]
    return history.join(stored.where(F.col("ingest_date").isin(days)).select("event_id", "ingest_date"), ["event_id", "ingest_date"], "left_anti")


def compressed(history: DataFrame, column: str = "bmp_raw") -> DataFrame:
    """The raw bytes as zstd frames."""
    place = history.columns.index(column)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = [None if x is None else pa.compress(x, codec="zstd", asbytes=True) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary()) if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return history.mapInArrow(run, history.schema)


def router_updates(events: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """(seq, time, router_id, router_ip, hostname, as_number, description, display_name, location) of Peer Ups.

    A Loc-RIB Peer Up names the router; another names its AS, and counts only when it changes that; Initiations, where
    they carry a name, give hostname and description. `meta`: router_id, display_name, location of the configuration.
    """
    text = lambda c: F.col(c).cast("string")
    base = lambda df, asn, host, about: df.select("seq", "time", "router_id", text("router_id").alias("router_ip"), host.cast("string").alias("hostname"), asn.cast("bigint").alias("as_number"), about.cast("string").alias("description"))
    null = F.lit(None)
    loc = base(events.where("kind = 'peer_up' and is_loc_rib and router_id is not null"), null, null, null)
    before = Window.partitionBy("router_id").orderBy("seq")
    ups = events.where("kind = 'peer_up' and not is_loc_rib and local_asn > 0 and router_id is not null").withColumn("_old", F.lag("local_asn").over(before))
    asn = base(ups.where("_old is null or _old <> local_asn"), F.col("local_asn"), null, null)
    named = base(events.where("kind = 'router' and router_id is not null and (sys_name is not null or sys_descr is not null)"), null, F.col("sys_name"), F.col("sys_descr"))
    out = loc.unionByName(asn).unionByName(named)
    if meta is None:
        return out.withColumns({"display_name": null.cast("string"), "location": null.cast("string")})
    return out.join(meta.select("router_id", "display_name", "location"), "router_id", "left")


def merged_routers(updates: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """routers: the last value that is not null of each column, first and last time seen. `old`: rows of an earlier merge."""
    facts = ["router_ip", "hostname", "as_number", "description", "display_name", "location"]
    rows = updates.select("router_id", "seq", F.col("time").alias("first_seen"), F.col("time").alias("last_seen"), *facts)
    if old is not None:
        rows = rows.unionByName(old.withColumn("seq", F.lit(-1).cast("bigint")).select(rows.columns))
    return rows.groupBy("router_id").agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in facts), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
