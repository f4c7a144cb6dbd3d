"""Summaries, overviews and the read queries over the tables."""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C


# summaries


def route_summary(routes: DataFrame) -> DataFrame:
    return routes.groupBy("router_id", "table_name", "afi").agg(F.count("*").alias("route_count"), F.countDistinct("prefix").alias("unique_prefixes"), F.countDistinct("nexthop").alias("unique_nexthops"), F.max("updated_at").alias("last_update"))


def adj_rib_in_summary(adj: DataFrame) -> DataFrame:
    return adj.groupBy("router_id", "peer_address", "peer_asn", "is_post_policy", "table_name", "afi").agg(F.count("*").alias("route_count"), F.countDistinct("prefix").alias("unique_prefixes"), F.countDistinct("nexthop").alias("unique_nexthops"), F.max("updated_at").alias("last_update"))


def peers_overview(adj: DataFrame, routers: DataFrame) -> DataFrame:
    """Counts are formed before the join, so only one row a peer meets the routers."""
    post = F.col("is_post_policy")
    per = adj.groupBy("router_id", "peer_address", "peer_asn", "peer_bgp_id").agg(F.count_if(~post).alias("pre_policy_routes"), F.count_if(post).alias("post_policy_routes"), F.count("*").alias("total_routes"), F.countDistinct("prefix").alias("unique_prefixes"), F.max("updated_at").alias("last_update"))
    return per.join(routers.select("router_id", F.col("hostname").alias("router_hostname")), "router_id", "left")


def routers_overview(routers: DataFrame, status: DataFrame, routes: DataFrame, adj: DataFrame) -> DataFrame:
    """One row for each router that any table knows; counts are 0 where there is nothing."""
    known = routers.select("router_id").union(status.select("router_id")).union(routes.select("router_id")).union(adj.select("router_id")).distinct()
    own = routes.groupBy("router_id").agg(F.count("*").alias("route_count"), F.countDistinct("prefix").alias("unique_prefixes"))
    peers = adj.groupBy("router_id").agg(F.count("*").alias("adj_rib_in_route_count"), F.countDistinct("peer_address").alias("adj_rib_in_peer_count"))
    sync = status.groupBy("router_id").agg(F.bool_and("eor_seen").alias("all_afis_synced"), F.max("session_start_time").alias("session_start_time"), F.max("updated_at").alias("sync_updated_at"))
    out = known.join(routers, "router_id", "left").join(own, "router_id", "left").join(peers, "router_id", "left").join(sync, "router_id", "left")
    counts = ["route_count", "unique_prefixes", "adj_rib_in_route_count", "adj_rib_in_peer_count"]
    return out.select("router_id", "router_ip", "hostname", "as_number", "description", "display_name", "location", "first_seen", "last_seen", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts), "all_afis_synced", "session_start_time", "sync_updated_at")


def churn(history: DataFrame, since: Column | None = None, unit: str = "minute") -> DataFrame:
    rows = history if since is None else history.where(F.col("ingest_time") > since)
    return rows.groupBy(F.date_trunc(unit, "ingest_time").alias("minute")).agg(F.count("*").alias("events"), F.count_if(F.col("action") == "A").alias("adds"), F.count_if(F.col("action") == "D").alias("withdraws")).orderBy(F.desc("minute"))


def live_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("router_id", "table_name", "afi").agg(F.count("*").alias("route_count"), F.countDistinct("prefix").alias("unique_prefixes"))


# routes


def by_router(routes: DataFrame, router_id: str) -> DataFrame:
    """In the order of networks, not of text."""
    return routes.where(F.col("router_id") == router_id).orderBy(C.sort_key("prefix"))


def exact_prefix(routes: DataFrame, prefix: str) -> DataFrame:
    return routes.where(F.col("prefix") == prefix)


def by_origin(routes: DataFrame, asn: int) -> DataFrame:
    return routes.where(F.col("origin_asn") == asn).select("prefix", "nexthop", "as_path")


def by_community(routes: DataFrame, *values: str, kind: str = "std") -> DataFrame:
    column = f"communities_{kind}"
    test = F.array_contains(column, values[0]) if len(values) == 1 else C.contains_all(column, list(values))
    return routes.where(test).select("prefix", "nexthop", "as_path")


def by_nexthop(routes: DataFrame, nexthop: str) -> DataFrame:
    return routes.where(F.col("nexthop") == nexthop).select("prefix", "as_path")


def changed_since(routes: DataFrame, time: Column) -> DataFrame:
    return routes.where(F.col("updated_at") > time).orderBy(F.desc("updated_at"))


def across_routers(routes: DataFrame, prefix: str) -> DataFrame:
    return routes.where(F.col("prefix") == prefix).select("router_id", "nexthop", "as_path").orderBy("router_id")


def longest_match(addresses: DataFrame, routes: DataFrame, address: str = "address") -> DataFrame:
    """Each address with the longest prefixes that hold it (`prefix`, and all columns of `routes` as struct `route`).

    Addresses meet networks by equality: an address is masked to each length that its family's networks have, at most
    33 or 129 of them, and joined on (family, length, network). No range join.
    """
    fam, length = C.family("prefix"), C.masklen("prefix")
    nets = routes.select(fam.alias("fam"), length.alias("len"), C.masked(C.halves("prefix"), fam, length).alias("net"), F.struct(*routes.columns).alias("route"))
    lengths = nets.select("fam", "len").distinct().groupBy(F.col("fam").alias("f")).agg(F.collect_set("len").alias("lens"))
    asked = addresses.withColumns({"fam": C.family(address), "h": C.halves(address)}).join(F.broadcast(lengths), F.col("fam") == F.col("f"))
    tried = asked.select(*addresses.columns, "fam", "h", F.explode("lens").alias("len")).withColumn("net", C.masked(F.col("h"), F.col("fam"), F.col("len"))).drop("h")
    best = tried.join(nets, ["fam", "len", "net"]).groupBy(*addresses.columns).agg(F.max_by(F.col("route"), F.struct("len", F.col("route.prefix"))).alias("route"))
    return best.withColumn("prefix", F.col("route.prefix"))


def holding(address: str) -> list[str]:
    """The names of all networks that hold an address, the longest first."""
    ip = ipaddress.ip_address(address)
    return [str(ipaddress.ip_network((ip, n), strict=False)) for n in range(ip.max_prefixlen, -1, -1)]


def match_one(routes: DataFrame, address: str) -> DataFrame:
    """The routes of the longest prefix that holds one address: the filter is a list of its networks' names, which the scan can use."""
    return routes.where(F.col("prefix").isin(holding(address))).orderBy(F.desc(C.masklen("prefix"))).limit(1)


# history and health


def prefix_history(history: DataFrame, router_id: str, prefix: str, most: int = 100) -> DataFrame:
    rows = history.where((F.col("router_id") == router_id) & (F.col("prefix") == prefix))
    return rows.select("ingest_time", "action", "nexthop", "as_path", "origin_asn").orderBy(F.desc("ingest_time")).limit(most)


def in_window(history: DataFrame, router_id: str, start: Column, stop: Column) -> DataFrame:
    """A closed window; days in between prune partitions where the table has them."""
    rows = history.where((F.col("router_id") == router_id) & F.col("ingest_time").between(start, stop))
    if "ingest_date" in history.columns:
        rows = rows.where(F.col("ingest_date").between(F.date_sub(F.to_date(start), 1), F.date_add(F.to_date(stop), 1)))
    return rows.select("ingest_time", "prefix", "action", "nexthop").orderBy(F.desc("ingest_time"))


def sync_health(status: DataFrame, routers: DataFrame) -> DataFrame:
    return status.join(routers.select("router_id", "hostname"), "router_id", "left").select("router_id", "hostname", "afi", "eor_seen", "eor_time", "session_start_time", "updated_at").orderBy("router_id", "afi")


def stale_sessions(status: DataFrame, now: Column, minutes: int = 5) -> DataFrame:
    return status.where(F.col("updated_at") < now - F.make_dt_interval(mins=F.lit(minutes))).select("router_id", "table_name", "afi", "updated_at")


def summary_counts(summary: DataFrame) -> DataFrame:
    return summary.orderBy("router_id", "afi")


def acceptance_count(routes: DataFrame) -> DataFrame:
    return routes.where("afi = 4").agg(F.count("*").alias("routes"))


def register(**tables: DataFrame) -> None:
    """Temporary views for SQL, by name; tables of routes get network, by which prefixes sort as networks."""
    for name, df in tables.items():
        (df.withColumn("network", C.sort_key("prefix")) if name in ("current_routes", "adj_rib_in") else df).createOrReplaceTempView(name)


#: The read queries as SQL over registered views; :names are parameters.
READS = {
    "by_router": "select * from current_routes where router_id = :router_id order by network",
    "exact_prefix": "select * from current_routes where prefix = :prefix",
    "match_one": "select * from current_routes where array_contains(:networks, prefix) order by cast(substring_index(prefix, '/', -1) as int) desc limit 1",
    "by_origin": "select prefix, nexthop, as_path from current_routes where origin_asn = :asn",
    "by_community": "select prefix, nexthop, as_path from current_routes where array_contains(communities_std, :community)",
    "by_nexthop": "select prefix, as_path from current_routes where nexthop = :nexthop",
    "changed_since": "select * from current_routes where updated_at > :since order by updated_at desc",
    "across_routers": "select router_id, nexthop, as_path from current_routes where prefix = :prefix order by router_id",
    "prefix_history": "select ingest_time, action, nexthop, as_path, origin_asn from route_events where router_id = :router_id and prefix = :prefix order by ingest_time desc limit 100",
    "churn": "select date_trunc('minute', ingest_time) as minute, count(*) as events, count_if(action = 'A') as adds, count_if(action = 'D') as withdraws from route_events where router_id = :router_id and ingest_time > :since group by 1 order by minute desc",
    "in_window": "select ingest_time, prefix, action, nexthop from route_events where router_id = :router_id and ingest_time between :start and :stop and ingest_date between date_sub(:start, 1) and date_add(:stop, 1) order by ingest_time desc",
    "sync_health": "select s.router_id, hostname, afi, eor_seen, eor_time, session_start_time, updated_at from rib_sync_status s left join routers r on r.router_id = s.router_id order by s.router_id, afi",
    "stale_sessions": "select router_id, table_name, afi, updated_at from rib_sync_status where updated_at < :now - interval 5 minutes",
    "summary_counts": "select * from route_summary order by router_id, afi",
    "live_counts": "select router_id, table_name, afi, count(*) as route_count, count(distinct prefix) as unique_prefixes from current_routes group by router_id, table_name, afi",
}


def ask(spark: SparkSession, name: str, **parameters) -> DataFrame:
    """A read query by name. match_one takes the address."""
    if "address" in parameters:
        parameters["networks"] = F.array(*map(F.lit, holding(parameters.pop("address"))))
    return spark.sql(READS[name], args=parameters)
