"""The registered queries, over routing columns derived from the events and lineitem tables, and their DuckDB SQL.

An event's id gives its router, table, prefix and path, so that announcements, withdrawals and markers meet; its id is
its place in the order. The same expressions, as text, serve both engines; what follows them is written twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import decode as D
from ..operators import fold, history, jsonfeed, views
from ..sources import frames

#: Expressions over `events` that Spark and DuckDB both read.
ROUTE = {
    "seq": "event_id",
    "time": "ts",
    "kind": "case when event_type = 'signup' and event_id % 97 < 3 then 'peer_up' when event_type = 'click' and event_id % 101 = 0 then 'peer_down' when event_type = 'purchase' and event_id % 89 < 3 then 'eor' else 'route' end",
    "is_loc_rib": "true",
    "router_id": "concat('10.0.0.', cast((event_id % 500) % 3 as string))",
    "table_name": "case when event_id % 2 = 0 then 'inet.0' else 'vrf-a' end",
    "afi": "cast(case when event_id % 4 = 0 then 6 else 4 end as int)",
    "prefix": "case when event_id % 4 = 0 then concat('2001:db8:', cast(1 + event_id % 500 as string), '::/48') else concat('10.', cast(event_id % 500 % 5 as string), '.', cast(event_id % 250 as string), '.0/24') end",
    "path_id": "cast(event_id % 500 % 3 as bigint)",
    "action": "case when event_type = 'error' then 'D' else 'A' end",
    "nexthop": "case when event_type = 'error' then null else concat('192.0.2.', cast(user_id % 50 as string)) end",
    "as_path": "case when event_type = 'error' then null else concat('65000 ', cast(64512 + user_id % 100 as string), case when event_id % 11 = 0 then ' {1,2}' else '' end) end",
    "origin_asn": "cast(case when event_type = 'error' or event_id % 11 = 0 then null else 64512 + user_id % 100 end as bigint)",
    "community": "case when event_type = 'error' then null else concat('65001:', cast(user_id % 20 as string)) end",
}
#: Over `lineitem`: routes of peers.
PEER_ROUTE = {
    "seq": "l_orderkey * 10 + l_linenumber",
    "time": "l_shipdate",
    "router_id": "concat('10.0.0.', cast(l_partkey % 3 as string))",
    "peer_address": "concat('198.51.100.', cast(l_suppkey % 20 as string))",
    "peer_asn": "cast(64512 + l_suppkey % 20 as bigint)",
    "peer_bgp_id": "concat('203.0.113.', cast(l_suppkey % 20 as string))",
    "is_post_policy": "l_returnflag = 'R'",
    "table_name": "case when l_linenumber % 2 = 0 then 'inet.0' else '' end",
    "afi": "cast(4 as int)",
    "prefix": "concat('10.', cast(l_partkey % 200 as string), '.', cast(l_linenumber as string), '.0/24')",
    "path_id": "cast(0 as bigint)",
    "action": "case when l_linestatus = 'F' and l_orderkey % 3 = 0 then 'D' else 'A' end",
    "nexthop": "concat('192.0.2.', cast(l_suppkey % 50 as string))",
    "is_loc_rib": "false",
    "kind": "case when l_orderkey % 211 = 1 then 'peer_down' when l_orderkey % 223 = 1 then 'peer_up' when l_orderkey % 227 = 1 then 'eor' else 'route' end",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str], *names: str) -> DataFrame:
    return read(spark, sf_dir, table).selectExpr(*(f"{columns[n]} as {n}" for n in names or columns))


def sql(columns: dict[str, str], table: str, *names: str, where: str = "true") -> str:
    return f"select {', '.join(f'{columns[n]} as {n}' for n in names or columns)} from {table} where {where}"


def loc(spark: SparkSession, sf_dir: str, only_routes: bool = False) -> DataFrame:
    """Loc-RIB events; only_routes: markers count as routes."""
    out = mapped(spark, sf_dir, "events", ROUTE).withColumn("communities_std", F.when(F.col("community").isNotNull(), F.array("community"))).drop("community")
    return out.withColumn("kind", F.lit("route")) if only_routes else out


def adj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(spark, sf_dir, "lineitem", PEER_ROUTE)


def plain(df: DataFrame) -> DataFrame:
    """Times without a zone, as the oracle has them."""
    return df.select(*(F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes))


def routers_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """routers, merged from suppliers: the first ones' numbers say which router each speaks of."""
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey as seq", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(s_suppkey as int)) as time", "concat('10.0.0.', cast(s_suppkey % 5 as string)) as router_id", "concat('10.0.0.', cast(s_suppkey % 5 as string)) as router_ip", "case when s_suppkey % 7 = 0 then s_name end as hostname", "case when s_suppkey % 3 = 0 then cast(64500 + s_nationkey as bigint) end as as_number", "cast(null as string) as description", "case when s_suppkey % 11 = 0 then concat('site ', cast(s_nationkey as string)) end as display_name", "cast(null as string) as location")
    return history.merged_routers(s)


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History rows of every event, with ids from a message of its columns."""
    e = loc(spark, sf_dir, True)
    message = F.concat_ws("|", "router_id", F.col("seq").bitwiseAND(F.lit(-2)).cast("string")).cast("binary")
    e = e.withColumns({"event_id": C.event_id(message, "is_loc_rib", F.lit(None).cast("string"), "prefix", "action"), "peer_address": F.lit(None).cast("string"), "peer_asn": F.lit(None).cast("bigint"), "peer_bgp_id": F.lit(None).cast("string"), "is_post_policy": F.lit(None).cast("boolean"), "bmp_raw": message, **{c: F.lit(None).cast(t) for c, t in (("origin", "string"), ("localpref", "bigint"), ("med", "bigint"), ("communities_ext", "array<string>"), ("communities_large", "array<string>"), ("attrs", "map<string,string>"))}})
    return history.rows(e)


# each query

KEY = ["router_id", "table_name", "afi", "prefix", "path_id"]


def roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as frames, read back."""
    source = loc(spark, sf_dir, True).withColumn("localpref", F.col("seq") % 300)
    # a Loc-RIB names its router itself
    return D.routed(D.decode(frames.encoded(source, ["seq", "time"]), ["seq", "time"], ids=False).withColumn("router_id", D.loc_router()))


def q_roundtrip_v4_announce(spark, sf_dir):
    return roundtrip(spark, sf_dir).where("afi = 4 and action = 'A'").select("seq", "router_id", "table_name", "prefix", "path_id", "nexthop")


def q_roundtrip_withdraw(spark, sf_dir):
    return roundtrip(spark, sf_dir).where("action = 'D'").select("seq", "afi", "prefix", F.col("nexthop").isNull().alias("bare"))


def q_roundtrip_as_path(spark, sf_dir):
    return roundtrip(spark, sf_dir).where("action = 'A'").select("seq", "as_path", F.col("origin_asn").cast("string").alias("origin_asn"), "origin", "localpref")


def q_roundtrip_communities(spark, sf_dir):
    return roundtrip(spark, sf_dir).where("communities_std is not null").select("seq", F.array_join("communities_std", " ").alias("communities"))


def q_roundtrip_add_path(spark, sf_dir):
    return roundtrip(spark, sf_dir).where("path_id > 0").select("seq", "prefix", "path_id", "add_path")


#: Over `events`: session markers of Loc-RIBs and of peers.
SESSION = {
    "seq": "event_id",
    "kind": "case event_type when 'signup' then 'peer_up' when 'click' then 'peer_down' else 'eor' end",
    "is_loc_rib": "event_id % 3 = 0",
    "router_id": "concat('10.0.0.', cast(1 + event_id % 7 as string))",
    "table_name": "'inet.0'",
    "afi": "cast(case when event_id % 2 = 0 then 6 else 4 end as int)",
    "peer_address": "concat('198.51.100.', cast(user_id % 50 as string))",
    "peer_asn": "cast(64512 + user_id % 9 as bigint)",
    "peer_bgp_id": "concat('203.0.113.', cast(1 + user_id % 50 as string))",
    "local_asn": "cast(64000 + user_id * 100 as bigint)",
    "reason": "cast(1 + event_id % 5 as int)",
}


def wrapped(df: DataFrame) -> DataFrame:
    """With what a wrapper of version 1.7 says of the router."""
    return df.withColumns({"router_hash": F.md5(F.col("router_id").cast("binary")), "frame_ip": F.col("router_id")})


def through(df: DataFrame, *keep: str) -> DataFrame:
    """Events as frames, decoded."""
    return D.decode(frames.encoded(df, list(keep)), list(keep), ids=False)


def q_roundtrip_peers(spark, sf_dir):
    return through(wrapped(adj(spark, sf_dir).where("kind = 'route'")), "seq").select("seq", "router_hash", "frame_ip", "peer_address", "peer_asn", "peer_bgp_id", "is_post_policy", "table_name", "prefix", "action", "nexthop")


def q_roundtrip_sessions(spark, sf_dir):
    rows = read(spark, sf_dir, "events").where("event_type in ('signup', 'click', 'purchase')").selectExpr(*(f"{c} as {n}" for n, c in SESSION.items()))
    return through(rows, "seq").select("seq", "kind", "is_loc_rib", "table_name", "header_router", "afi", "peer_address", "peer_bgp_id", "local_bgp_id", *(F.col(c).cast("string").alias(c) for c in ("peer_asn", "local_asn", "reason")))


def q_roundtrip_initiation(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").selectExpr("s_suppkey as seq", "'router' as kind", "s_name as sys_name", "concat('site ', cast(s_nationkey as string)) as sys_descr")
    return through(rows, "seq").select("seq", "kind", "sys_name", "sys_descr")


def q_roundtrip_attributes(spark, sf_dir):
    text = lambda kind, c: F.concat(F.lit(kind), (F.col("seq") % c).cast("string"))
    rows = loc(spark, sf_dir, True).where("action = 'A'").withColumns({"med": F.col("seq") * 3, "communities_ext": F.array(text("RT:65001:", 1000), text("SOO:65002:", 7)), "communities_large": F.array(text("70000:1:", 100000))})
    return through(rows, "seq").select("seq", "med", F.array_join("communities_ext", " ").alias("extended"), F.array_join("communities_large", " ").alias("large"))


def q_add_path_detected(spark, sf_dir):
    """Path ids without the flag: a reading as plain prefixes is doubtful."""
    rows = loc(spark, sf_dir, True).where("afi = 4 and action = 'A'").withColumns({"path_id": 64 + F.col("seq") % 150, "path_flag": F.lit(False)})
    return through(rows, "seq").select("seq", "prefix", "path_id", "add_path")


def q_frame_messages(spark, sf_dir):
    """Several messages in a frame."""
    rows = loc(spark, sf_dir, True).withColumn("messages", (1 + F.col("seq") % 4).cast("int"))
    return through(rows, "seq").select("seq", "msg_index", "prefix", "action")


def q_current_routes_decoded(spark, sf_dir):
    """The fold, fed by frames: routes, session starts, End-of-RIBs and Peer Downs."""
    # kept, as the fold reads routes and each kind of marker apart; only what it reads
    events = D.routed(through(loc(spark, sf_dir), "seq", "time").withColumn("router_id", D.loc_router())).select("seq", "time", "kind", *KEY, "action", "nexthop").persist()
    return plain(fold.current_routes(events).select(*KEY, "nexthop", "first_seen", "updated_at"))


def q_adj_rib_in_decoded(spark, sf_dir):
    """The same of peers, whose router is named by the last Peer Up."""
    source = wrapped(adj(spark, sf_dir).withColumn("local_asn", F.col("peer_asn")))
    # kept once, before routers are named: these are few names, met without a shuffle
    events = D.routed(through(source, "seq", "time")).select("seq", "time", "kind", "is_loc_rib", "router_hash", "frame_ip", "header_router", "local_bgp_id", "peer_address", "peer_asn", "is_post_policy", "table_name", "afi", "prefix", "path_id", "action", "nexthop").persist()
    rows = D.identified(events, ["seq"])
    return plain(fold.adj_rib_in(D.adj_rib_in(rows)).select("router_id", "peer_address", "is_post_policy", "table_name", "afi", "prefix", "path_id", "peer_asn", "nexthop", "first_seen", "updated_at"))


def q_routers_decoded(spark, sf_dir):
    """routers of Initiations and of peers' session starts."""
    s = read(spark, sf_dir, "supplier").selectExpr("s_suppkey as seq", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(s_suppkey as int)) as time", "case when s_suppkey % 3 = 0 then 'peer_up' else 'router' end as kind", "false as is_loc_rib", "concat('10.0.0.', cast(s_suppkey % 5 as string)) as router_id", "s_name as sys_name", "concat('site ', cast(s_nationkey as string)) as sys_descr", "'198.51.100.1' as peer_address", "cast(70000 + s_nationkey as bigint) as local_asn")
    rows = D.identified(through(wrapped(s), "seq", "time"), ["seq"])
    return plain(history.merged_routers(history.router_updates(rows)).select("router_id", "router_ip", "hostname", "description", F.col("as_number").cast("string").alias("as_number"), "first_seen", "last_seen"))


def q_json_peer_feed(spark, sf_dir):
    e = read(spark, sf_dir, "events").selectExpr(*(f"{c} as {n}" for n, c in SESSION.items()))
    flag = F.when(F.col("seq") % 2 == 0, F.to_json(F.struct(F.col("is_loc_rib")))).otherwise(F.to_json(F.struct(F.col("is_loc_rib").cast("string").alias("is_loc_rib"))))
    names = F.to_json(F.struct(F.col("router_id").alias("bmp_router"), F.upper("kind").alias("action"), F.when(F.col("seq") % 5 > 0, F.col("table_name")).alias("table_name")))
    record = F.concat(F.substring(flag, F.lit(1), F.length(flag) - 1), F.lit(","), F.substring(names, 2, 10000))
    rows = jsonfeed.events(e.select("seq", F.lit("x.parsed.peer").alias("topic"), record.alias("value")), ["seq"])
    return rows.select("seq", "kind", "router_id", "table_name")


def q_summary_counts(spark, sf_dir):
    return plain(views.summary_counts(views.route_summary(fold.current_routes(loc(spark, sf_dir)))))


def feed(spark, sf_dir):
    """Events as JSON records."""
    e = loc(spark, sf_dir, True)
    record = F.to_json(F.struct(F.col("router_id").alias("router_ip"), F.col("is_loc_rib"), F.col("table_name"), (F.col("afi") == 4).alias("is_ipv4"), F.when(F.col("action") == "D", "del").otherwise("add").alias("action"), F.substring_index("prefix", "/", 1).alias("prefix"), C.masklen("prefix").alias("prefix_len"), "path_id", "nexthop", F.array_join("communities_std", ",").alias("community_list"), F.struct(F.col("as_path"), F.lit("igp").alias("origin"), (F.col("seq") % 100).alias("med")).alias("base_attrs"), F.concat(F.lit("x"), F.col("seq").cast("string")).alias("note")))
    return e.select("seq", "time", F.lit("routes.unicast_prefix_v4").alias("topic"), record.alias("value"))


def q_json_feed_decode(spark, sf_dir):
    return jsonfeed.events(feed(spark, sf_dir), ["seq"]).select("seq", *KEY, "action", "nexthop", "as_path", "origin", "med", F.col("origin_asn").cast("string").alias("origin_asn"), F.array_join("communities_std", " ").alias("communities"), F.col("attrs")["note"].alias("note"))


def q_origin_asn(spark, sf_dir):
    return loc(spark, sf_dir, True).select("seq", C.origin_asn("as_path").cast("string").alias("origin_asn"))


def q_event_id_sha256(spark, sf_dir):
    return stored_history(spark, sf_dir).select(F.lower(F.hex("event_id")).alias("event_id"), "prefix", "action")


def q_history_dedup(spark, sf_dir):
    return plain(history.deduplicated(stored_history(spark, sf_dir)).select(F.lower(F.hex("event_id")).alias("event_id"), "ingest_time"))


def q_retention_filter(spark, sf_dir):
    return plain(stored_history(spark, sf_dir).where(F.col("ingest_date") >= F.date_sub(F.lit("2024-01-30").cast("date"), 10)).groupBy(F.col("ingest_date").cast("string").alias("ingest_date")).agg(F.count("*").alias("events")))


def q_current_routes_fold(spark, sf_dir):
    return plain(fold.current_routes(loc(spark, sf_dir, True)).select(*KEY, "nexthop", "as_path", "first_seen", "updated_at"))


def q_current_routes_eor(spark, sf_dir):
    return plain(fold.current_routes(loc(spark, sf_dir).where("kind <> 'peer_down'")).select(*KEY, "nexthop", "first_seen", "updated_at"))


def q_current_routes_peer_down(spark, sf_dir):
    return plain(fold.current_routes(loc(spark, sf_dir)).select(*KEY, "nexthop", "first_seen", "updated_at"))


def q_first_seen(spark, sf_dir):
    return plain(fold.current_routes(loc(spark, sf_dir)).groupBy("router_id", "table_name", "afi").agg(F.min("first_seen").alias("oldest"), F.max("first_seen").alias("newest"), F.count_if(F.col("first_seen") < F.col("updated_at")).alias("renewed")))


def q_adj_rib_in_fold(spark, sf_dir):
    return plain(fold.adj_rib_in(adj(spark, sf_dir)).select("router_id", "peer_address", "is_post_policy", "table_name", "afi", "prefix", "path_id", "peer_asn", "nexthop", "first_seen", "updated_at"))


def q_sync_status(spark, sf_dir):
    return plain(fold.sync_status(loc(spark, sf_dir)).drop("last_raw_msg_time"))


def q_routers_merged(spark, sf_dir):
    return plain(routers_of(spark, sf_dir).select("router_id", "router_ip", "hostname", F.col("as_number").cast("string").alias("as_number"), "display_name", "first_seen", "last_seen"))


def q_asn_change_suppress(spark, sf_dir):
    e = mapped(spark, sf_dir, "events", ROUTE, "seq", "time", "router_id").join(read(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (64512 + F.col("user_id") % 3).cast("bigint").alias("local_asn")), "seq")
    e = e.withColumns({"kind": F.lit("peer_up"), "is_loc_rib": F.lit(False), "sys_name": F.lit(None).cast("string"), "sys_descr": F.lit(None).cast("string")})
    return history.router_updates(e).where("as_number is not null").select("seq", "router_id", "as_number")


def q_router_identity_asof(spark, sf_dir):
    e = read(spark, sf_dir, "events").selectExpr("event_id as seq", "case when event_type = 'signup' then 'peer_up' else 'route' end as kind", "false as is_loc_rib", "cast(null as string) as header_router", "concat('h', cast(user_id % 40 as string)) as router_hash", "concat('10.9.0.', cast(user_id % 200 as string)) as frame_ip", "case when event_type = 'signup' and event_id % 5 > 0 then concat('10.1.', cast(event_id % 200 as string), '.1') end as local_bgp_id")
    return D.identified(e, ["seq"]).select("seq", "router_id")


def q_route_summary(spark, sf_dir):
    return plain(views.route_summary(fold.current_routes(loc(spark, sf_dir))))


def q_adj_rib_in_summary(spark, sf_dir):
    return plain(views.adj_rib_in_summary(fold.adj_rib_in(adj(spark, sf_dir))))


def q_peers_overview(spark, sf_dir):
    return plain(views.peers_overview(fold.adj_rib_in(adj(spark, sf_dir)), routers_of(spark, sf_dir)))


def q_routers_overview(spark, sf_dir):
    e = loc(spark, sf_dir)
    return plain(views.routers_overview(routers_of(spark, sf_dir), fold.sync_status(e), fold.current_routes(e), fold.adj_rib_in(adj(spark, sf_dir)))).drop("description", "location").withColumns({c: F.col(c).cast("string") for c in ("as_number", "all_afis_synced")})


def current(spark, sf_dir):
    return fold.current_routes(loc(spark, sf_dir, True))


def q_routes_by_router(spark, sf_dir):
    return views.by_router(current(spark, sf_dir), "10.0.0.2").select("table_name", "afi", "prefix", "path_id", "nexthop")


def q_exact_prefix(spark, sf_dir):
    return views.exact_prefix(current(spark, sf_dir), "10.1.1.0/24").select(*KEY, "nexthop")


def q_routes_by_origin_as(spark, sf_dir):
    return views.by_origin(current(spark, sf_dir), 64530)


def q_routes_by_community(spark, sf_dir):
    return views.by_community(current(spark, sf_dir), "65001:7")


def q_routes_by_nexthop(spark, sf_dir):
    return views.by_nexthop(current(spark, sf_dir), "192.0.2.7")


def q_recent_changes(spark, sf_dir):
    return plain(views.changed_since(current(spark, sf_dir), F.lit("2024-01-29 00:00:00").cast("timestamp")).select(*KEY, "updated_at"))


def q_cross_router_prefix(spark, sf_dir):
    return views.across_routers(current(spark, sf_dir), "10.1.1.0/24")


def networks(spark, sf_dir):
    """Networks of lengths 8 to 24 from part numbers."""
    n = read(spark, sf_dir, "part").selectExpr("p_partkey", "cast(8 + p_partkey % 17 as int) as len", "cast(167772160 + (p_partkey * 7919) % 16777216 as bigint) as addr")
    return n.withColumn("net", F.expr("addr - addr % cast(power(2, 32 - len) as bigint)")).select(F.concat(C.ipv4_text("net"), F.lit("/"), F.col("len").cast("string")).alias("prefix"), "p_partkey")


def q_lpm(spark, sf_dir):
    asked = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(167772160 + (o_orderkey * 104729) % 16777216 as bigint) as n").select("o_orderkey", C.ipv4_text("n").alias("address"))
    nets = networks(spark, sf_dir).groupBy("prefix").agg(F.min("p_partkey").alias("p_partkey"))
    return views.longest_match(asked, nets).select("o_orderkey", "address", "prefix", F.col("route.p_partkey").alias("p_partkey"))


def q_prefix_history(spark, sf_dir):
    return plain(views.prefix_history(stored_history(spark, sf_dir), "10.0.0.1", "10.1.1.0/24").withColumn("origin_asn", F.col("origin_asn").cast("string")))


def q_churn_per_minute(spark, sf_dir):
    rows = stored_history(spark, sf_dir).where("router_id = '10.0.0.2'")
    return plain(views.churn(rows, F.lit("2024-01-20 00:00:00").cast("timestamp")))


def q_changes_in_window(spark, sf_dir):
    at = lambda t: F.lit(t).cast("timestamp")
    return plain(views.in_window(stored_history(spark, sf_dir), "10.0.0.2", at("2024-01-10 00:00:00"), at("2024-01-11 12:00:00")))


def q_sync_health(spark, sf_dir):
    return plain(views.sync_health(fold.sync_status(loc(spark, sf_dir)), routers_of(spark, sf_dir)))


def q_stale_sessions(spark, sf_dir):
    return plain(views.stale_sessions(fold.sync_status(loc(spark, sf_dir)), F.lit("2024-01-30 20:00:00").cast("timestamp"), 60))


def q_live_counts(spark, sf_dir):
    return views.live_counts(current(spark, sf_dir))


def q_acceptance_count(spark, sf_dir):
    return views.acceptance_count(current(spark, sf_dir))


def q_prefix_functions(spark, sf_dir):
    n = networks(spark, sf_dir)
    return n.select("p_partkey", C.masklen("prefix").alias("len"), C.ipv4_number("prefix").alias("number"), C.has_host_bits("prefix").alias("odd"), C.contains(F.lit("10.0.0.0/9"), "prefix").alias("held"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: f for name, f in globals().items() if name.startswith("q_")}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames to events to current routes to their summary."""
    return views.route_summary(fold.current_routes(roundtrip(spark, sf_dir).persist()))
