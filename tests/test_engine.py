"""State, JSON feed, history, views, streaming and upkeep."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from routelake import config, health, maintenance
from routelake.functions import columns as C
from routelake.functions import encode as e
from routelake.metrics import Metrics
from routelake.operators import decode, fold, history, jsonfeed, views
from routelake.plans import queries, sql
from routelake.sources import frames, tables
from routelake.streaming.ingest import Store, in_order, ingest, numbered

EVENT = "seq bigint, time timestamp, kind string, is_loc_rib boolean, router_id string, peer_address string, table_name string, afi int, prefix string, path_id bigint, action string, is_post_policy boolean, nexthop string"


def at(seq: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seq)


def random_events(rng: random.Random, n: int) -> list[tuple]:
    out = []
    for i in range(n):
        loc, kind = rng.random() < 0.6, rng.choices(["route", "eor", "peer_up", "peer_down"], [70, 12, 12, 5])[0]
        table = rng.choice(["t1", "t2", "" if kind == "peer_down" else "t1"])
        out.append((i, at(i), kind, loc, rng.choice("rs"), None if loc else rng.choice("pq"), table, rng.choice([4, 6]), rng.choice(["a", "b"]), 0, rng.choice("AAD"), None if loc else rng.random() < 0.5, f"n{i}"))
    return out


def played(events: list[tuple]) -> tuple[dict, dict, dict]:
    """The same state, one event after another."""
    loc, adj, sync, peers = {}, {}, {}, {}
    for seq, time, kind, is_loc, router, peer, table, afi, prefix, path, action, post, hop in events:
        if is_loc:
            scope = (router, table, afi)
            if kind == "peer_up":
                for f in (4, 6):
                    old = sync.get((router, table, f), {})
                    sync[router, table, f] = old | {"start": time, "eor": False, "end": None, "updated": time}
            elif kind == "peer_down":
                for x in [k for k in loc if k[0] == router and table in ("", k[1])]:
                    del loc[x]
                for x in [k for k in sync if k[0] == router and table in ("", k[1])]:
                    del sync[x]
                for x in [k for k in adj if k[0] == router]:
                    del adj[x]
                for x in [k for k in peers if k[0] == router]:
                    del peers[x]
            elif kind == "eor":
                if scope in sync:
                    sync[scope] |= {"eor": True, "end": time, "updated": time}
                    for x in [k for k, v in loc.items() if k[:3] == scope and v[1] < sync[scope]["start"]]:
                        del loc[x]
            else:
                if action == "A":
                    loc[(*scope, prefix, path)] = (loc.get((*scope, prefix, path), (time,))[0], time, hop)
                else:
                    loc.pop((*scope, prefix, path), None)
                sync[scope] = sync.get(scope, {"start": time, "eor": False, "end": None}) | {"parsed": time, "updated": time}
        elif kind == "peer_up":
            for f in (4, 6):
                peers[router, peer, f] = time
        elif kind == "peer_down":
            for x in [k for k in adj if k[:2] == (router, peer)]:
                del adj[x]
            for x in [k for k in peers if k[:2] == (router, peer)]:
                del peers[x]
        elif kind == "eor":
            if (router, peer, afi) in peers:
                for x in [k for k, v in adj.items() if k[:2] == (router, peer) and k[3:5] == (table, afi) and v[1] < peers[router, peer, afi]]:
                    del adj[x]
        else:
            key = (router, peer, post, table, afi, prefix, path)
            if action == "A":
                adj[key] = (adj.get(key, (time,))[0], time, hop)
            else:
                adj.pop(key, None)
    return loc, adj, sync


def held(df, key: int) -> dict:
    return {tuple(r)[:key]: (r.first_seen, r.updated_at, r.nexthop) for r in df.drop("seq").select(*df.columns[:key], "first_seen", "updated_at", "nexthop").collect()}


def routers_apart(rng: random.Random, count: int, n: int) -> list[tuple]:
    """Several random histories, told apart by router."""
    out = []
    for k in range(count):
        out += [(seq, time, kind, loc, f"{router}{k}", *rest) for seq, time, kind, loc, router, *rest in random_events(rng, rng.randint(5, n))]
    return out


def test_fold_plays_random_histories(spark):
    events = routers_apart(random.Random(3), 60, 120)
    df = spark.createDataFrame(events, EVENT)
    loc, adj, sync = played(sorted(events, key=lambda x: x[0]))
    assert held(fold.current_routes(df.where("is_loc_rib").drop("peer_address")), 5) == loc and loc
    assert held(fold.adj_rib_in(decode.adj_rib_in(df)), 7) == adj and adj
    status = {(r.router_id, r.table_name, r.afi): {"start": r.session_start_time, "eor": r.eor_seen, "end": r.eor_time, "updated": r.updated_at} | ({"parsed": r.last_parsed_msg_time} if r.last_parsed_msg_time else {}) for r in fold.sync_status(df.where("is_loc_rib")).collect()}
    # a session that begins anew keeps the time of its last route
    assert {k: {x: v for x, v in s.items() if x != "parsed"} for k, s in status.items()} == {k: {x: v for x, v in s.items() if x != "parsed"} for k, s in sync.items()}


def test_fold_with_many_markers_in_a_scope(spark):
    events = random_events(random.Random(5), 4000)
    df = spark.createDataFrame(events, EVENT)
    loc, adj, _ = played(events)
    own, peers = df.where("is_loc_rib").drop("peer_address"), decode.adj_rib_in(df)
    assert held(fold.current_routes(own), 5) == loc and held(fold.adj_rib_in(peers), 7) == adj
    # without Peer Downs all session starts count; with and without broadcasts, in parts
    for kinds in ("true", "kind <> 'peer_down'"):
        some, keys = own.where(kinds), ["router_id", "table_name", "afi", "prefix", "path_id"]
        want = played([x for x in events if x[3] and (kinds == "true" or x[2] != "peer_down")])[0]
        for most in (0, fold.BROADCAST_PURGES):
            assert held(fold.live(some.where("kind = 'route'"), keys, fold.loc_purges(some), ["nexthop"], None, most), 5) == want and want


def test_fold_carries_no_markers_with_routes(spark):
    # else the rows that are shuffled and sorted grow with the markers of their scope
    kinds = ["peer_up", "eor", "route", "route", "peer_down", "route", "route"]
    df = spark.createDataFrame([(i, at(i), kinds[i % 7], True, "r", None, "t", 4, f"p{i % 5}", 0, "A", None, "n") for i in range(700)], EVENT).drop("peer_address")
    made = fold.current_routes(df)
    plan = made._jdf.queryExecution().optimizedPlan()
    while not plan.nodeName().startswith("Window"):
        plan = plan.children().apply(0)
    assert "array" not in [plan.output().apply(i).dataType().typeName() for i in range(plan.output().size())]
    assert held(made, 5) == {("r", "t", 4, f"p{i % 5}", 0): (at(i), at(i), "n") for i in (698, 699)}


def below_windows(made) -> int:
    """How many rows the windows of a plan are given."""
    plan = made._jdf.queryExecution().optimizedPlan()
    found = []
    while plan.children().size():
        if plan.nodeName().startswith("Window"):
            found = [plan.children().apply(0)]
        plan = plan.children().apply(0)
    session = made.sparkSession
    return session._jvm.org.apache.spark.sql.classic.Dataset.ofRows(session._jsparkSession, found[0]).count()


def test_fold_without_peer_downs_leaves_out_what_was_withdrawn(spark):
    # else all rows of a history are shuffled and sorted for the few that are left; keys may hold nulls
    kinds = ["peer_up", "route", "route", "route", "eor"]
    events = [(i, at(i), kinds[i % 5], True, "r", None, "t" if i % 3 else None, 4, f"p{i % 4}", 0, "D" if i % 7 == 0 else "A", None, f"n{i}") for i in range(2000)]
    df = spark.createDataFrame(random.Random(2).sample(events, len(events)), EVENT).drop("peer_address")
    keys, routes = ["router_id", "table_name", "afi", "prefix", "path_id"], df.where("kind = 'route'")
    made = fold.current_routes(df)
    all_rows = fold.live(routes, keys, fold.loc_purges(df), ["nexthop"], None, 4)  # there are 8 keys
    assert below_windows(made) < 100 < below_windows(all_rows) == routes.count()
    assert held(made, 5) == held(all_rows, 5) and len(held(made, 5)) > 5
    named = [x for x in events if x[6]]
    assert {k: v for k, v in held(made, 5).items() if k[1]} == played(named)[0]


def test_batches_give_the_same_state(spark, tmp_path):
    events = routers_apart(random.Random(4), 25, 60)
    whole = spark.createDataFrame(events, EVENT).withColumn("seq", F.col("seq").cast("bigint"))
    loc, adj, sync = played(sorted(events, key=lambda x: x[0]))
    store = Store(spark, str(tmp_path / "store"))
    empty = {"peer_asn": "bigint", "peer_bgp_id": "string", "as_path": "string", "origin": "string", "localpref": "bigint", "med": "bigint", "origin_asn": "bigint", "communities_std": "array<string>", "communities_ext": "array<string>", "communities_large": "array<string>", "attrs": "map<string,string>"}
    whole = whole.withColumns({k: F.lit(None).cast(t) for k, t in empty.items()})
    cuts = [0, 9, 30, 200]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        store.fold_batch(whole.where((F.col("seq") >= a) & (F.col("seq") < b)), i)
        store.fold_batch(whole.limit(0), i)  # again: nothing happens
    assert held(store.current.read(), 5) == loc
    assert {k: v for k, v in held(store.peers.read().select("router_id", "peer_address", "is_post_policy", "table_name", "afi", "prefix", "path_id", "first_seen", "updated_at", "nexthop"), 7).items()} == adj
    got = {(r.router_id, r.table_name, r.afi): (r.session_start_time, r.eor_seen, r.eor_time, r.updated_at) for r in store.status().collect()}
    assert got == {k: (s["start"], s["eor"], s["end"], s["updated"]) for k, s in sync.items()}
    text = store.metrics.text()
    assert 'kafka_messages_total{action="A",afi="4",pipeline="state",topic=""}' in text and 'kafka_messages_total{action="adj_A"' in text
    for series in ('db_rows_affected_total{op="upsert",pipeline="state",table="current_routes"}', 'db_write_duration_seconds_count{op="batch",pipeline="state"}', 'routes_purged_total{reason="session_down"}', 'routes_purged_total{reason="adj_eor_stale"}', 'batch_size_bucket{pipeline="state",le="2000"}'):
        assert series in text


def test_stream_from_files_equals_batch(spark, tmp_path):
    source = queries.loc(spark, "/root/testdata/sf0.001", True).withColumn("localpref", F.lit(7)).orderBy("seq").limit(300)
    records = frames.encoded(source, ["seq"]).select("value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.timestamp_seconds("seq").alias("timestamp"))
    rows = records.orderBy("offset").collect()
    bad = rows[0].asDict() | {"value": b"no frame", "offset": 10**6, "timestamp": dt.datetime(2030, 1, 1)}
    for k in range(3):
        part = rows[k * 100 : (k + 1) * 100] + ([bad] if k == 2 else [])
        spark.createDataFrame([tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in part], frames.RECORD).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
    store, seen = Store(spark, str(tmp_path / "out")), tmp_path / "in"
    seen.mkdir()
    for k in range(3):
        for f in (tmp_path / f"in{k}").glob("part*"):
            f.rename(seen / f"{k}{f.name}")
        query = ingest(store, frames.file_stream(spark, str(seen)), str(tmp_path / "check"))  # a restart each time
        query.awaitTermination()
    key = ["router_id", "table_name", "afi", "prefix", "path_id", "nexthop"]
    want = sorted(map(str, fold.current_routes(source).select(*key).collect()))
    assert sorted(map(str, store.current.read().select(*key).collect())) == want and want
    assert store.history.read().count() == 300 and store.places["state"].read().first()[0] == 301
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 1
    assert 'parse_errors_total{reason="openbmp_decode",stage="raw"} 1' in store.metrics.text() and 'db_rows_affected_total{op="insert",pipeline="history",table="route_events"} 300' in store.metrics.text()
    assert store.status().where("last_raw_msg_time is not null").count() == store.status().count() > 0
    assert store.history.compact("1970-01-01") and not store.history.compact("1970-01-01")
    assert store.history.read().count() == 300 and len(list((tmp_path / "out/route_events/ingest_date=1970-01-01").glob("batch=*"))) == 1
    views.register(**store.views())
    assert views.ask(spark, "match_one", address="10.1.1.9").first().prefix == "10.1.1.0/24"
    assert spark.sql("select sum(route_count) from routers_overview").first()[0] == len(want)
    gone = maintenance.run(spark, store, 30, now=dt.datetime(2024, 1, 1, tzinfo=dt.UTC))
    assert gone == ["1970-01-01"] and store.history.days() == []
    assert spark.read.parquet(str(tmp_path / "out/route_summary/v=0")).count() > 0


def feed(spark, *records, topic="x.unicast_prefix_v4"):
    return spark.createDataFrame([(i, topic, json.dumps(r) if not isinstance(r, str) else r) for i, r in enumerate(records)], "offset int, topic string, value string")


def test_json_routes(spark):
    base = {"router_ip": "10.0.0.1", "is_loc_rib": True, "prefix": "10.0.0.0", "prefix_len": 24}
    rows = jsonfeed.decode_routes(feed(
        spark, base, base | {"router_hash": "h", "action": "DEL", "is_ipv4": False, "path_id": "7", "local_pref": None, "med": 1.0, "x": 1}, base | {"prefix": "10.1.0.0/16", "community_list": "64496:100, 64496:200", "large_community_list": ["1:2:3", 4], "ext_community_list": "a  b"},
        base | {"base_attrs": {"as_path": [65002, "65001"], "origin": "igp", "nexthop": "1.1.1.1", "local_pref": 5, "community_list": ["1:1"]}}, {"router_ip": "r", "is_eor": "TRUE"}, {"prefix": "1.0.0.0/8"}, {"router_ip": "r"}, "no json", "[1]", base | {"prefix": "0.0.0.0", "prefix_len": 0}, base | {"med": -1, "community_list": ""},
    ), ["offset"], F.lit(4)).orderBy("offset").collect()
    a, b, c, d, eor = rows[:5]
    assert (a.prefix, a.table_name, a.afi, a.action, a.path_id, a.localpref, a.attrs, a.kind) == ("10.0.0.0/24", "UNKNOWN", 4, "A", 0, None, None, "route")
    assert (b.router_id, b.action, b.afi, b.path_id, b.localpref, b.med, b.attrs) == ("h", "D", 6, 7, 0, 1, {"x": "1"})
    assert (c.prefix, c.communities_std, c.communities_large, c.communities_ext) == ("10.1.0.0/16", ["64496:100", "64496:200"], ["1:2:3"], ["a", "", "b"])
    assert (d.as_path, d.origin_asn, d.origin, d.nexthop, d.localpref, d.communities_std) == ("65002 65001", 65001, "igp", "1.1.1.1", 5, ["1:1"])
    assert (eor.kind, eor.prefix) == ("eor", None)
    assert [r.error for r in rows[5:9]] == ["no router identifier", "no prefix", "not a JSON object", "not a JSON object"]
    assert rows[9].prefix == "0.0.0.0/0" and rows[10].med == 2**32 - 1 and rows[10].communities_std is None


def test_json_peers(spark):
    rows = jsonfeed.events(feed(spark, {"bmp_router": "r", "action": "PEER_UP", "is_loc_rib": "true"}, {"bmp_router": "r", "action": "peer_down", "is_loc_rib": True, "table_name": "t"}, {"bmp_router": "r", "action": "other", "is_loc_rib": True}, {"bmp_router": "r", "action": "peer_up"}, topic="x.parsed.peer"), ["offset"]).orderBy("offset").collect()
    assert [(r.kind, r.table_name) for r in rows] == [("peer_up", ""), ("peer_down", "t")]


def test_identity_comes_from_the_last_peer_up_before(spark):
    up = e.message(3, e.peer_header(0, 0, "10.9.9.9", 65001, "10.9.9.9") + bytes(20) + e.open_message(65002, "10.0.0.1") + e.open_message(1, "9.9.9.9"))
    route = e.message(0, e.peer_header(0, 0, "10.9.9.9", 65001, "10.9.9.9") + e.update(nlri=e.prefix("10.0.0.0/24")))
    loc = e.message(0, e.peer_header(bgp_id="7.7.7.7") + e.update(nlri=e.prefix("10.0.0.0/24")))
    values = [e.frame_17(route, b"h" * 16, "172.30.0.30"), e.frame_17(up + loc, b"h" * 16, "172.30.0.30"), e.frame_17(route, b"h" * 16, "172.30.0.30"), e.frame_17(route, b"g" * 16, "172.30.0.31"), b"damaged frame"]
    rows = decode.decode(spark.createDataFrame(list(enumerate(values)), "seq int, value binary"), ["seq"])
    got = decode.identified(rows, ["seq", "msg_index", "event_index"]).orderBy("seq", "msg_index").collect()
    assert [(r.seq, r.kind, r.router_id) for r in got] == [(0, "route", "172.30.0.30"), (1, "peer_up", "10.0.0.1"), (1, "route", "7.7.7.7"), (2, "route", "10.0.0.1"), (3, "route", "172.30.0.31"), (4, "error", None)]
    assert [r.table_name for r in decode.routed(rows).where("kind = 'route' and not is_loc_rib").collect()] == [""] * 3
    assert decode.quarantine(rows).count() == 1


def test_events_meet_names_without_a_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = queries.q_adj_rib_in_decoded(spark, "/root/testdata/sf0.001")
        names = queries.q_router_identity_asof(spark, "/root/testdata/sf0.001")
        plan = names._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and names.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
        # decoded once, and no more columns are kept than the fold and the names need
        caches = kept._jdf.queryExecution().optimizedPlan().toString().split("InMemoryRelation [")[1:]
        assert caches and all(len(c.split("]")[0].split(",")) == 17 for c in caches)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.catalog.clearCache()


def test_history_and_routers(spark):
    values = [e.frame(e.message(0, e.peer_header(flags=0x80, bgp_id="1.1.1.1") + e.update(nlri=e.prefix("10.0.0.0/24", 1) + e.prefix("10.0.0.0/24", 2))), c) for c in (1, 2)]
    rows = decode.routed(decode.identified(decode.decode(spark.createDataFrame([(i, at(i), v) for i, v in enumerate(values)], "seq int, time timestamp, value binary"), ["seq", "time"]), ["seq"]))
    made = history.rows(rows)
    assert made.count() == 4 and history.deduplicated(made).count() == 1
    apart = decode.decode(spark.createDataFrame([(v,) for v in values], "value binary"), [], include_path_id=True)
    assert apart.select("event_id").distinct().count() == 2
    raw = bytes(history.compressed(made).first().bmp_raw)
    assert raw[:4] == bytes.fromhex("28B52FFD")
    up = [(0, "r", False, 65001), (1, "r", False, 65001), (2, "r", True, None), (3, "r", False, 65002)]
    ups = spark.createDataFrame([(s, at(s), "peer_up", r, loc, asn, None, None) for s, r, loc, asn in up], "seq bigint, time timestamp, kind string, router_id string, is_loc_rib boolean, local_asn bigint, sys_name string, sys_descr string")
    meta = spark.createDataFrame([("r", "core", "here")], "router_id string, display_name string, location string")
    updates = history.router_updates(ups, meta)
    assert sorted(r.seq for r in updates.collect()) == [0, 2, 3]
    r = history.merged_routers(updates).first()
    assert (r.router_ip, r.as_number, r.display_name, r.first_seen, r.last_seen) == ("r", 65002, "core", at(0), at(3))
    old = history.merged_routers(updates.where("seq = 0"))
    assert history.merged_routers(updates.where("seq = 2"), old).first().as_number == 65001


def test_networks(spark):
    rows = [("10.0.0.0/8", "10.1.2.3", True), ("10.0.0.0/8", "11.0.0.0", False), ("10.1.0.0/16", "10.0.0.0/8", False), ("2001:db8::/32", "2001:db8:1::5", True), ("2001:db8::/32", "10.0.0.1", False), ("::/0", "::1", True), ("0.0.0.0/0", "255.255.255.255", True), ("::ffff:1.2.3.0/120", "::ffff:1.2.3.4", True), ("fe80::/10", "febf::1", True)]
    df = spark.createDataFrame(rows, "p string, a string, want boolean")
    assert df.where(~C.contains("p", "a").eqNullSafe(F.col("want"))).count() == 0
    odd = spark.createDataFrame([("10.0.0.1/8", True), ("10.0.0.0/8", False), ("2001:db8::1/64", True), ("2001:db8::/64", False)], "p string, want boolean")
    assert odd.where(C.has_host_bits("p") != F.col("want")).count() == 0
    nets = spark.createDataFrame([("0.0.0.0/0",), ("10.0.0.0/8",), ("10.1.0.0/16",), ("2001:db8::/32",), ("2001:db8:1::/48",)], "prefix string")
    asked = spark.createDataFrame([("10.1.2.3",), ("10.2.0.0",), ("8.8.8.8",), ("2001:db8:1::9",), ("2001:dead::",)], "address string")
    got = {r.address: r.prefix for r in views.longest_match(asked, nets).collect()}
    assert got == {"10.1.2.3": "10.1.0.0/16", "10.2.0.0": "10.0.0.0/8", "8.8.8.8": "0.0.0.0/0", "2001:db8:1::9": "2001:db8:1::/48"}
    assert views.match_one(nets, "10.1.2.3").first().prefix == "10.1.0.0/16" and views.match_one(nets, "2001:db8::7").first().prefix == "2001:db8::/32"
    order = [r.prefix for r in spark.createDataFrame([("2001:db8::/32",), ("10.0.0.0/16",), ("10.0.0.0/8",), ("9.0.0.0/8",), ("200.0.0.0/8",), ("fe80::/10",)], "prefix string").orderBy(C.sort_key("prefix")).collect()]
    assert order == ["9.0.0.0/8", "10.0.0.0/8", "10.0.0.0/16", "200.0.0.0/8", "2001:db8::/32", "fe80::/10"]
    assert [r.x for r in spark.sql("select map('b', 'dead', 'a', '1') as m union all select map()").select(C.attrs_json("m").alias("x")).collect()] == ['{"a":"1","b":"dead"}', None]
    paths = [("64496 64497", 64497), (" 1  2 ", 2), ("1 {2,3}", None), ("", None), (None, None), ("12x", 12)]
    assert all(r.x == r.want for r in spark.createDataFrame(paths, "p string, want bigint").select(C.origin_asn("p").alias("x"), "want").collect())


def test_state_and_history_have_queries_of_their_own(spark, tmp_path):
    """The history goes on while the state stands still; stored bytes are compressed, or left out."""
    source = queries.loc(spark, "/root/testdata/sf0.001", True).withColumn("localpref", F.lit(7)).orderBy("seq").limit(50)
    records = frames.encoded(source, ["seq"]).select("value", F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("seq").alias("offset"), F.timestamp_seconds("seq").alias("timestamp"))
    records.coalesce(1).write.parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "out"))
    store.create()
    stream = lambda: frames.file_stream(spark, str(tmp_path / "in"))
    ingest(store, stream(), str(tmp_path / "c1"), pipelines=("history",), compress=True).awaitTermination()
    assert store.history.read().count() == 50 and store.current.read().count() == 0
    assert bytes(store.history.read().first().bmp_raw)[:4] == bytes.fromhex("28B52FFD")
    ingest(store, stream(), str(tmp_path / "c2"), pipelines=("state",)).awaitTermination()
    assert store.history.read().count() == 50 and store.current.read().count() == fold.current_routes(source).count() > 0
    plain = Store(spark, str(tmp_path / "plain"))
    ingest(plain, stream(), str(tmp_path / "c3"), pipelines=("history",), keep_raw=False).awaitTermination()
    assert plain.history.read().where("bmp_raw is null").count() == 50


def test_read_queries_in_sql_equal_functions(spark):
    sf = "/root/testdata/sf0.001"
    routes, history_, status, routers = queries.current(spark, sf).cache(), queries.stored_history(spark, sf).cache(), fold.sync_status(queries.loc(spark, sf)).cache(), queries.routers_of(spark, sf).cache()
    views.register(current_routes=routes, route_events=history_, rib_sync_status=status, routers=routers, route_summary=views.route_summary(routes))
    since = dt.datetime(2024, 1, 20)
    stop, now = since + dt.timedelta(days=2), dt.datetime(2024, 1, 30, 23)
    event = history_.where("nexthop is not null").first()
    prefix = routes.first().prefix
    some = routes.where("as_path is not null and origin_asn is not null").first()
    for name, own, args in (
        ("by_router", views.by_router(routes, "10.0.0.2"), {"router_id": "10.0.0.2"}),
        ("exact_prefix", views.exact_prefix(routes, prefix), {"prefix": prefix}),
        ("match_one", views.match_one(routes.where("router_id = '10.0.0.2'"), "10.1.1.9"), None),
        ("by_origin", views.by_origin(routes, some.origin_asn), {"asn": some.origin_asn}),
        ("by_community", views.by_community(routes, some.communities_std[0]), {"community": some.communities_std[0]}),
        ("by_nexthop", views.by_nexthop(routes, some.nexthop), {"nexthop": some.nexthop}),
        ("changed_since", views.changed_since(routes, F.lit(since)), {"since": since}),
        ("across_routers", views.across_routers(routes, prefix), {"prefix": prefix}),
        ("prefix_history", views.prefix_history(history_, event.router_id, event.prefix), {"router_id": event.router_id, "prefix": event.prefix}),
        ("churn", views.churn(history_.where("router_id = '10.0.0.2'"), F.lit(since)), {"router_id": "10.0.0.2", "since": since}),
        ("in_window", views.in_window(history_, "10.0.0.2", F.lit(since), F.lit(stop)), {"router_id": "10.0.0.2", "start": since, "stop": stop}),
        ("sync_health", views.sync_health(status, routers), {}),
        ("stale_sessions", views.stale_sessions(status, F.lit(now)), {"now": now}),
        ("summary_counts", views.summary_counts(views.route_summary(routes)), {}),
        ("live_counts", views.live_counts(routes), {}),
    ):
        if args is None:
            assert views.ask(spark, name, address="10.1.1.9").select("prefix").collect() == views.match_one(routes, "10.1.1.9").select("prefix").collect() != []
            continue
        found = views.ask(spark, name, **args)
        assert sorted(map(str, found.select(*own.columns).collect())) == sorted(map(str, own.collect())) != [], name


def test_rows_are_numbered_without_gaps(spark):
    rows = in_order(spark.range(1000).withColumn("x", F.col("id") * 7919 % 1000), ["x"]).withColumn("_id", F.monotonically_increasing_id()).persist()
    made, after = numbered(rows, 5)
    assert after == 1005 and [(r.x, r.seq) for r in made.orderBy("seq").collect()] == [(i, i + 5) for i in range(1000)]
    assert numbered(rows.limit(0).withColumn("_id", F.monotonically_increasing_id()).persist(), 9)[1] == 9


def test_parts_that_no_batch_touches_stay(spark, tmp_path):
    table = tables.Parted(spark, str(tmp_path / "t"), "router_id string, a int", parts=8)
    rows = spark.createDataFrame([(f"r{i}", i) for i in range(40)], table.schema)
    every = table.touched(rows)
    table.write(rows, 0, every)
    part = table.touched(rows.where("router_id = 'r3'"))
    for v in range(1, 5):
        table.write(table.read(part).withColumn("a", F.when(F.col("router_id") == "r3", 100 + v).otherwise(F.col("a"))), v, part)
        table.write(rows, v, every)  # again: nothing happens
    assert {(r.router_id, r.a) for r in table.read().collect()} == {(f"r{i}", 104 if i == 3 else i) for i in range(40)}
    assert sorted(set(table.places(4).values())) == [0, 4] and not (tmp_path / "t/v=1").exists() and not (tmp_path / f"t/v=0/part={part[0]}").exists()
    table.write(rows.limit(0), 5, part)  # a part that has become empty
    assert table.read(part).count() == 0 and table.read().count() == 40 - rows.where(table.part() == part[0]).count()


def test_history_reads_only_the_days_of_a_batch(spark, tmp_path):
    made = queries.stored_history(spark, "/root/testdata/sf0.001").limit(200).withColumn("seq", F.monotonically_increasing_id()).cache()
    once = history.deduplicated(made, place="seq").drop("seq")
    assert sorted(map(str, once.select("event_id", "ingest_time").collect())) == sorted(map(str, history.deduplicated(made.drop("seq")).select("event_id", "ingest_time").collect()))
    once.write.partitionBy("ingest_date").parquet(str(tmp_path / "h"))
    stored = spark.read.schema(once.schema).parquet(str(tmp_path / "h"))
    day = once.first().ingest_date
    left = history.fresh(once.where(F.col("ingest_date") == day), stored)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert left.count() == 0 and "PartitionFilters: [isnotnull(ingest_date" in plan and str(day) in plan


def test_plans_stay_declarative(spark):
    frame = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    assert all(frame(queries.queries()[n](spark, "/root/testdata/sf0.001")) == 2 for n in queries.queries() if n.startswith("roundtrip"))  # encoded once, decoded once
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    lpm = plan(queries.queries()["lpm"](spark, "/root/testdata/sf0.001"))
    assert "NestedLoop" not in lpm and "Cartesian" not in lpm
    assert "PushedFilters: [IsNotNull(" in plan(spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id = 5"))
    assert set(sql.SQL) == set(queries.queries())


def test_versions_and_days(spark, tmp_path):
    table = tables.Versioned(spark, str(tmp_path / "t"), "a int")
    assert table.read().count() == 0 and table.version() == -1
    for v in range(4):
        table.write(spark.createDataFrame([(v,)], "a int"), v)
    table.write(spark.createDataFrame([(9,)], "a int"), 2)
    assert table.version() == 3 and table.read().first().a == 3 and not (tmp_path / "t/v=0").exists()
    assert maintenance.migrate(spark, str(tmp_path), {2: lambda s: None, 1: lambda s: None}) == [1, 2]
    assert maintenance.migrate(spark, str(tmp_path), {3: lambda s: None, 1: lambda s: None}) == [3]
    assert tables.Files(spark, str(tmp_path)).claim(f"{tmp_path}/schema_migrations/lock")
    with pytest.raises(TimeoutError):
        maintenance.migrate(spark, str(tmp_path), {4: lambda s: None}, wait=0.1)
    assert maintenance.until_midnight("Asia/Tokyo", dt.datetime(2025, 1, 31, 14, 59, tzinfo=dt.UTC)) == 60
    now = dt.datetime(2025, 1, 31, 23, 30, tzinfo=dt.UTC)
    assert maintenance.expired(["2025-01-01", "2025-01-02", "junk"], 30, "UTC", now) == [] and maintenance.expired(["2024-12-31", "2025-01-01"], 30, "Asia/Tokyo", now) == ["2024-12-31", "2025-01-01"]
    assert [maintenance.is_partition(n) for n in ("route_events_20250115", "route_events_2025011", "route_events_20250115; x", "route_events_20250115\n")] == [True, False, False, False]
    assert maintenance.partition_name(maintenance.upcoming("Asia/Tokyo", now)[0]) == "route_events_20250201"


def test_config(tmp_path):
    env = {"ROUTELAKE_KAFKA__BROKERS": "a:1,b:2", "ROUTELAKE_STORAGE__PATH": "/x", "ROUTELAKE_KAFKA__STATE__TOPICS": "t1,t2", "ROUTELAKE_KAFKA__HISTORY__TOPICS": "t3", "ROUTELAKE_INGEST__BATCH_SIZE": "5"}
    c = config.load(environ=env)
    assert c.kafka.brokers == ["a:1", "b:2"] and c.ingest.batch_size == 5 and c.retention.days == 30 and c.kafka.fetch_max_bytes == 52428800
    for name in ("KAFKA__BROKERS", "STORAGE__PATH", "KAFKA__STATE__TOPICS", "KAFKA__HISTORY__TOPICS"):
        with pytest.raises(ValueError, match="required"):
            config.load(environ={k: v for k, v in env.items() if k != f"ROUTELAKE_{name}"})
    for name, value in (("RETENTION__DAYS", "0"), ("INGEST__BATCH_SIZE", "-1"), ("RETENTION__TIMEZONE", "Mars/X"), ("INGEST__MAX_PAYLOAD_BYTES", "99999999"), ("SERVICE__SHUTDOWN_TIMEOUT_SECONDS", "0")):
        with pytest.raises(ValueError):
            config.load(environ=env | {f"ROUTELAKE_{name}": value})
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"routers": {"10.0.0.1": {"name": "core", "location": "x"}}, "kafka": {"tls": {"enabled": True, "ca_file": "/ca"}, "sasl": {"enabled": True, "username": "u", "password": 'p"'}}}))
    c = config.load(str(path), env)
    options = frames.kafka_options(c.kafka, c.kafka.state.group_id, c.kafka.state.topics)
    assert c.routers["10.0.0.1"].name == "core" and options["kafka.security.protocol"] == "SASL_SSL" and 'password="p\\""' in options["kafka.sasl.jaas.config"]
    (tmp_path / "cert").write_text("CERT")
    (tmp_path / "key").write_text("KEY")
    c.kafka.tls.cert_file, c.kafka.tls.key_file = str(tmp_path / "cert"), str(tmp_path / "key")
    options = frames.kafka_options(c.kafka, "g", ["t"])
    assert (options["kafka.ssl.keystore.type"], options["kafka.ssl.keystore.certificate.chain"], options["kafka.ssl.keystore.key"]) == ("PEM", "CERT", "KEY")
    c.kafka.sasl.mechanism = "SCRAM"
    assert "kafka.sasl.mechanism" not in frames.kafka_options(c.kafka, "g", ["t"])
    assert config.redacted("postgres://u:secret@h/db password=x y") == "postgres://u:***@h/db password=*** y"


def test_health():
    import urllib.error
    import urllib.request

    class Query:
        name, isActive = "state", True

        def exception(self):
            return None

    assert health.readiness([Query()], lambda: True)[0] == 200 and health.readiness([Query()], lambda: False)[0] == 503
    metrics = Metrics()
    metrics.add("parse_errors_total", kind="frame")
    metrics.sample("batch_size", 30)
    with metrics.timed(table="x"):
        pass
    server = health.serve("127.0.0.1:0", [Query()], lambda: True, metrics)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    assert json.loads(urllib.request.urlopen(f"{url}/healthz").read())["status"] == "ok"
    assert 'parse_errors_total{kind="frame"} 1' in urllib.request.urlopen(f"{url}/metrics").read().decode()
    with pytest.raises(urllib.error.HTTPError):
        urllib.request.urlopen(f"{url}/other")
    server.shutdown()
