"""DuckDB SQL of the registered queries."""

from __future__ import annotations

from .queries import PEER_ROUTE, ROUTE, SESSION, sql

KEY = "router_id, table_name, afi, prefix, path_id"
EVENTS = sql(ROUTE, "events")
ALL_ROUTES = EVENTS.replace(f"{ROUTE['kind']} as kind", "'route' as kind")
PEERS = sql(PEER_ROUTE, "lineitem")

ROUTERS = """
select router_id, router_id as router_ip, arg_max(hostname, seq) filter (hostname is not null) as hostname, arg_max(as_number, seq) filter (as_number is not null) as as_number,
  arg_max(display_name, seq) filter (display_name is not null) as display_name, min(time) as first_seen, max(time) as last_seen
from (select s_suppkey as seq, timestamp '2024-01-01' + to_minutes(s_suppkey) as time, '10.0.0.' || (s_suppkey % 5) as router_id, case when s_suppkey % 7 = 0 then s_name end as hostname,
  case when s_suppkey % 3 = 0 then (64500 + s_nationkey)::bigint end as as_number, case when s_suppkey % 11 = 0 then 'site ' || s_nationkey end as display_name from supplier)
group by router_id"""


def folded(events: str, key: str, scopes: list[tuple[str, str]]) -> str:
    """Live routes. scopes: (purges: columns of a scope, at, below; join condition between route r and purge p)."""
    gone = lambda after, before: " or ".join(f"exists (select 1 from ({rows}) p where {on} and p.below > {after} and p.at < {before})" for rows, on in scopes)
    return f"""
with ev as ({events}),
r as (select *, lag(seq) over k as pseq, lag(action) over k as paction, lead(seq) over k is null as is_last from ev where kind = 'route' and (is_loc_rib = (select bool_and(is_loc_rib) from ev)) window k as (partition by {key} order by seq)),
s as (select r.*, case when action = 'A' and (pseq is null or paction = 'D' or {gone("r.pseq", "r.seq")}) then time end as start from r),
f as (select *, last_value(start ignore nulls) over (partition by {key} order by seq rows unbounded preceding) as first_seen from s),
live as (select r.* exclude (start), time as updated_at from f r where is_last and action = 'A' and not ({gone("r.seq", "9223372036854775807")}))
"""


UP = "select router_id, table_name, unnest([4, 6])::int as afi, seq from ev where kind = 'peer_up'"
LOC_SCOPES = [
    (f"select e.router_id, e.table_name, e.afi, e.seq as at, max(u.seq) as below from ev e join ({UP}) u on u.router_id = e.router_id and u.table_name = e.table_name and u.afi = e.afi and u.seq < e.seq where e.kind = 'eor' group by all", "p.router_id = r.router_id and p.table_name = r.table_name and p.afi = r.afi"),
    ("select router_id, table_name, seq as at, seq as below from ev where kind = 'peer_down'", "p.router_id = r.router_id and p.table_name = r.table_name"),
]
PEER_UP = "select router_id, peer_address, unnest([4, 6])::int as afi, seq from ev where kind = 'peer_up'"
PEER_SCOPES = [
    (f"select e.router_id, e.peer_address, e.table_name, e.afi, e.seq as at, max(u.seq) as below from ev e join ({PEER_UP}) u on u.router_id = e.router_id and u.peer_address = e.peer_address and u.afi = e.afi and u.seq < e.seq where e.kind = 'eor' group by all", "p.router_id = r.router_id and p.peer_address = r.peer_address and p.table_name = r.table_name and p.afi = r.afi"),
    ("select router_id, peer_address, seq as at, seq as below from ev where kind = 'peer_down'", "p.router_id = r.router_id and p.peer_address = r.peer_address"),
]
PEER_KEY = "router_id, peer_address, is_post_policy, table_name, afi, prefix, path_id"
CURRENT = folded(EVENTS, KEY, LOC_SCOPES)
PLAIN = f"with live as (select *, time as updated_at from ({ALL_ROUTES}) qualify row_number() over (partition by {KEY} order by seq desc) = 1 and action = 'A') "
ADJ = folded(PEERS, PEER_KEY, PEER_SCOPES)
HISTORY = f"(select *, sha256(router_id || '|' || (seq & -2) || prefix || '/' || action) as event_id, time as ingest_time from ({ALL_ROUTES}))"

STATUS = f"""
select router_id, table_name, afi, arg_max(time, seq) filter (kind = 'route') as last_parsed_msg_time,
  coalesce(max(seq) filter (kind = 'eor') > greatest(min(seq) filter (kind <> 'eor'), coalesce(max(seq) filter (kind = 'peer_up'), -1)), false) as eor_seen,
  case when max(seq) filter (kind = 'eor') > greatest(min(seq) filter (kind <> 'eor'), coalesce(max(seq) filter (kind = 'peer_up'), -1)) then arg_max(time, seq) filter (kind = 'eor') end as eor_time,
  coalesce(arg_max(time, seq) filter (kind = 'peer_up'), arg_min(time, seq) filter (kind = 'route')) as session_start_time,
  case when max(seq) filter (kind = 'eor') > min(seq) filter (kind <> 'eor') then arg_max(time, seq) else arg_max(time, seq) filter (kind <> 'eor') end as updated_at
from (
  select m.* from (
    select router_id, table_name, afi, kind, seq, time from ({EVENTS}) where kind in ('route', 'eor')
    union all select router_id, table_name, unnest([4, 6])::int, kind, seq, time from ({EVENTS}) where kind = 'peer_up'
  ) m left join (select router_id, table_name, max(seq) as down from ({EVENTS}) where kind = 'peer_down' group by all) d using (router_id, table_name) where m.seq > coalesce(d.down, -1)
) group by router_id, table_name, afi having count(*) filter (kind <> 'eor') > 0"""

NETWORKS = "(select p_partkey, len, addr - addr % (1::bigint << (32 - len)) as net from (select p_partkey, (8 + p_partkey % 17)::int as len, (167772160 + (p_partkey * 7919) % 16777216)::bigint as addr from part))"


def text(n: str) -> str:
    return f"(({n}) >> 24) || '.' || ((({n}) >> 16) & 255) || '.' || ((({n}) >> 8) & 255) || '.' || (({n}) & 255)"


#: Frames of peers carry no table.
UNNAMED = folded(PEERS.replace(f"{PEER_ROUTE['table_name']} as table_name", "'' as table_name"), PEER_KEY, PEER_SCOPES)
SESSIONS = sql(SESSION, "events")

SUMMARY = "count(*) as route_count, count(distinct prefix) as unique_prefixes, count(distinct nexthop) as unique_nexthops, max(updated_at) as last_update"

SQL = {
    "roundtrip_v4_announce": f"select seq, router_id, table_name, prefix, path_id, nexthop from ({ALL_ROUTES}) where afi = 4 and action = 'A'",
    "roundtrip_withdraw": f"select seq, afi, prefix, nexthop is null as bare from ({ALL_ROUTES}) where action = 'D'",
    "roundtrip_as_path": f"select seq, as_path, origin_asn::varchar as origin_asn, 'IGP' as origin, seq % 300 as localpref from ({ALL_ROUTES}) where action = 'A'",
    "roundtrip_communities": f"select seq, community as communities from ({ALL_ROUTES}) where community is not null",
    "roundtrip_add_path": f"select seq, prefix, path_id, true as add_path from ({ALL_ROUTES}) where path_id > 0",
    "roundtrip_peers": f"select seq, md5(router_id) as router_hash, router_id as frame_ip, peer_address, peer_asn, peer_bgp_id, is_post_policy, 'UNKNOWN' as table_name, prefix, action, case when action = 'A' then nexthop end as nexthop from ({PEERS}) where kind = 'route'",
    "roundtrip_sessions": f"""
        select seq, kind, is_loc_rib, case when is_loc_rib then table_name else 'UNKNOWN' end as table_name, case when is_loc_rib then router_id else peer_address end as header_router, case when kind = 'eor' then afi end as afi,
          case when not is_loc_rib then peer_address end as peer_address, case when not is_loc_rib then peer_bgp_id end as peer_bgp_id, case when kind = 'peer_up' then router_id end as local_bgp_id,
          case when not is_loc_rib then peer_asn end::varchar as peer_asn, case when kind = 'peer_up' and not is_loc_rib then local_asn end::varchar as local_asn, case when kind = 'peer_down' then reason end::varchar as reason
        from ({sql(SESSION, "events", where="event_type in ('signup', 'click', 'purchase')")})""",
    "roundtrip_initiation": "select s_suppkey as seq, 'router' as kind, s_name as sys_name, 'site ' || s_nationkey as sys_descr from supplier",
    "roundtrip_attributes": f"select seq, seq * 3 as med, 'RT:65001:' || (seq % 1000) || ' SOO:65002:' || (seq % 7) as extended, '70000:1:' || (seq % 100000) as large from ({ALL_ROUTES}) where action = 'A'",
    "add_path_detected": f"select seq, prefix, 64 + seq % 150 as path_id, true as add_path from ({ALL_ROUTES}) where afi = 4 and action = 'A'",
    "frame_messages": f"select seq, unnest(range(1 + seq % 4))::int as msg_index, prefix, action from ({ALL_ROUTES})",
    "current_routes_decoded": f"{CURRENT} select {KEY}, nexthop, first_seen, updated_at from live",
    "adj_rib_in_decoded": f"{UNNAMED} select {PEER_KEY}, peer_asn, nexthop, first_seen, updated_at from live",
    "routers_decoded": """
        select router_id, router_id as router_ip, arg_max(case when named then s_name end, seq) filter (named) as hostname, arg_max(case when named then 'site ' || s_nationkey end, seq) filter (named) as description,
          arg_max(70000 + s_nationkey, seq) filter (not named)::varchar as as_number, min(time) filter (named or changed) as first_seen, max(time) filter (named or changed) as last_seen
        from (select *, named or lag(s_nationkey) over (partition by router_id, named order by seq) is distinct from s_nationkey as changed from (
          select s_suppkey as seq, timestamp '2024-01-01' + to_minutes(s_suppkey) as time, '10.0.0.' || (s_suppkey % 5) as router_id, s_suppkey % 3 <> 0 as named, s_name, s_nationkey from supplier)) group by router_id""",
    "json_peer_feed": f"select seq, kind, router_id, case when seq % 5 > 0 then table_name else '' end as table_name from ({SESSIONS}) where is_loc_rib and kind in ('peer_up', 'peer_down')",
    "json_feed_decode": f"select seq, {KEY}, action, nexthop, as_path, 'igp' as origin, seq % 100 as med, origin_asn::varchar as origin_asn, community as communities, 'x' || seq as note from ({ALL_ROUTES})",
    "origin_asn": f"select seq, case when as_path like '%}}' then null else split_part(as_path, ' ', -1) end as origin_asn from ({ALL_ROUTES})",
    "event_id_sha256": f"select event_id, prefix, action from {HISTORY}",
    "history_dedup": f"select event_id, min(ingest_time) as ingest_time from {HISTORY} group by event_id, ingest_time::date",
    "retention_filter": f"select ingest_time::date::varchar as ingest_date, count(*) as events from {HISTORY} where ingest_time::date >= date '2024-01-20' group by 1",
    "current_routes_fold": f"{folded(ALL_ROUTES, KEY, LOC_SCOPES)} select {KEY}, nexthop, as_path, first_seen, updated_at from live",
    "current_routes_eor": f"{folded(EVENTS + ' and not (' + ROUTE['kind'] + " = 'peer_down')", KEY, LOC_SCOPES)} select {KEY}, nexthop, first_seen, updated_at from live",
    "current_routes_peer_down": f"{CURRENT} select {KEY}, nexthop, first_seen, updated_at from live",
    "first_seen": f"{CURRENT} select router_id, table_name, afi, min(first_seen) as oldest, max(first_seen) as newest, count(*) filter (first_seen < updated_at) as renewed from live group by all",
    "adj_rib_in_fold": f"{ADJ} select {PEER_KEY}, peer_asn, nexthop, first_seen, updated_at from live",
    "sync_status": STATUS,
    "routers_merged": f"select * replace (as_number::varchar as as_number) from ({ROUTERS})",
    "asn_change_suppress": f"select seq, router_id, local_asn as as_number from (select *, lag(local_asn) over (partition by router_id order by seq) as old from (select seq, router_id, (64512 + user_id % 3)::bigint as local_asn from ({EVENTS}) join events on event_id = seq)) where old is null or old <> local_asn",
    "router_identity_asof": """
        select seq, coalesce(last_value(up ignore nulls) over (partition by h order by seq rows unbounded preceding), ip) as router_id from (
          select event_id as seq, 'h' || (user_id % 40) as h, '10.9.0.' || (user_id % 200) as ip,
            case when event_type = 'signup' then case when event_id % 5 > 0 then '10.1.' || (event_id % 200) || '.1' else '10.9.0.' || (user_id % 200) end end as up from events)""",
    "route_summary": f"{CURRENT} select router_id, table_name, afi, {SUMMARY} from live group by all",
    "adj_rib_in_summary": f"{ADJ} select router_id, peer_address, peer_asn, is_post_policy, table_name, afi, {SUMMARY} from live group by all",
    "peers_overview": f"""{ADJ} select l.router_id, q.hostname as router_hostname, peer_address, peer_asn, peer_bgp_id, count(*) filter (not is_post_policy) as pre_policy_routes, count(*) filter (is_post_policy) as post_policy_routes,
        count(*) as total_routes, count(distinct prefix) as unique_prefixes, max(updated_at) as last_update from live l left join ({ROUTERS}) q on q.router_id = l.router_id group by all""",
    "routers_overview": f"""
        with q as ({ROUTERS}), st as ({STATUS}), c as ({CURRENT} select * from live), a as ({ADJ} select * from live), known as (select router_id from q union select router_id from st union select router_id from c union select router_id from a)
        select k.router_id, q.router_ip, q.hostname, q.as_number::varchar as as_number, q.display_name, q.first_seen, q.last_seen,
          (select count(*) from c where c.router_id = k.router_id) as route_count, (select count(distinct prefix) from c where c.router_id = k.router_id) as unique_prefixes,
          (select count(*) from a where a.router_id = k.router_id) as adj_rib_in_route_count, (select count(distinct peer_address) from a where a.router_id = k.router_id) as adj_rib_in_peer_count,
          (select bool_and(eor_seen)::varchar from st where st.router_id = k.router_id) as all_afis_synced, (select max(session_start_time) from st where st.router_id = k.router_id) as session_start_time,
          (select max(updated_at) from st where st.router_id = k.router_id) as sync_updated_at
        from known k left join q on q.router_id = k.router_id""",
    "routes_by_router": f"{PLAIN} select table_name, afi, prefix, path_id, nexthop from live where router_id = '10.0.0.2'",
    "exact_prefix": f"{PLAIN} select {KEY}, nexthop from live where prefix = '10.1.1.0/24'",
    "routes_by_origin_as": f"{PLAIN} select prefix, nexthop, as_path from live where origin_asn = 64530",
    "routes_by_community": f"{PLAIN} select prefix, nexthop, as_path from live where community = '65001:7'",
    "routes_by_nexthop": f"{PLAIN} select prefix, as_path from live where nexthop = '192.0.2.7'",
    "recent_changes": f"{PLAIN} select {KEY}, updated_at from live where updated_at > timestamp '2024-01-29'",
    "cross_router_prefix": f"{PLAIN} select router_id, nexthop, as_path from live where prefix = '10.1.1.0/24'",
    "lpm": f"""
        select o_orderkey, {text('n')} as address, {text('net')} || '/' || len as prefix, p_partkey from (
          select o.o_orderkey, o.n, p.net, p.len, min(p.p_partkey) over (partition by o.o_orderkey, p.net, p.len) as p_partkey, row_number() over (partition by o.o_orderkey order by p.len desc, p.p_partkey) as i
          from (select o_orderkey, (167772160 + (o_orderkey * 104729) % 16777216)::bigint as n from orders) o join {NETWORKS} p on o.n >= p.net and o.n < p.net + (1::bigint << (32 - p.len))) where i = 1""",
    "prefix_history": f"select ingest_time, action, nexthop, as_path, origin_asn::varchar as origin_asn from {HISTORY} where router_id = '10.0.0.1' and prefix = '10.1.1.0/24' order by ingest_time desc limit 100",
    "churn_per_minute": f"select date_trunc('minute', ingest_time) as minute, count(*) as events, count(*) filter (action = 'A') as adds, count(*) filter (action = 'D') as withdraws from {HISTORY} where router_id = '10.0.0.2' and ingest_time > timestamp '2024-01-20' group by 1",
    "changes_in_window": f"select ingest_time, prefix, action, nexthop from {HISTORY} where router_id = '10.0.0.2' and ingest_time between timestamp '2024-01-10' and timestamp '2024-01-11 12:00:00'",
    "sync_health": f"select s.router_id, q.hostname, afi, eor_seen, eor_time, session_start_time, updated_at from ({STATUS}) s left join ({ROUTERS}) q on q.router_id = s.router_id",
    "stale_sessions": f"select router_id, table_name, afi, updated_at from ({STATUS}) where updated_at < timestamp '2024-01-30 19:00:00'",
    "summary_counts": f"{CURRENT} select router_id, table_name, afi, {SUMMARY} from live group by all",
    "live_counts": f"{PLAIN} select router_id, table_name, afi, count(*) as route_count, count(distinct prefix) as unique_prefixes from live group by all",
    "acceptance_count": f"{PLAIN} select count(*) as routes from live where afi = 4",
    "prefix_functions": f"select p_partkey, len, net as number, false as odd, len >= 9 and net < 167772160 + 8388608 as held from {NETWORKS}",
}
