"""Tables as Spark sees them. Numbers that the wire gives as unsigned 32 bits are BIGINT."""

ROUTE = "nexthop STRING, as_path STRING, origin STRING, localpref BIGINT, med BIGINT, communities_std ARRAY<STRING>, communities_ext ARRAY<STRING>, communities_large ARRAY<STRING>, attrs MAP<STRING,STRING>"
PEER = "peer_address STRING, peer_asn BIGINT, peer_bgp_id STRING, is_post_policy BOOLEAN"

#: What decode() adds to a frame.
DECODED = f"kind STRING, error STRING, msg_index INT, event_index INT, is_loc_rib BOOLEAN, router_hash STRING, frame_ip STRING, header_router STRING, local_bgp_id STRING, local_asn BIGINT, sys_name STRING, sys_descr STRING, reason INT, table_name STRING, {PEER}, add_path BOOLEAN, afi INT, action STRING, prefix STRING, path_id BIGINT, {ROUTE}, event_id BINARY, bmp_raw BINARY"

LOC_KEY = ["router_id", "table_name", "afi", "prefix", "path_id"]
ADJ_KEY = ["router_id", "peer_address", "is_post_policy", "table_name", "afi", "prefix", "path_id"]
ATTRIBUTES = ["nexthop", "as_path", "origin", "localpref", "med", "origin_asn", "communities_std", "communities_ext", "communities_large", "attrs"]
PEER_FACTS = ["peer_asn", "peer_bgp_id"]

CURRENT_ROUTES = "router_id STRING, table_name STRING, afi INT, prefix STRING, path_id BIGINT, nexthop STRING, as_path STRING, origin STRING, localpref BIGINT, med BIGINT, origin_asn BIGINT, communities_std ARRAY<STRING>, communities_ext ARRAY<STRING>, communities_large ARRAY<STRING>, attrs MAP<STRING,STRING>, first_seen TIMESTAMP, updated_at TIMESTAMP"
RIB_SYNC_STATUS = "router_id STRING, table_name STRING, afi INT, last_parsed_msg_time TIMESTAMP, last_raw_msg_time TIMESTAMP, eor_seen BOOLEAN, eor_time TIMESTAMP, session_start_time TIMESTAMP, updated_at TIMESTAMP"
ROUTERS = "router_id STRING, router_ip STRING, hostname STRING, as_number BIGINT, description STRING, display_name STRING, location STRING, first_seen TIMESTAMP, last_seen TIMESTAMP"
