"""Frames to events: one Arrow stage that reads bytes, then column expressions for identity and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import origin_asn
from ..schemas import DECODED

#: Largest number of changes of routers' names that is broadcast.
BROADCAST_NAMES = 200_000


def decode(frames: DataFrame, keep: list[str], value: str = "value", **options) -> DataFrame:
    """Columns `keep` of `frames` and DECODED, one row for each event; what can't be read gives a row of kind error.

    One map, no shuffle; a frame's events come in its order by (msg_index, event_index). `options`: see wire.rows; with
    ids=False event_id and bmp_raw are null and nothing is hashed.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    added = StructType.fromDDL(DECODED)
    out = StructType([*(frames.schema[k] for k in keep), *added])
    arrow = to_arrow_schema(out)

    def run(batches):
        from routelake.functions import wire

        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000)
                at, made = [], []
                for i, raw in enumerate(part.column(len(keep)).to_pylist()):
                    for row in wire.rows(raw, **options):
                        at.append(i)
                        made.append(row)
                taken = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns[: len(keep)], *(pa.array([r.get(f.name) for r in made], f.type) for f in list(arrow)[len(keep) :])], schema=arrow)

    return frames.select(*keep, F.col(value).alias(value)).mapInArrow(run, out)


def nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def loc_router() -> Column:
    """The router of a Loc-RIB event: the per-peer header's, unless it is none, :: or 0.0.0.0; then the wrapper's address."""
    own = F.when(F.col("header_router").isin("::", "0.0.0.0"), None).otherwise(F.col("header_router"))
    return F.coalesce(own, "frame_ip", "header_router")


def identities(ups: DataFrame, order: list[str]) -> DataFrame:
    """(router_hash, router, since, until): what a router is called from one Peer Up on until one that names it otherwise. Only Peer Ups are sorted."""
    named = ups.where("kind = 'peer_up' and not is_loc_rib and router_hash is not null").select("router_hash", F.struct(*order).alias("since"), F.coalesce("local_bgp_id", "frame_ip").alias("router")).where("router is not null")
    by = Window.partitionBy("router_hash").orderBy("since")
    return named.withColumn("old", F.lag("router").over(by)).where("old is null or old <> router").withColumn("until", F.lead("since").over(by)).drop("old")


def identified(events: DataFrame, order: list[str], ups: DataFrame | None = None) -> DataFrame:
    """Adds router_id.

    Loc-RIB: see loc_router(). Else: the BGP identifier of the last Peer Up before, of the same router hash; else the
    wrapper's address. `order`: columns that put all events in order. `ups`: the Peer Ups among the events, where they
    are at hand; else they are filtered from the events, which are then read again. Events aren't sorted: they meet the
    few changes of names by hash, and rows without a lookup are spread over keys that nothing has. Changes are counted
    when the plan is made; up to BROADCAST_NAMES of them are broadcast, and events aren't shuffled.
    """
    spans = identities(events if ups is None else ups, order).select(F.col("router_hash").alias("_hash"), "router", "since", "until")
    if not events.isStreaming and spans.limit(BROADCAST_NAMES + 1).count() <= BROADCAST_NAMES:
        spans = F.broadcast(spans)
    looked_up = ~F.col("is_loc_rib") & F.col("router_hash").isNotNull()
    rows = events.withColumn("_key", F.when(looked_up, F.col("router_hash")).otherwise(F.concat(F.lit("\0"), F.pmod(F.xxhash64(*order), F.lit(4096)).cast("string"))))
    at = F.struct(*(F.col(c) for c in order))
    joined = rows.join(spans, (F.col("_key") == F.col("_hash")) & (at >= F.col("since")) & (F.col("until").isNull() | (at < F.col("until"))), "left")
    alone = F.when((F.col("kind") == "peer_up") & F.col("router_hash").isNull(), F.col("local_bgp_id"))
    return joined.withColumn("router_id", F.when(F.col("is_loc_rib"), loc_router()).otherwise(F.coalesce("router", alone, "frame_ip"))).drop("_key", "_hash", "router", "since", "until")


def routed(events: DataFrame) -> DataFrame:
    """Adds origin_asn, and '' for UNKNOWN tables of adj-RIB-in rows; error rows go to quarantine() instead."""
    table = F.when(~F.col("is_loc_rib") & (F.col("table_name") == "UNKNOWN"), "").otherwise(F.col("table_name"))
    return events.where("kind <> 'error'").withColumn("table_name", table).withColumn("origin_asn", origin_asn("as_path"))


def quarantine(events: DataFrame) -> DataFrame:
    return events.where("kind = 'error'")


def loc_rib(events: DataFrame) -> DataFrame:
    return events.where("is_loc_rib")


def adj_rib_in(events: DataFrame) -> DataFrame:
    """Events of peers, and Loc-RIB Peer Downs: these end all of a router's peers too."""
    return events.where("not is_loc_rib or kind = 'peer_down'")
