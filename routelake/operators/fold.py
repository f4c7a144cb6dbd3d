"""Current state from events: the keyed fold with sessions, End-of-RIB and Peer Down, as a set operation.

Events carry seq (a total order), time and kind: route, eor, peer_up, peer_down. A marker becomes a purge (at, below):
it removes what was last announced before `below` and takes place at `at`. A Peer Down purges all before itself; an
End-of-RIB all before the session start that precedes it. A route is live if its last event is an announcement and no
purge is below it. Purges aren't carried along with routes: a route meets the last Peer Down of each of its scopes, which
leaves out all routes before, and the first End-of-RIB that would remove it, found among those around its seq. While
these tables are small enough to broadcast, routes shuffle once, by key; beyond that also for each of the three tables.
Where no Peer Down leaves anything out, the last withdrawals of the keys do, as far as these can be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import ADJ_KEY, ATTRIBUTES, LOC_KEY, PEER_FACTS

#: Largest number of purges, of scopes with a Peer Down, or of keys with a withdrawal, that is broadcast after counting. Most parts that seqs are cut in.
BROADCAST_PURGES, PARTS = 200_000, 1024


def families(ups: DataFrame) -> DataFrame:
    """A session start counts for both address families."""
    return ups.withColumn("afi", F.explode(F.array(F.lit(4), F.lit(6))))


def since_session(eors: DataFrame, ups: DataFrame, scope: list[str]) -> DataFrame:
    """Purges of End-of-RIBs: below the last session start of the scope before; without one there is none."""
    rows = eors.select(*scope, "seq", F.lit(None).cast("bigint").alias("up"), *[c for c in eors.columns if c not in (*scope, "seq")]).unionByName(ups.select(*scope, "seq", F.col("seq").alias("up")), allowMissingColumns=True)
    before = Window.partitionBy(*scope).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("below", F.last("up", ignorenulls=True).over(before)).where("up is null and below is not null").withColumnRenamed("seq", "at").drop("up")


def loc_purges(events: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """(purges, scope columns) of a Loc-RIB: by table and family, by table, and by router for a Peer Down without a table."""
    marks = events.where("kind <> 'route'")
    ups = families(marks.where("kind = 'peer_up'").drop("afi"))
    downs = marks.where("kind = 'peer_down'").select("router_id", "table_name", F.col("seq").alias("at"), F.col("seq").alias("below"))
    scope = ["router_id", "table_name", "afi"]
    return [
        (since_session(marks.where("kind = 'eor'").select(*scope, "seq"), ups, scope), scope),
        (downs.where("table_name <> ''"), ["router_id", "table_name"]),
        (downs.where("table_name = ''"), ["router_id"]),
    ]


def adj_purges(events: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """The same of peers' routes: a session start holds for all tables of a peer; a Loc-RIB Peer Down ends all peers of a router."""
    own, marks = events.where("not is_loc_rib"), events.where("kind <> 'route'")
    peer, at = ["router_id", "peer_address"], [F.col("seq").alias("at"), F.col("seq").alias("below")]
    ups = families(own.where("kind = 'peer_up'").drop("afi"))
    eors = since_session(own.where("kind = 'eor'").select(*peer, "afi", "seq", "table_name"), ups, [*peer, "afi"])
    return [
        (eors, [*peer, "table_name", "afi"]),
        (own.where("kind = 'peer_down'").select(*peer, *at), peer),
        (marks.where("is_loc_rib and kind = 'peer_down'").select("router_id", *at), ["router_id"]),
    ]


def behind(rows: DataFrame, ends: Sequence[tuple[DataFrame, list[str]]]) -> DataFrame:
    """Adds down: the last Peer Down among the row's scopes, or -1. ends: (down by scope, scope columns)."""
    for i, (per, scope) in enumerate(ends):
        rows = met(rows, per.withColumnRenamed("down", f"_down{i}"), scope)
    return rows.withColumn("down", F.greatest(*(F.coalesce(f"_down{i}", F.lit(-1)) for i in range(len(ends))))).drop(*(f"_down{i}" for i in range(len(ends))))


def met(rows: DataFrame, per: DataFrame, scope: list[str]) -> DataFrame:
    """rows with what `per` says of their scope, of which it has one row; null is a value of a scope."""
    match = F.lit(True)
    for c in scope:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(per.withColumnsRenamed({c: f"_{c}" for c in scope}), match, "left").drop(*(f"_{c}" for c in scope))


def until(values: Column, steps: Column, seq: Column) -> Column:
    """How many of sorted `values` aren't above `seq`, by halving: `steps` are the powers of two from the largest within their number down."""
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(values, n + step - 1) <= seq, n + step).otherwise(n))


def since_withdrawn(routes: DataFrame, key: list[str], most: int = BROADCAST_PURGES) -> DataFrame:
    """Routes from the last withdrawal of their key on: no run of announcements goes back behind it. If over `most` keys (about) have one, all routes."""
    gone = routes.where("action = 'D'")
    keys = gone.agg(F.approx_count_distinct(F.xxhash64(*key))).first()[0]
    if not 0 < keys <= most:
        return routes
    last = gone.groupBy(*key).agg(F.max("seq").alias("_withdrawn"))
    return met(routes, F.broadcast(last), key).where("_withdrawn is null or seq >= _withdrawn").drop("_withdrawn")


def with_purges(routes: DataFrame, key: list[str], purges: Sequence[tuple[DataFrame, list[str]]], ended: bool, most: int = BROADCAST_PURGES) -> DataFrame:
    """Adds down, the last Peer Down of a route's scopes, and next_eor: where the first End-of-RIB stands that removes what was announced at seq.

    What a route needs are these two numbers, however many markers there are: behind the last Peer Down none but
    End-of-RIBs count, and of these the first one after each session start. Routes before the last Peer Down go, unless
    `ended`; if there is none, those before their key's last withdrawal. Purges that number up to `most` are broadcast. The
    seqs are cut in parts that hold about 8 purges of a scope, so a scope with many is met by many keys.
    """
    ends = [(rows.groupBy(*scope).agg(F.max(F.col("at").cast("bigint")).alias("down")), scope) for rows, scope in purges[1:]]
    eors, scope = purges[0]
    eors = behind(eors.select(*scope, F.col("at").cast("bigint").alias("at"), F.col("below").cast("bigint").alias("below")), ends).where("below > down")
    eors = eors.groupBy(*scope, "below").agg(F.min("at").alias("at"))
    facts = eors.agg(F.lit(0).alias("i"), F.count("*").alias("n"), F.count_distinct(F.struct(*scope)).alias("scopes"), F.percentile_approx("below", [k / PARTS for k in range(1, PARTS)]).alias("edges"))
    for i, (per, _) in enumerate(ends, 1):
        facts = facts.unionByName(per.agg(F.lit(i).alias("i"), F.count("*").alias("n")), allowMissingColumns=True)
    own, *counts = sorted(facts.collect())
    few = lambda df, n: F.broadcast(df) if n <= most else df
    routes = behind(routes, [(few(per, c.n), s) for (per, s), c in zip(ends, counts, strict=True)])
    if not ended:
        routes = routes.where(F.col("seq") > F.col("down"))
        if not any(c.n for c in counts):
            routes = since_withdrawn(routes, key, most)
    if not own.n:
        return routes.withColumn("next_eor", F.lit(None).cast("bigint"))
    parts = max(1, min(PARTS, own.n // (8 * own.scopes)))
    edges = sorted({own.edges[k * PARTS // parts - 1] for k in range(1, parts)})
    part = lambda c: until(F.lit(edges), F.lit([1 << k for k in reversed(range(len(edges).bit_length()))]), F.col(c)) if edges else F.lit(0)
    # each purge stands in its own part and in those since the purge before
    before = Window.partitionBy(*scope).orderBy("below")
    spread = eors.withColumn("_part", part("below")).withColumn("_from", F.coalesce(F.lag("_part").over(before), F.lit(0))).withColumn("_part", F.explode(F.sequence("_from", "_part")))
    per = spread.groupBy(*scope, "_part").agg(F.array_sort(F.collect_list(F.struct("below", "at"))).alias("_own"))
    steps = F.reverse(F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.size("_own"))).cast("int")), lambda k: F.pow(F.lit(2), k).cast("int")))
    per = per.select(*scope, "_part", F.col("_own.below").alias("_below"), F.col("_own.at").alias("_at"), steps.alias("_steps"))
    joined = met(routes.withColumn("_part", part("seq")), few(per, own.n), [*scope, "_part"])
    return joined.withColumn("next_eor", F.get("_at", until(F.col("_below"), F.col("_steps"), F.col("seq")))).drop("_part", "_below", "_at", "_steps")


def live(routes: DataFrame, key: list[str], purges: Sequence[tuple[DataFrame, list[str]]], facts: list[str], seen: Observation | None = None, most: int = BROADCAST_PURGES) -> DataFrame:
    """key, facts, first_seen, updated_at, seq of live routes. `routes`: of kind route; first_seen (may be null) overrides a run's start.

    The first of `purges` are those of End-of-RIBs. `seen` gets eor_stale and session_down: how many routes they removed.
    Counts markers, and without Peer Downs keys with a withdrawal, before it returns; see with_purges.
    """
    if "first_seen" not in routes.columns:
        routes = routes.withColumn("first_seen", F.lit(None).cast("timestamp"))
    rows = with_purges(routes.select(*key, *facts, "action", "seq", "time", "first_seen"), key, purges, seen is not None, most)
    by = Window.partitionBy(*key).orderBy("seq")
    rows = rows.withColumns({"_seq": F.lag("seq").over(by), "_action": F.lag("action").over(by), "_eor": F.lag("next_eor").over(by), "_last": F.lead("seq").over(by).isNull()})
    starts = (F.col("action") == "A") & (F.col("_seq").isNull() | (F.col("_action") == "D") | ((F.col("_seq") < F.col("down")) & (F.col("down") < F.col("seq"))) | (F.col("_eor") < F.col("seq")))
    rows = rows.withColumn("_start", F.when(starts, F.coalesce("first_seen", F.col("time").cast("timestamp"))))
    rows = rows.withColumn("_start", F.last("_start", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.where(F.col("_last") & (F.col("action") == "A"))
    by_session, by_eor = F.col("down") > F.col("seq"), F.col("next_eor").isNotNull()
    if seen is not None:
        rows = rows.observe(seen, F.count_if(by_session).alias("session_down"), F.count_if(by_eor & ~by_session).alias("eor_stale"))
    return rows.where(~by_session & ~by_eor).select(*key, *facts, F.col("_start").alias("first_seen"), F.col("time").cast("timestamp").alias("updated_at"), "seq")


def current_routes(events: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Live Loc-RIB routes of (seq, time, kind, router_id, table_name, afi, prefix, path_id, action, attributes) events."""
    return live(events.where("kind = 'route'"), LOC_KEY, loc_purges(events), [c for c in ATTRIBUTES if c in events.columns], seen)


def adj_rib_in(events: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Live routes of peers. Peer facts are those of the last announcement."""
    return live(events.where("kind = 'route' and not is_loc_rib"), ADJ_KEY, adj_purges(events), [c for c in (*PEER_FACTS, *ATTRIBUTES) if c in events.columns], seen)


def since_downs(rows: DataFrame, downs: DataFrame) -> DataFrame:
    """Rows behind the last Peer Down of their table and of their router."""
    table = downs.where("table_name <> ''").groupBy("router_id", "table_name").agg(F.max("seq").alias("down"))
    router = downs.where("table_name = ''").groupBy("router_id").agg(F.max("seq").alias("all_down"))
    joined = rows.join(table, ["router_id", "table_name"], "left").join(router, "router_id", "left")
    return joined.where(F.col("seq") > F.greatest(F.coalesce("down", F.lit(-1)), F.coalesce("all_down", F.lit(-1)))).drop("down", "all_down")


def condensed(marks: DataFrame) -> DataFrame:
    """Of each scope and kind the first and the last behind the last Peer Down: all that the status shows, as later Peer Downs are behind them."""
    ends = since_downs(marks.where("kind <> 'peer_down'"), marks.where("kind = 'peer_down'")).groupBy("router_id", "table_name", "afi", "kind").agg(F.min(F.struct("seq", "time")).alias("a"), F.max(F.struct("seq", "time")).alias("b"))
    both = ends.select("router_id", "table_name", "afi", "kind", F.explode(F.array_distinct(F.array("a", "b"))).alias("x"))
    return both.select("router_id", "table_name", "afi", "kind", F.col("x.time").cast("timestamp").alias("time"), "x.seq")


def sync_status(events: DataFrame) -> DataFrame:
    """rib_sync_status of Loc-RIB events: a scope begins with its first route or session start after its last Peer Down."""
    scope = ["router_id", "table_name", "afi"]
    ups = families(events.where("kind = 'peer_up'").drop("afi"))
    rows = events.where("kind in ('route', 'eor')").select(*scope, "kind", "seq", "time").unionByName(ups.select(*scope, "kind", "seq", "time"))
    downs = events.where("kind = 'peer_down'")
    rows = since_downs(rows, downs)
    of = lambda kind, f: f("time", F.when(F.col("kind") == kind, F.col("seq")))
    at = lambda kind, f: f(F.when(F.col("kind") == kind, F.col("seq")))
    made = rows.groupBy(*scope).agg(
        of("route", F.max_by).alias("last_parsed_msg_time"), of("route", F.min_by).alias("first_time"), of("peer_up", F.max_by).alias("up_time"), of("eor", F.max_by).alias("end_time"),
        at("peer_up", F.max).alias("up"), at("eor", F.max).alias("end"), F.min(F.when(F.col("kind") != "eor", F.col("seq"))).alias("begun"), F.max_by("time", "seq").alias("last_time"), F.max_by("time", F.when(F.col("kind") != "eor", F.col("seq"))).alias("last_own"),
    )
    ended = F.coalesce((F.col("end") > F.col("begun")) & (F.col("end") > F.coalesce("up", F.lit(-1))), F.lit(False))
    counted = F.coalesce(F.col("end") > F.col("begun"), F.lit(False))
    return made.where("begun is not null").select(*scope, "last_parsed_msg_time", F.lit(None).cast("timestamp").alias("last_raw_msg_time"), ended.alias("eor_seen"), F.when(ended, F.col("end_time")).alias("eor_time"), F.coalesce("up_time", "first_time").alias("session_start_time"), F.when(counted, F.col("last_time")).otherwise(F.col("last_own")).alias("updated_at"))


def raw_times(history: DataFrame) -> DataFrame:
    """(router_id, table_name, afi, raw): the last time of each scope among Loc-RIB rows of the history."""
    return history.where("peer_address is null").groupBy("router_id", "table_name", "afi").agg(F.max("ingest_time").alias("raw"))


def raw_time(status: DataFrame, times: DataFrame) -> DataFrame:
    """last_raw_msg_time of status rows, from raw_times()."""
    return status.drop("last_raw_msg_time").join(times, ["router_id", "table_name", "afi"], "left").withColumnRenamed("raw", "last_raw_msg_time")


def carried(snapshot: DataFrame, events: DataFrame) -> DataFrame:
    """A batch's events together with an earlier snapshot's routes, each as an announcement at its seq."""
    old = snapshot.withColumns({"kind": F.lit("route"), "action": F.lit("A"), "time": F.col("updated_at")}).drop("updated_at")
    return old.unionByName(events, allowMissingColumns=True)


def last_sessions(events: DataFrame) -> DataFrame:
    """The session starts that later End-of-RIBs can refer to: the last of each scope."""
    scope = ["router_id", "table_name", "is_loc_rib", "peer_address"]
    return events.where("kind = 'peer_up'").groupBy(*scope).agg(F.max_by("time", "seq").alias("time"), F.max("seq").alias("seq")).withColumn("kind", F.lit("peer_up"))
