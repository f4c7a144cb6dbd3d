"""JSON route feed: schema on read with fallbacks, as column expressions over VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bound, origin_asn

# Keys that have columns of their own or are left out of attrs.
KNOWN = (
    "router_hash", "router_ip", "bmp_router", "is_loc_rib", "table_name", "is_ipv4", "action", "is_eor", "prefix", "prefix_len", "path_id", "nexthop", "as_path", "origin",
    "local_pref", "med", "community_list", "ext_community_list", "large_community_list", "timestamp", "peer_hash", "peer_ip", "peer_asn", "peer_type", "base_attrs",
)


NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")
BASE = ("as_path", "origin", "nexthop", "local_pref", "med", "community_list", "ext_community_list", "large_community_list")


class Json:
    """Fields of an object by kind: columns {prefix}{key} (a scalar as text, or an array's JSON) and {prefix}{key}_kind, made once a record."""

    def __init__(self, prefix: str):
        self.prefix = prefix

    def staged(self, df: DataFrame, fields: dict[str, Column]) -> DataFrame:
        """Adds the columns of variants by name."""
        df = df.withColumns({f"{self.prefix}{k}_v": v for k, v in fields.items()})
        text = {f"{self.prefix}{k}": F.try_variant_get(F.col(f"{self.prefix}{k}_v"), "$", "string") for k in fields}
        return df.withColumns(text | {f"{self.prefix}{k}_kind": F.schema_of_variant(F.col(f"{self.prefix}{k}_v")) for k in fields})

    def get(self, key: str) -> Column:
        return F.col(f"{self.prefix}{key}")

    def kind(self, key: str) -> Column:
        """The JSON type; null where the key is missing, VOID where it is null."""
        return F.col(f"{self.prefix}{key}_kind")

    def numeric(self, key: str) -> Column:
        return self.kind(key).isin(*NUMBERS) | self.kind(key).startswith("DECIMAL")

    def text(self, key: str) -> Column:
        """Strings, and numbers as written; null for none and for ''."""
        return F.when((self.get(key) != "") & ((self.kind(key) == "STRING") | self.numeric(key)), self.get(key))

    def flag(self, key: str) -> Column:
        return F.coalesce(self.kind(key).isin("BOOLEAN", "STRING") & (F.lower(self.get(key)) == "true"), F.lit(False))

    def number(self, key: str) -> Column:
        """Whole numbers of numbers and strings; 0 for what is none, null for a missing key."""
        whole = self.get(key).rlike("^[+-]?[0-9]+$")
        value = F.when(whole & ((self.kind(key) == "STRING") | self.numeric(key)), self.get(key).try_cast("bigint")).when(self.numeric(key), self.get(key).try_cast("double").try_cast("bigint"))
        return F.when(self.kind(key).isNotNull(), F.coalesce(value, F.lit(0).cast("bigint")))

    def unsigned(self, key: str) -> Column:
        return F.pmod(self.number(key), F.lit(2**32))

    def items(self, key: str) -> Column:
        return F.when(self.kind(key).startswith("ARRAY"), F.try_variant_get(F.col(f"{self.prefix}{key}_v"), "$", "array<variant>"))

    def texts(self, key: str) -> Column:
        """The strings of an array, or of a text split at commas, else at single spaces; null for none."""
        array = F.transform(F.filter(self.items(key), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
        text = F.when((self.kind(key) == "STRING") & (self.get(key) != ""), self.get(key))
        commas = F.filter(F.transform(F.split(text, ","), lambda x: F.btrim(x, F.lit(" \t\r\n"))), lambda x: x != "")
        return F.coalesce(F.when(F.size(array) > 0, array), F.when(F.contains(text, F.lit(",")), commas).otherwise(F.split(text, " ")))

    def path(self, key: str) -> Column:
        """An AS path: a text, or an array of numbers and texts joined by spaces."""
        parts = F.transform(self.items(key), lambda x: F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")).otherwise(F.try_variant_get(x, "$", "bigint").cast("string")))
        return F.coalesce(F.nullif(F.array_join(parts, " "), F.lit("")), F.when((self.kind(key) == "STRING") & (self.get(key) != ""), self.get(key)))


def parsed(records: DataFrame, value: str, keys: tuple[str, ...]) -> DataFrame:
    """Adds _f, a struct of variants by key, read in one pass (of a key that comes twice, the last), and _object: whether the record is an object."""
    text = F.col(value).cast("string")
    fields = F.from_json(text, ", ".join(f"{k} VARIANT" for k in (*keys, "base_attrs")) + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    # generated, not selected: filters above would else be moved below and parse the record again, once a field
    rows = records.select("*", F.explode(F.array(fields)).alias("_f"))
    return rows.withColumn("_object", F.coalesce(F.startswith(F.ltrim(text, F.lit(" \t\r\n")), F.lit("{")) & F.col("_f").isNotNull() & F.col("_f._bad").isNull(), F.lit(False)))


def decode_routes(records: DataFrame, keep: list[str], topic_afi: Column, value: str = "value") -> DataFrame:
    """Columns `keep`, error, is_loc_rib, is_eor, kind and a route's columns for each record; a record with error has nulls elsewhere."""
    j, base = Json("_j_"), Json("_b_")
    out = j.staged(parsed(records, value, KNOWN[:19]), {k: F.col(f"_f.{k}") for k in KNOWN[:19]})
    out = base.staged(out, {k: F.try_variant_get(F.col("_f.base_attrs"), f"$.{k}", "variant") for k in BASE})
    router = F.coalesce(j.text("router_hash"), j.text("router_ip"), j.text("bmp_router"))
    prefix, length, eor = j.text("prefix"), j.number("prefix_len"), j.flag("is_eor")
    # a default route's length 0 counts, where the key is there
    cidr = F.when(~F.contains(prefix, F.lit("/")) & ((length > 0) | ((length == 0) & prefix.isin("0.0.0.0", "::"))), F.concat(prefix, F.lit("/"), length.cast("string"))).otherwise(prefix)
    error = F.when(~F.col("_object"), "not a JSON object").when(router.isNull(), "no router identifier").when(prefix.isNull() & ~eor, "no prefix")
    action = F.when(F.lower(j.text("action")).isin("del", "delete"), "D").otherwise("A")
    afi = F.when(j.kind("is_ipv4") == "BOOLEAN", F.when(j.get("is_ipv4") == "true", 4).otherwise(6)).otherwise(topic_afi)
    left = F.array_sort(F.filter(F.map_entries(F.from_json(F.col(value).cast("string"), "map<string,string>")), lambda e: ~e["key"].isin(*KNOWN)))
    cols = {
        "router_id": router, "is_loc_rib": j.flag("is_loc_rib"), "table_name": F.coalesce(j.text("table_name"), F.lit("UNKNOWN")), "afi": afi.cast("int"), "action": action, "is_eor": eor, "prefix": cidr, "path_id": F.coalesce(j.number("path_id"), F.lit(0).cast("bigint")),
        "nexthop": F.coalesce(j.text("nexthop"), base.text("nexthop")), "as_path": F.coalesce(j.text("as_path"), base.path("as_path")), "origin": F.coalesce(j.text("origin"), base.text("origin")), "localpref": F.coalesce(j.unsigned("local_pref"), base.unsigned("local_pref")), "med": F.coalesce(j.unsigned("med"), base.unsigned("med")),
        "communities_std": F.coalesce(j.texts("community_list"), base.texts("community_list")), "communities_ext": F.coalesce(j.texts("ext_community_list"), base.texts("ext_community_list")), "communities_large": F.coalesce(j.texts("large_community_list"), base.texts("large_community_list")),
        "attrs": bound(left, lambda x: F.when(F.size(x) > 0, F.map_from_entries(x))),
    }
    out = out.select(*keep, error.alias("error"), *(c.alias(f"_{n}") for n, c in cols.items()))
    out = out.select(*keep, "error", *(F.when(F.col("error").isNull(), F.col(f"_{n}")).alias(n) for n in cols))
    return out.withColumn("origin_asn", origin_asn("as_path")).withColumn("kind", F.when(F.col("error").isNotNull(), "error").when(F.col("is_eor"), "eor").otherwise("route"))


def decode_peers(records: DataFrame, keep: list[str], value: str = "value") -> DataFrame:
    """Columns `keep`, error, router_id, kind (the action in lower case), is_loc_rib, table_name ('' for none)."""
    j = Json("_j_")
    keys = ("router_hash", "router_ip", "bmp_router", "action", "is_loc_rib", "table_name")
    out = j.staged(parsed(records, value, keys), {k: F.col(f"_f.{k}") for k in keys})
    router = F.coalesce(j.text("router_hash"), j.text("router_ip"), j.text("bmp_router"))
    error = F.when(~F.col("_object"), "not a JSON object").when(router.isNull(), "no router identifier")
    return out.select(*keep, error.alias("error"), router.alias("router_id"), F.when(error.isNotNull(), "error").otherwise(F.lower(F.coalesce(j.text("action"), F.lit("")))).alias("kind"), j.flag("is_loc_rib").alias("is_loc_rib"), F.coalesce(j.text("table_name"), F.lit("")).alias("table_name"))


def events(records: DataFrame, keep: list[str]) -> DataFrame:
    """Loc-RIB events of (topic, value) records: peer topics give session markers, others routes and End-of-RIBs; the family comes from the topic."""
    peer = F.col("topic").endswith(".parsed.peer")
    routes = decode_routes(records.where(~peer), keep, F.when(F.contains("topic", F.lit("_v6")), 6).otherwise(4))
    peers = decode_peers(records.where(peer), keep).where("kind in ('peer_up', 'peer_down', 'error')")
    return routes.unionByName(peers, allowMissingColumns=True).where("kind = 'error' or is_loc_rib")
