"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

DataFrame functions only. A run of key characters is a secret if the log-likelihood ratio of two first-order models,
one trained on labelled random strings and one on labelled ordinary identifiers, is high enough.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed patterns: kind, pattern, group that is measured, least length of it.
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # runs are maximal, so a least length in the pattern drops the same matches as one after it
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WIDTH = len(ALPHABET) + 1
#: Runs that the models judge.
RUN = r"[A-Za-z0-9+/_=-]{20,}"


def located(text: Column, pattern: str, group: int, least: int, rank: int) -> Column:
    """array<struct<start, rank, stop, value>> of leftmost non-overlapping matches; code points, stop exclusive.

    What stands between matches gives their places: the pieces of split() and the matches alternate.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,value:string>>")

    def add(acc, x):
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["whole"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), x["value"].alias("value"))
        return F.struct(stop.alias("at"), F.when(F.length(x["value"]) >= least, F.concat(acc["found"], F.array(one))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("found")), add)["found"]
    return F.when(text.rlike(pattern), found).otherwise(none)


def samples(docs: DataFrame, most_docs: int = 400, each: int = 20_000) -> DataFrame:
    """Labelled strings (random boolean, s): seeded digests in three alphabets, and identifiers made of words.

    Words are those of the `most_docs` documents of smallest hash of doc_id, the documented bound; identifiers are
    words alone, in pairs joined by _ or - or /, with a number behind, and in upper case.
    """
    spark: SparkSession = docs.sparkSession
    digest = F.unhex(F.sha2(F.concat(F.lit("seed"), F.col("id").cast("string")), 256))
    made = spark.range(each).select(F.explode(F.array(F.base64(digest), F.lower(F.hex(F.substring(digest, 1, 20))), F.translate(F.base64(digest), "+/=", ""), F.upper(F.conv(F.hex(F.substring(digest, 1, 7)), 16, 36)))).alias("s"))
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(most_docs)
    words = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.filter(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,}"), F.lit(0)), lambda w: F.length(w) >= 3).alias("w")).where(F.size("w") > 1)
    pair = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.struct(F.element_at("w", i).alias("a"), F.element_at("w", i + 1).alias("b")))).alias("p")).select("p.a", "p.b")
    plain = pair.select(F.explode(F.array(F.col("a"), F.concat("a", F.lit("_"), "b"), F.concat("a", F.lit("-"), "b"), F.concat("a", F.lit("/"), "b"), F.concat("a", "b"), F.upper("a"), F.concat("a", F.lit("_"), F.pmod(F.crc32("b"), F.lit(3000)).cast("string")))).alias("s"))
    return made.select(F.lit(True).alias("random"), "s").unionByName(plain.select(F.lit(False).alias("random"), "s"))


def code(c: Column) -> Column:
    """1 to 67: the character's place in the alphabet; 0 for another."""
    return F.instr(F.lit(ALPHABET), c)


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each pair of characters, by place WIDTH * first + second.

    0 as the first is the start. At most 2 * WIDTH^2 counts come to the driver; one is added to each.
    """
    pairs = labelled.where(F.length("s") > 0).select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s")), lambda i: code(F.when(i > 1, F.substring("s", i - 1, 1)).otherwise("\0")) * WIDTH + code(F.substring("s", i, 1)))).alias("pair"))
    counts = {(r.random, r.pair): r.n for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    out = []
    for a in range(WIDTH):
        total = {k: sum(counts.get((k, a * WIDTH + b), 0) for b in range(WIDTH)) for k in (True, False)}
        out += [math.log((counts.get((True, a * WIDTH + b), 0) + 1) / (total[True] + WIDTH)) - math.log((counts.get((False, a * WIDTH + b), 0) + 1) / (total[False] + WIDTH)) for b in range(WIDTH)]
    return out


def ratio(s: Column, table: list[float]) -> Column:
    """Sum of the table's values over the string's pairs of characters."""
    values = F.split(F.lit(" ".join(map(repr, table))), " ").cast("array<double>")
    step = lambda acc, i: F.struct(code(F.substring(s, i, 1)).alias("last"), (acc["sum"] + F.element_at(values, acc["last"] * WIDTH + code(F.substring(s, i, 1)) + 1)).alias("sum"))
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum")), step)["sum"]


def written(spans: Column) -> Column:
    """kind:start:stop by start, then kind as listed, comma-joined."""
    kinds = F.array(*(F.lit(k) for k in (*(p[0] for p in PATTERNS), "random")))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(kinds, x["rank"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def scan(docs: DataFrame, table: list[float] | None = None, least: float = 12.0, keep: list[str] | None = None) -> DataFrame:
    """Adds base (spans of the fixed patterns) and spans (these and the models'), each array<struct<start, rank, stop, value>>.

    A run of 20 or more key characters that no base span touches is added if its log-likelihood ratio is at least
    `least`. `table` is what train() returns; without it, it is trained on samples(docs). Null text counts as empty,
    without spans; null ids and repeated rows each give a row; an empty table gives none. One map, no shuffle.
    """
    table = table or train(samples(docs))
    keep = keep or ["doc_id"]
    out = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    out = out.select(*keep, *(located(F.col("text"), p, g, n, i).alias(k) for i, (k, p, g, n) in enumerate(PATTERNS)), located(F.col("text"), RUN, 0, 20, len(PATTERNS)).alias("runs"))
    out = out.select(*keep, *(p[0] for p in PATTERNS), F.concat(*(p[0] for p in PATTERNS)).alias("base"), "runs")
    clear = lambda x: ~F.exists("base", lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])) & (ratio(x["value"], table) >= least)
    return out.withColumn("spans", F.concat("base", F.when(F.size("runs") > 0, F.filter("runs", clear)).otherwise(F.col("runs")))).drop("runs")


def digests(scanned: DataFrame, keep: list[str]) -> DataFrame:
    """Counts by kind, base_sha256 and spans as text of what scan returns."""
    return scanned.select(*keep, *(F.size(p[0]).cast("long").alias(f"n_{p[0]}") for p in PATTERNS), F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
