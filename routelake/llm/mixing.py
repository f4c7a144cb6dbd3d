"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions.

DataFrame functions only. Sources are clamped at their maximum epochs and the excess is shared again by weight until
none is above; each round brings two sums to the driver. A document is taken whole as often as the target goes into
its source, and the seeded order of the documents says which are taken once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut

#: Ranges of the seeded order, per source; only the one where the quota ends is sorted.
BUCKET_BITS = 12


def sizes(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Words of every whole text; null has none."""
    return docs.select(*(keep or ["doc_id", "source"]), F.coalesce(F.regexp_count("text", F.lit(rf"[^{SPACE}]+")), F.lit(0)).cast("long").alias("size"))


def ranked_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, repeating, over (source, source_size) rows by code point, null last. One row a source.

    Ranges of the order are numbered apart and moved by the rows before them, so no task holds all sources.
    """
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    parts = cut(sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"range": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row a range
    moved = parts.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return parts.join(F.broadcast(moved), "range").withColumn("weight", ((F.col("place") + F.col("before")) % 3 + 1).cast("long")).drop("range", "place", "before")


def water_fill(sources: DataFrame, total: int, epochs: int = 3) -> DataFrame:
    """Adds target to (source, source_size, weight) rows: least(epochs * source_size, weight * level), summing to `total`."""
    sources = sources.withColumn("cap", F.col("source_size") * epochs)
    level = -1.0
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        full, free = sources.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))).first()
        new = (total - (full or 0)) / free if free else float("inf")
        if not free or new <= level:
            break
        level = new
    capped = F.col("cap") <= F.col("weight") * F.lit(level)
    return sources.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("weight") * F.lit(level)))


def repetitions(sized: DataFrame, targets: DataFrame, key: list[str], seed: int = 11, ties: tuple[str, ...] = ()) -> DataFrame:
    """Adds whole (every document of the source), extra (0 or 1: chosen by the seeded order) and reps = whole + extra.

    `sized` has `key` columns, source and size; `targets` (one row a source) source, source_size and target.
    Documents are taken in seeded order until the fraction of the source is reached, to the nearest document. Sums of
    ranges of that order are formed first, so only the range where the quota ends is sorted by document. Columns `ties`
    order rows that agree in key and size.
    """
    hashed = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in key)).cast("binary")), 1, 15), 16, 10).cast("long")
    rows = sized.withColumn("u", hashed).withColumn("bucket", F.shiftright("u", 60 - BUCKET_BITS).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    plan = targets.select(F.col("source").alias("s"), "source_size", "target", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("whole"))
    plan = plan.withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    marks = sums.join(plan, sums.source.eqNullSafe(plan.s)).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target", "whole", "quota", ((F.col("quota") > 0) & (F.col("before") + F.col("bucket_size") <= F.col("quota"))).alias("all_in"), (F.col("before") >= F.col("quota")).alias("none_in"))
    joined = rows.join(marks, rows.source.eqNullSafe(marks.s) & (rows.bucket == marks.b)).drop("s", "b")
    clear = joined.where("all_in or none_in").withColumn("extra", F.when(F.col("all_in"), 1).otherwise(0))
    edge = Window.partitionBy("source", "bucket").orderBy("u", *key, "size", *ties).rowsBetween(Window.unboundedPreceding, -1)
    split = joined.where("not (all_in or none_in)").withColumn("so_far", F.col("before") + F.coalesce(F.sum("size").over(edge), F.lit(0)))
    split = split.withColumn("extra", F.when(F.col("so_far") + F.col("size") / 2 <= F.col("quota"), 1).otherwise(0)).drop("so_far")
    out = clear.unionByName(split).withColumn("reps", F.col("whole") + F.col("extra"))
    return out.select(*sized.columns, "source_size", "target", "whole", "extra", "reps")


def mix(docs: DataFrame, epochs: int = 3, seed: int = 11, weights=ranked_weights, ties: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, whole, extra, reps, taken of every row of `docs`.

    The mix has as many words as all documents; sources share it by weight, none over `epochs` times its size.
    Null text: size 0. Null source: a source of its own. Null ids and repeated rows: each row counts and is mixed by
    itself. A source without words has target 0, and its documents aren't taken. An empty table gives no rows. The same rows give the same mix. Columns `ties` are kept and order rows of one id.
    """
    sized = cut(sizes(docs, ["doc_id", "source", *ties]))
    per = cut(weights(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    out = repetitions(sized, cut(water_fill(per, total, epochs)), ["doc_id"], seed, ties)
    return out.withColumn("taken", F.col("size") * F.col("reps"))
