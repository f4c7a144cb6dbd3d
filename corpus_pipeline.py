"""A corpus pipeline of five of the operators. Each stage takes what the one before kept; all but the last return the columns of documents.

In every stage a null text counts as empty, null ids and sources are values like others, rows that share an id are judged
row by row but for lines (see there), other columns than those of documents go, and an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelake.llm import bpe, lines, mixing, near, quality
from routelake.llm.common import cut, small
from routelake.llm.queries import table, tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def select_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, keeps; others go. Empty texts are judged by their shape."""
    return quality.select_good(docs, table(spark, sf_dir, "labels"), [*COLUMNS]).select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier one covers; a document that loses all its words goes, one that had none stays. n_chars is the new length.

    Rows that share an id lose the same lines, by line number.
    """
    made = lines.dedup(docs, ["doc_id", "lang", "source", "n_chars"], short=True)
    changed = F.col("n_removed") > 0
    return made.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class, of the smallest doc_id, null last; rows without words stay."""
    return near.kept_rows(docs, COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it. Rows equal in all columns are joined as one, with the sum of what each is taken."""
    rest = F.to_json(F.struct(*(c for c in COLUMNS if c != "text"), F.col("text").isNull().alias("none")))
    keyed = docs.withColumn("row", F.unhex(F.md5(F.concat(rest, F.coalesce("text", F.lit(""))).cast("binary"))))
    reps = cut(mixing.mix(keyed, ties=("row",)).groupBy(F.col("row").alias("r")).agg(F.sum("reps").cast("int").alias("reps"), F.count("*").alias("n")).where("reps > 0"))
    joined = lambda some: keyed.join(some, F.col("row") == F.col("r")).select(*COLUMNS, "reps")
    rows = joined(reps.where("n = 1")).unionByName(joined(small(reps.where("n > 1"))).distinct())
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "reps"))).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of them and of what they decode to; a null text has no ids."""
    made = bpe.encode_decode(docs, tokenizer("word_bpe_49k.json"), ["doc_id", "source"])
    return made.select("doc_id", "source", "ids", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", select_good),
    ("lines", drop_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifier and the near-copy search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over documents; each one's rows are written to the shared folder and read again."""
    from routelake.llm.common import stored

    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
