"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests, encode_decode

    return digests(encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")), ["doc_id"])


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    from .quality import select_good

    return select_good(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"]).withColumn("kept", F.lit(True))


def op4_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import score

    return score(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), F.crc32(F.col("doc_id").cast("string")) % 7 != 2)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lines import dedup

    return dedup(table(spark, sf_dir, "documents"), ["doc_id"], short=True).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near import classes

    return classes(table(spark, sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repeats import digests, repeats

    return digests(repeats(table(spark, sf_dir, "documents")))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import digests, scan

    return digests(scan(table(spark, sf_dir, "documents")), ["doc_id"])


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vectors import linked

    return linked(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_topk, op2_bpe, op3_quality, op4_lattice_lm, op5_line_dedup, op6_mix, op7_near_dedup, op8_repeats, op9_secrets, op10_vector_dedup)}


def oracle_sql() -> dict[str, str]:
    from .sql import SQL

    return dict(SQL)
