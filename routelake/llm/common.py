"""Helpers that the operators share: checkpoints, components, text batches."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table, in rows, that an operator broadcasts after counting it (ids and hashes: 8 to 40 bytes a row).
BROADCAST_ROWS = 200_000
#: Whether shuffle files go as soon as a query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: ASCII white space; words are what stands between.
SPACE = r"\x20\x09-\x0D"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Where the setting is unset, a folder of our own, on a local master only: executors elsewhere wouldn't see it."""
    sc = spark.sparkContext
    if not (found := sc.getCheckpointDir()):
        if not (found := spark.conf.get("spark.checkpoint.dir", None)):
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            found = tempfile.mkdtemp(prefix="routelake-checkpoint-")
        sc.setCheckpointDir(found)
        leave(spark, sc.getCheckpointDir())
    return found


def leave(spark: SparkSession, path: str) -> None:
    """The folder goes when the driver's JVM ends, if `discard` hasn't deleted it before."""
    files, at = _files(spark, path)
    files.deleteOnExit(at)


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def cut(df: DataFrame) -> DataFrame:
    """df with its rows written to the shared folder and its lineage cut. The files go when the driver's JVM ends, or with df where the cluster cleans checkpoints."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df written once as Parquet to the shared folder and read again; the folder goes with `discard`, or when the driver's JVM ends.

    What the write has shuffled goes with it; else it stays until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/routelake-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    leave(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what `stored` wrote, once nothing will read it again."""
    files, at = _files(df.sparkSession, df._stored_at)
    files.delete(at, True)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A checkpointed df with a broadcast hint if counting shows at most `limit` rows, else without."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id that links reach, for every id in `edges`.

    Smallest-label propagation with pointer jumping; each round is checkpointed. Only the count of
    changed rows comes to the driver. A hub's messages are combined before the shuffle.
    """
    both = cut(edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src <> dst").unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst")).where("src <> dst")).distinct())
    label = cut(both.groupBy(F.col("src").alias("id")).agg(F.least(F.col("src"), F.min("dst")).alias("component")))
    while True:
        heard = both.join(label, both.src == label.id).groupBy("dst").agg(F.min("component").alias("heard"))
        step = label.join(heard, label.id == heard.dst, "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("heard", "component")).alias("near"))
        jump = label.select(F.col("id").alias("at"), F.col("component").alias("far"))
        new = cut(step.join(jump, step.near == jump.at, "left").select("id", "old", F.least("near", F.coalesce("far", "near")).alias("component")))
        changed = new.where("component <> old").limit(1).count()
        label = new.select("id", "component")
        if not changed:
            return label


def slices(texts: list[str | None], most: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Runs of whole texts of about `most` characters, with the index of the first; null counts as empty."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t or "") + 64
        if total >= most or i == len(texts) - 1:
            yield start, [x or "" for x in texts[start : i + 1]]
            start, total = i + 1, 0


def release() -> None:
    """Gives memory that a task has freed back to the system: Python workers wait for the next task beside the executor's heap."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not in every C library
        ctypes.CDLL(None).malloc_trim(0)


def map_text(df: DataFrame, f: Callable[[list[str]], dict[str, list]], keep: list[str], text: str, schema: str, after: Callable[[], None] = release) -> DataFrame:
    """df.mapInArrow: columns `keep` and what f makes of a run of whole texts, by column name. `after` is called at a task's end."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = {x.name: x.dataType for x in df.schema}
    out = StructType([*(df.schema[k] for k in keep), *StructType.fromDDL(schema)])
    arrow = to_arrow_schema(out)
    assert text in kinds

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            # a bounded number of rows becomes Python strings at a time
            for first in range(0, batch.num_rows, 512):
                rows = column.slice(first, 512).to_pylist()
                for at, part in slices(rows):
                    made = f(part)
                    yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)).slice(first + at, len(part)) for k in keep), *(pa.array(made[x.name], x.type) for x in list(arrow)[len(keep) :])], schema=arrow)
        after()

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, out)
