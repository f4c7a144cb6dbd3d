"""Tables that change: each write is a new version beside the old ones, and a pointer says which one holds.

Parquet tables can't be updated in place, and a reader must never see half a write. Versions live at path/v=N; the
pointer is the highest path/_done/N, made after the version is whole. Paths go through Hadoop's file systems.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self.jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.at(path))] if self.fs.exists(self.at(path)) else []

    def touch(self, path: str) -> None:
        self.fs.create(self.at(path), True).close()

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.at(path))

    def claim(self, path: str) -> bool:
        """Makes a file; False if it is there."""
        try:
            self.fs.create(self.at(path), False).close()
        except Py4JJavaError:
            if self.fs.exists(self.at(path)):
                return False
            raise
        return True

    def write_text(self, path: str, text: str) -> None:
        out = self.fs.create(self.at(path), True)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def read_text(self, path: str) -> str:
        found = self.fs.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
        finally:
            found.close()

    def rename(self, old: str, new: str) -> bool:
        return self.fs.rename(self.at(old), self.at(new))

    def delete(self, path: str) -> bool:
        return self.fs.delete(self.at(path), True)


class Versioned:
    def __init__(self, spark: SparkSession, path: str, schema: str, keep: int = 2):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep
        self.files = Files(spark, path)

    def version(self) -> int:
        """The version that holds; -1 before the first."""
        return max((int(n) for n in self.files.names(f"{self.path}/_done") if n.isdigit()), default=-1)

    def before(self, version: int) -> int:
        """The last version that holds below this one; -1 for none."""
        return max((int(n) for n in self.files.names(f"{self.path}/_done") if n.isdigit() and int(n) < version), default=-1)

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        return self.spark.createDataFrame([], self.schema) if v < 0 else self.spark.read.schema(self.schema).parquet(f"{self.path}/v={v}")

    def write(self, df: DataFrame, version: int) -> None:
        """Writes `version`, unless it or a later one holds: a batch that runs again changes nothing."""
        if version <= self.version():
            return
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        self.files.touch(f"{self.path}/_done/{version}")
        done = sorted(int(n) for n in self.files.names(f"{self.path}/_done") if n.isdigit())
        for old in done[: -self.keep]:
            self.files.delete(f"{self.path}/v={old}")
            self.files.delete(f"{self.path}/_done/{old}")


class Parted:
    """A table in parts by hash of the router. A version holds only the parts that changed; its pointer says where each part stands.

    A batch reads and writes the parts of its own routers: what it costs follows the batch, not the table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, parts: int = 64, keep: int = 2):
        self.spark, self.path, self.schema, self.parts, self.keep = spark, path.rstrip("/"), schema, parts, keep
        self.files = Files(spark, path)

    def part(self) -> Column:
        return F.pmod(F.xxhash64("router_id"), F.lit(self.parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that rows fall in, at most as many as there are."""
        return sorted(r[0] for r in rows.select(self.part().alias("p")).distinct().collect())

    def done(self) -> list[int]:
        return sorted(int(n) for n in self.files.names(f"{self.path}/_done") if n.isdigit())

    def version(self) -> int:
        return max(self.done(), default=-1)

    def places(self, version: int) -> dict[str, int]:
        """Version of each part that has rows."""
        return json.loads(self.files.read_text(f"{self.path}/_done/{version}")) if version >= 0 else {}

    def read(self, parts: list[int] | None = None) -> DataFrame:
        at = self.places(self.version())
        paths = [f"{self.path}/v={v}/part={p}" for p, v in at.items() if parts is None or int(p) in parts]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, df: DataFrame, version: int, parts: list[int]) -> None:
        """`df` is all that `parts` hold from now on; other parts stay. Nothing happens if this version or a later one holds."""
        old = self.version()
        if version <= old:
            return
        at = {p: v for p, v in self.places(old).items() if int(p) not in parts}
        if parts:
            df.withColumn("part", self.part()).write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/v={version}")
            at |= {n.removeprefix("part="): version for n in self.files.names(f"{self.path}/v={version}") if n.startswith("part=")}
        self.files.write_text(f"{self.path}/_done/{version}", json.dumps(at))
        self.clean()

    def clean(self) -> None:
        """Pointers but for the last `keep` go, then folders that none of these names."""
        done = self.done()
        held = {f"v={v}/part={p}" for n in done[-self.keep :] for p, v in self.places(n).items()}
        for n in done[: -self.keep]:
            self.files.delete(f"{self.path}/_done/{n}")
        for folder in self.files.names(self.path):
            if folder.startswith("v="):
                parts = [n for n in self.files.names(f"{self.path}/{folder}") if n.startswith("part=")]
                gone = [n for n in parts if f"{folder}/{n}" not in held]
                if len(gone) == len(parts) and int(folder[2:]) < done[-1]:
                    self.files.delete(f"{self.path}/{folder}")
                else:
                    for n in gone:
                        self.files.delete(f"{self.path}/{folder}/{n}")


class Daily:
    """An append-only table by ingest_date. A batch writes files of its own folder, so that running it again replaces them."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.files = Files(spark, path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "false").parquet(self.path) if self.days() else self.spark.createDataFrame([], self.schema)

    def days(self) -> list[str]:
        return sorted({n.removeprefix("ingest_date=") for n in self.files.names(self.path) if n.startswith("ingest_date=")})

    def append(self, df: DataFrame, batch: int) -> None:
        """Rows of one batch, in one folder a day and batch."""
        parts = df.withColumn("batch", F.lit(batch).cast("bigint"))
        parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ingest_date", "batch").parquet(self.path)

    def compact(self, day: str) -> bool:
        """Rewrites a day that no batch writes any more into one folder of its last batch; False if it is one.

        The new folder is whole before a mark says so; only then the old ones go. A run that broke off is taken up at the
        mark. While folders are exchanged, a reader may miss the day.
        """
        at = f"{self.path}/ingest_date={day}"
        fresh, mark = f"{at}/_compact", f"{at}/_compacted"
        batches = [int(n.removeprefix("batch=")) for n in self.files.names(at) if n.startswith("batch=")]
        marked = "_compacted" in self.files.names(at)
        if not marked and len(batches) < 2:
            return False
        if not marked:
            rows = self.spark.read.schema(self.schema).parquet(self.path).where((F.col("ingest_date") == F.lit(day).cast("date")) & (F.col("batch") <= max(batches)))
            rows.drop("ingest_date", "batch").repartition(max(1, len(batches) // 64)).write.mode("overwrite").parquet(fresh)
            self.files.write_text(mark, str(max(batches)))
        if "_compact" in self.files.names(at):
            last = int(self.files.read_text(mark))
            for b in batches:
                if b <= last:
                    self.files.delete(f"{at}/batch={b}")
            self.files.rename(fresh, f"{at}/batch={last}")
        self.files.delete(mark)
        return True

    def drop(self, day: str) -> bool:
        return self.files.delete(f"{self.path}/ingest_date={day}")
