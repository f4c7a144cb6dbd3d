"""Embedding near-dedup: iterative quantisation, multi-index Hamming tables, rerank with the original vectors.

Rotations that bring centred vectors near to balanced binary codes give each vector bits; a table is keyed by some of
them, and vectors that agree in all bits of a table are compared by cosine, block by block. How many bits and tables there
are follows from the number of vectors and from sample vectors turned away by just the threshold.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, small, stored

#: Bits of a rotation, vectors that a bucket should hold, tables at most, and the share of pairs at the threshold that must meet.
BITS, FILL, TABLES, RECALL = 64, 64, 32, 0.995
#: Members of a bucket in a block: a task holds two, and their cosines.
BLOCK = 1024


def usable(v: str = "embedding"):
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, else squares of very small or large components are lost."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rotation(v: np.ndarray, seed: int, rounds: int = 50) -> np.ndarray:
    """The rotation that brings projected vectors nearest to binary codes, from a random start."""
    bits = v.shape[1]
    r, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
    for _ in range(rounds):
        code = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(code.T @ v)
        r = (u @ w).T
    return r


class Tables:
    """mean, and projections of dimension * (tables * width): column t * width + j gives bit j of table t."""

    def __init__(self, sample: np.ndarray, n: int, least: float, seed: int = 5):
        """For n vectors like the sample; the fewest tables that keep RECALL of sample vectors with turned copies, fewer bits if TABLES can't. Up to FILL vectors all meet."""
        if n <= FILL:
            self.width, self.count = 0, 1
            return
        x = unit(sample)
        self.mean = x.mean(0)
        v = x - self.mean
        _, axes = np.linalg.eigh(v.T @ v)
        axes = axes[:, ::-1][:, : min(BITS, x.shape[1])]
        bits, turns = axes.shape[1], []
        a = x[np.random.default_rng(seed).permutation(len(x))[:2000]]
        b = turned(a, least, seed)
        for width in range(min(bits, 24, int(math.log2(n / FILL))), -1, -1):
            parts, met = [], np.zeros(len(a), bool)
            for t in range(TABLES if width else 1):
                r, k = divmod(t, bits // max(width, 1))
                if width and r == len(turns):
                    turns.append(axes @ rotation(v @ axes, seed + r))
                parts.append(turns[r][:, k * width : (k + 1) * width] if width else np.zeros((x.shape[1], 0)))
                met |= (((a - self.mean) @ parts[-1] >= 0) == ((b - self.mean) @ parts[-1] >= 0)).all(1)
                if met.mean() >= RECALL:
                    break
            if met.mean() >= RECALL:
                break
        self.width, self.count, self.projection = width, len(parts), np.concatenate(parts, axis=1)

    def values(self, x: np.ndarray) -> np.ndarray:
        """Each vector's key in each table."""
        if not self.width:
            return np.zeros((len(x), 1), np.int64)
        bit = ((unit(x) - self.mean) @ self.projection >= 0).reshape(len(x), self.count, self.width)
        return (bit << np.arange(self.width)).sum(2)


def turned(x: np.ndarray, cosine: float, seed: int) -> np.ndarray:
    """Unit vectors at just this cosine from each unit row, in random directions; in one dimension the rows themselves."""
    g = np.random.default_rng(seed).normal(size=x.shape)
    g -= (g * x).sum(1, keepdims=True) * x
    size = np.linalg.norm(g, axis=1, keepdims=True)
    return np.where(size > 1e-9, cosine * x + math.sqrt(1 - cosine**2) * g / np.maximum(size, 1e-9), x)


def keyed(distinct: DataFrame, models: dict[int, Tables]) -> DataFrame:
    """Adds parts: array<int>, the keys of the tables of the vector's length."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    out = StructType([*distinct.schema, StructField("parts", ArrayType(IntegerType()))])
    schema, place = to_arrow_schema(out), distinct.columns.index("embedding")

    def run(batches):
        for batch in batches:
            rows = batch.column(place).to_pylist()
            sizes, parts = np.array([len(r) for r in rows]), [None] * len(rows)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for i, row in zip(at, models[int(dim)].values(np.array([rows[i] for i in at], np.float64)).tolist(), strict=True):
                    parts[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts, schema.types[-1])], schema=schema)

    return distinct.mapInArrow(run, out)


def alike(x: np.ndarray, least: float) -> np.ndarray:
    """[i, j]: whether the cosine of rows i and j is `least` or more; pairs at the edge are summed one component after another, as SQL does."""
    u = unit(x)
    g = u @ u.T
    out = g >= least
    for i, j in np.argwhere(np.abs(g - least) < 1e-12):
        dot = lambda p, q: sum(a * b for a, b in zip(p.tolist(), q.tolist(), strict=True))
        out[i, j] = dot(x[i], x[j]) / (math.sqrt(dot(x[i], x[i])) * math.sqrt(dot(x[j], x[j]))) >= least
    np.fill_diagonal(out, False)
    return out


def judged(table: int, own: np.ndarray | None, parts: np.ndarray, copies: np.ndarray, x: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members with links, their sums of partners' copies, the first member that links reach). A pair counts in the first table where it meets; own: the block of each where two blocks meet, of which only unlike ones are compared."""
    link = alike(x, least)
    if own is not None:
        link &= own[:, None] != own[None, :]
    some = np.flatnonzero(link.any(1))
    link = link[np.ix_(some, some)]
    for t in range(table):
        link &= parts[some, t][:, None] != parts[some, t][None, :]
    label = np.arange(len(some))
    while len(some):
        heard = np.minimum(label, np.where(link, label[None, :], len(some)).min(1))
        heard = heard[heard]
        if (heard == label).all():
            break
        label = heard
    return some, link @ copies[some], some[label] if len(some) else some


def compared(members: DataFrame, least: float) -> DataFrame:
    """(key, n, root): for members of buckets, sums of partners' copies, and a member that links reach. No pair is emitted; a bucket of
    more than BLOCK members is dealt out by pairs of blocks."""
    import pyarrow as pa

    by = ["label", "dim", "part", "value", "low", "high"]
    spread = F.coalesce(F.ceil(F.col("m") / BLOCK), F.lit(1)).cast("int")
    rows = members.withColumn("own", F.pmod(F.xxhash64("key"), spread).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), spread - 1)))
    rows = rows.select("label", "dim", "part", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "key", "copies", "parts", "embedding")

    def run(batches):
        held: list[tuple] = []

        def done():
            made: list[tuple] = []
            if len(held) > 1:
                own, keys = np.array([r[6] for r in held]) if held[0][4] != held[0][5] else None, [r[7] for r in held]
                at, n, root = judged(held[0][2], own, np.array([r[9] for r in held]), np.array([r[8] for r in held]), np.array([r[10] for r in held], np.float64), least)
                made = [(keys[i], int(k), keys[j]) for i, k, j in zip(at, n, root, strict=True) if k]
            held.clear()
            cols = list(zip(*made, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], names=["key", "n", "root"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][:6] != row[:6]:
                    yield done()
                held.append(row)
        if held:
            yield done()

    return rows.repartition(*by).sortWithinPartitions(*by, "key").mapInArrow(run, "key string, n bigint, root string")


def linked(embeddings: DataFrame, least: float = 0.98, most: int = 20_000) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row: links join vectors of one label at cosine >= `least`.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or vec_id,
    link with nothing (component_id is vec_id, kept); so do vectors of different lengths. Equal vectors are compared
    once: their count stands for them. Rows that share a vec_id but not the vector are vectors of their own, and count one
    by one. The rotations are fitted on at most `most` distinct vectors of each length (the documented bound), those of
    smallest hash; every vector is indexed, and all that meet in a table are compared, without a cap. An empty table
    gives none.
    """
    rows = embeddings.select("vec_id", "embedding", "label")
    good = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    groups = rows.where(good).groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # 96 bits of hash name a distinct vector
    name = F.concat(F.lpad(F.hex(F.xxhash64("label", "embedding")), 16, "0"), F.lpad(F.hex(F.hash("embedding", "label").bitwiseAND(F.lit(0x7FFFFFFF))), 8, "0"))
    groups = stored(groups.withColumns({"key": name, "dim": F.size("embedding")}))
    # the largest label of each length says how full buckets get
    models = {}
    for d, n in groups.groupBy("label", "dim").count().groupBy("dim").agg(F.max("count").alias("n")).collect():
        sample = groups.where(F.col("dim") == d).select("key", "embedding").orderBy("key").limit(most if n > FILL else 0).select("embedding").toPandas()["embedding"]
        models[d] = Tables(np.array(list(sample), np.float64), n, least)
    distinct = stored(keyed(groups, models))
    bucket = ["label", "dim", "part", "value"]
    slim = distinct.select("label", "dim", F.posexplode("parts").alias("part", "value"))
    large = cut(slim.groupBy(*bucket).agg(F.count("*").alias("m")).where(F.col("m") > BLOCK))
    members = distinct.select("label", "dim", F.posexplode("parts").alias("part", "value"), "key", "copies", "parts", "embedding").join(small(large), bucket, "left")
    found = stored(compared(members, least))
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    label = components(found.where("key <> root").select(F.col("key").alias("a"), F.col("root").alias("b")).distinct())
    first = distinct.join(label, distinct.key == label.id).groupBy("component").agg(F.min("rep").alias("component_id"))
    smallest = label.join(first, "component").select("id", "component_id")
    facts = distinct.select("label", "embedding", "rep", "copies", "key").join(counts, "key", "left").join(smallest, F.col("key") == F.col("id"), "left")
    facts = facts.select(F.col("label").alias("l"), F.col("embedding").alias("e"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    got = rows.where(good).join(facts, (F.col("label") == F.col("l")) & (F.col("embedding") == F.col("e"))).select("vec_id", "n_links", "component_id")
    rest = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return got.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
