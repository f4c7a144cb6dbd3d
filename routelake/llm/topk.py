"""Exact top-k search: an impact-ordered index, processed score at a time.

Components are whole numbers. In each dimension a block's vectors are ordered by value, and a value's distance from
the worst one for the query's sign is its impact; postings of equal impact form a segment. A query adds up segments
in descending order of weight times impact. It stops only when the bounds prove that vectors outside a small set
can't be members; that set is rescored exactly.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Candidates of a block (about 2.5 kB of memory each at 64 components).
BLOCK = 16384
#: Fractions of the largest contribution down to which segments are processed before each look at the bounds.
STEPS = (0.15, 0.1, 0.07, 0.045, 0.02, 0.0)
#: Widest range of values for which the number of postings at each impact is kept in a table.
LEVELS = 4096


class ImpactIndex:
    """Postings of a block: for each sign of a query's weight and each dimension, places by descending impact."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        n, width = matrix.shape
        self.ids, self.exact = ids, matrix.astype(np.int64)
        # products of components under 2^20 are exact in doubles, which add up faster
        self.matrix = matrix.astype(np.float64) if np.abs(matrix).max(initial=0) < 1 << 20 else self.exact
        # small numbers are sorted by digits
        keys = matrix.T.astype(np.int16 if np.abs(matrix).max(initial=0) < 1 << 15 else np.int64)
        order = np.argsort(np.ascontiguousarray(keys), axis=1, kind="stable")
        values = np.take_along_axis(matrix.T, order, axis=1)
        self.low, self.high = values[:, 0].astype(np.float64), values[:, -1].astype(np.float64)
        self.order = {True: order[:, ::-1].copy(), False: order.copy()}
        self.impact = {True: values[:, ::-1] - self.low[:, None], False: self.high[:, None] - values}
        levels = int((self.high - self.low).max(initial=0)) + 2
        self.at_least = {up: np.stack([n - np.searchsorted(x[::-1], np.arange(levels)) for x in self.impact[up]]) for up in (True, False)} if levels <= LEVELS else None

    def processed(self, dims: np.ndarray, up: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Postings of each dimension with an impact of `need` or more."""
        if self.at_least is None:
            return np.array([len(self.ids) - np.searchsorted(self.impact[bool(u)][d][::-1], x) for d, u, x in zip(dims, up, need, strict=True)], np.int64)
        at = np.minimum(need, self.at_least[True].shape[1] - 1).astype(np.int64)
        return np.where(up, self.at_least[True][dims, at], self.at_least[False][dims, at])

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) that hold the k best of the block but `own`."""
        n, dims = len(self.ids), np.flatnonzero(query)
        alive = self.ids != own
        maybe, asked = np.flatnonzero(alive), query.astype(self.matrix.dtype)
        if len(maybe) > 8 * k and len(dims) and self.matrix is not self.exact:
            weight, up = np.abs(asked[dims]), query[dims] > 0
            most = weight * (self.high[dims] - self.low[dims])
            base = float((asked[dims] * np.where(up, self.low[dims], self.high[dims])).sum())
            done, least = np.zeros(len(dims), np.int64), -np.inf
            # contributions and, in the low digits, the number of postings
            total, unit = np.zeros(n), float(1 << len(dims).bit_length())
            for step in STEPS:
                bound = max(1.0, float(int(most.max() * step)))  # unprocessed postings contribute less than this
                stop = np.maximum(done, self.processed(dims, up, np.ceil(bound / weight)))
                for j in np.flatnonzero(stop > done):
                    d, u, part = dims[j], bool(up[j]), slice(done[j], stop[j])
                    np.add.at(total, self.order[u][d, part], self.impact[u][d, part] * (weight[j] * unit) + 1.0)
                done = stop
                sure = np.floor(total / unit)
                seen = total - sure * unit
                sure += base
                # exact scores of the leaders give a floor under the k-th best
                lead = np.argpartition(np.where(alive, sure + seen * bound, -np.inf), -2 * k)[-2 * k :]
                least = max(least, np.partition(self.matrix[lead[alive[lead]]] @ asked, -k)[-k])
                upper = sure + float(np.minimum(most, bound - 1).sum()) - seen * (bound - 1)
                maybe = np.flatnonzero(alive & (upper >= least))
                if len(maybe) <= max(4 * k, n // 4) or bound == 1:
                    break
        return self.ids[maybe], (self.matrix[maybe] @ asked).astype(np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search(embeddings: DataFrame, query, k: int = 20, scale: int = 64, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of greatest inner product for each row where `query` (a column) is true.

    Components count as floor(scale * x). A row isn't its own candidate (rows of one vec_id count as one's own); ties
    go to smaller vec_ids; with fewer than k candidates all are returned. Null, empty, non-finite vectors and null
    vec_ids take no part; zero vectors do, and only vectors of one length meet. Queries that repeat a vec_id and vector
    count once; different vectors of one vec_id are queries of their own. Candidates are dealt into blocks, each
    indexed once; queries are streamed past every block, which returns k rows a query at most. A block of up to 8 * k
    candidates, or with components of 2^20 and more, is scored as a whole. Empty table: none.
    """
    import pyarrow as pa

    finite = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & (F.size("embedding") > 0)
    rows = stored(embeddings.where(finite & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(query, F.lit(False)).alias("asks"), F.size("embedding").alias("dim"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v")))
    n, widest = rows.agg(F.count("*"), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    blocks = 1 + n // block
    # numbers travel as small as they are
    kind = "smallint" if (widest or 0) < 1 << 15 else "int" if widest < 1 << 31 else "bigint"
    v = F.col("v").cast(f"array<{kind}>").alias("v")
    held = rows.select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "vec_id", v)
    asked = rows.where("asks").dropDuplicates(["vec_id", "v"]).select("dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", v)

    def run(batches):
        at, index, ids, parts = None, None, [], []
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1 if batch.num_rows > 1 else []
            for first, last in zip(np.r_[0, cuts].astype(int), np.r_[cuts, batch.num_rows].astype(int), strict=True):
                if last == first:
                    continue
                part, here = batch.slice(first, last - first), (cols[0][first], cols[1][first])
                own = part.column(3).to_numpy()
                matrix = np.asarray(part.column(4).flatten()).reshape(len(own), -1).astype(np.int64)
                if here != at:
                    at, index, ids, parts = here, None, [], []
                if not cols[2][first]:
                    ids.append(own)
                    parts.append(matrix)
                    continue
                if not parts:
                    continue  # no candidates of this length here
                if index is None:
                    index = ImpactIndex(np.concatenate(ids), np.concatenate(parts))
                found = [(i, *index.top(q, i, k), zlib.crc32(q.tobytes())) for i, q in zip(own, matrix, strict=True)]
                made = [(i, some[j], score[j], mark) for i, some, score, mark in found for j in best(some, score, k)]
                columns = list(zip(*made, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.int64)) for x in columns], names=["query_id", "vec_id", "score", "mark"])

    both = held.unionByName(asked).repartition("dim", "block").sortWithinPartitions("dim", "block", "asks")
    found = both.mapInArrow(run, "query_id bigint, vec_id bigint, score bigint, mark bigint")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
