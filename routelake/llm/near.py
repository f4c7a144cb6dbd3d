"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A shingle of five words weighs its count in the text times the mean idf of its words. Document frequencies are kept
in a table of fixed size by hash of the word, so what is broadcast does not grow with the data. A shingle's own
document frequency would not do: in a large group of near copies the shared shingles would lose their weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, map_text, release, small, stored

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 9, 3
#: Size of the table of document frequencies.
DF_BITS = 18
#: Members of a bucket in a block.
BLOCK = 1500
SALT = 64
_HASH: dict[str, int] = {}


def forget() -> None:
    """At a task's end: what words were hashed to goes."""
    _HASH.clear()
    release()


def word_hashes(text: str) -> np.ndarray:
    if len(_HASH) > 100_000:
        _HASH.clear()
    out = []
    for w in text.lower().split():
        h = _HASH.get(w)
        if h is None:
            h = _HASH[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        out.append(h)
    return np.array(out, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and weights of a whole text's shingles; a text of one to four words has one shingle."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.float32)
    k, n = min(SHINGLE, len(h)), max(1, len(h) - SHINGLE + 1)
    value = idf[(h & np.uint64((1 << DF_BITS) - 1)).astype(np.int64)].astype(np.float64)
    keys, mean = np.zeros(n, np.uint64), np.zeros(n)
    for i in range(k):
        keys = mixed(keys + h[i : i + n])
        mean += value[i : i + n]
    keys, first, count = np.unique(keys, return_index=True, return_counts=True)
    return keys, (mean[first] / k * count).astype(np.float32)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: sum of least weights over sum of greatest."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - both
    return both / total if total else 0.0


def sketch(parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of BANDS * ROWS samples for each (keys, weights), none of them empty."""
    sizes = np.array([len(k) for k, _ in parts])
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    keys, log_s = np.concatenate([k for k, _ in parts]), np.log(np.concatenate([w for _, w in parts]))
    row = np.repeat(np.arange(len(parts)), sizes)
    out, unit = np.empty((len(parts), BANDS * ROWS), np.uint64), np.float32(2.0**-32)
    for k in range(BANDS * ROWS):
        z = mixed(keys + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        u = (z.view(np.uint32).reshape(-1, 2).astype(np.float32) + np.float32(0.5)) * unit
        log_c = np.log(-np.log(np.minimum(u[:, 0] * u[:, 1], np.float32(1 - 2.0**-24))))
        z = mixed(z)
        u = (z.view(np.uint32).reshape(-1, 2).astype(np.float32) + np.float32(0.5)) * unit
        shift = ((z * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        r = -np.log(np.minimum(u[:, 0] * u[:, 1], np.float32(1 - 2.0**-24)))
        t = np.floor(log_s / r + shift)
        log_a = log_c - r * (t - shift) - r
        least = np.minimum.reduceat(log_a, starts)
        at = np.flatnonzero(log_a == least[row])
        at = at[np.searchsorted(row[at], np.arange(len(parts)))]
        out[:, k] = mixed(keys[at] ^ mixed(t[at].astype(np.int64).view(np.uint64) + np.uint64(k)))
    return out


def frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(documents with a word of each hash, documents), over all rows. A table of fixed size comes to the driver."""
    import pyarrow as pa

    parts, width = 64, (1 << DF_BITS) // 64

    def count(batches):
        total, n = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                for t in batch.column(0).slice(first, 256).to_pylist():
                    n += 1
                    if t:
                        total[np.unique((word_hashes(t) & np.uint64((1 << DF_BITS) - 1)).astype(np.int64))] += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([*range(parts), -1], pa.int32()), pa.array([*(x.tobytes() for x in total.reshape(parts, width)), np.int64(n).tobytes()], pa.binary())], names=["part", "n"])
        forget()

    # in two steps, so that no task reads what all others have made
    tables = docs.select(text).mapInArrow(count, "part int, n binary").withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    for by in (["part", "salt"], ["part"]):
        tables = tables.repartition(*by).select("part", "n").mapInArrow(_summed, "part int, n binary").withColumn("salt", F.lit(0))
    got = {r.part: np.frombuffer(r.n, np.int64) for r in tables.collect()}
    table = np.concatenate([got[k] for k in range(parts)]) if got else np.zeros(1 << DF_BITS, np.int64)
    return table, int(got[-1][0]) if got else 0


def _summed(batches):
    """Adds up the parts of tables that a task reads, one batch in memory at a time."""
    import pyarrow as pa

    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            n = np.frombuffer(raw.as_buffer(), np.int64)
            total[part] = total[part] + n if part in total else n.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "n"])


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(a, b, similarity) of `pairs` (a, b: keys) by whole texts; `texts` has key, text.

    A hub's partners are dealt out by salt, the hub's text goes to each salt; rows of one (a, salt) run one after
    another, the hub first, so two texts are in memory at a time.
    """
    import pyarrow as pa

    rows = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)).cast("int"))
    wanted = rows.select("a", "salt", F.lit(0).alias("kind"), F.col("a").alias("want")).distinct().unionByName(rows.select("a", "salt", F.lit(1).alias("kind"), F.col("b").alias("want")))
    joined = wanted.join(texts, wanted.want == texts.key).select("a", "salt", "kind", F.col("want").alias("b"), "text")

    def run(batches: Iterator) -> Iterator:
        at, hub = None, None
        for batch in batches:
            made: list[tuple] = []
            for i in range(batch.num_rows):
                a, salt, kind, b = (batch.column(k)[i].as_py() for k in range(4))
                if kind == 0:
                    if at != a:
                        at, hub = a, shingles(batch.column(4)[i].as_py() or "", idf)
                else:
                    assert at == a
                    made.append((a, b, similarity(hub, shingles(batch.column(4)[i].as_py() or "", idf))))
            cols = list(zip(*made, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.float64())], names=["a", "b", "similarity"])
        forget()

    return joined.repartition("a", "salt").sortWithinPartitions("a", "salt", "kind").mapInArrow(run, "a binary, b binary, similarity double")


def compared(members: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """(a, b): links that join members of one bucket whose classes differ, enough of them to join all classes that links join.

    Two members are compared in the first band where they meet, unless their total weights are too far apart or their
    classes have met by then; those with the most equal samples first. A bucket of more than BLOCK members is dealt out by pairs of blocks, so a task holds two blocks.
    """
    import pyarrow as pa

    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = members.withColumn("own", F.pmod(F.xxhash64("key"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("band", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "key", "component", "samples", "total", "text")

    def judge(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        band, low, high = group[0][0], group[0][2], group[0][3]
        own, keys = np.array([r[4] for r in group]), [r[5] for r in group]
        label = np.unique(np.array([r[6] for r in group], object), return_inverse=True)[1]
        samples, total = np.array([r[7] for r in group], np.int64), np.array([r[8] for r in group])
        read: dict[int, tuple] = {}

        def of(i: int) -> tuple:
            if i not in read:
                read[i] = shingles(group[i][9] or "", idf)
            return read[i]

        out = []
        for i in range(len(group) - 1):
            rest = slice(i + 1, None)
            able = (label[rest] != label[i]) & (np.minimum(total[rest], total[i]) >= least * 0.999 * np.maximum(total[rest], total[i]))
            if low != high:
                able &= own[rest] != own[i]
            at = np.flatnonzero(able) + i + 1
            if not len(at):
                continue
            same = samples[at] == samples[i]
            count = same.sum(1)
            first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1)
            good = first == band
            for j in at[good][np.argsort(-count[good], kind="stable")]:
                if label[j] != label[i] and similarity(of(i), of(j)) >= least:
                    out.append((keys[i], keys[j]))
                    label[label == label[j]] = label[i]
        return out

    def run(batches: Iterator) -> Iterator:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            made = judge(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in made], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in batch.columns)
                if held and held[-1][:4] != row[:4]:
                    yield done()
                held.append(row)
        if held:
            yield done()
        forget()

    by = ["band", "bucket", "low", "high"]
    return rows.repartition(*by).sortWithinPartitions(*by, "key").mapInArrow(run, "a binary, b binary")


def joined_texts(docs: DataFrame, text: str = "text", least: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key of the text, samples of every row; key, rep: smallest doc_id, copies, component of every text with words)."""
    table, n = frequencies(docs, text)
    idf = (np.log((n + 1) / (table + 1)) + 1).astype(np.float32)

    def run(texts: list[str]) -> dict[str, list]:
        parts = [shingles(t, idf) for t in texts]
        some = [i for i, p in enumerate(parts) if len(p[0])]
        out: list = [None] * len(texts)
        for k in range(0, len(some), 128):
            for i, row in zip(some[k : k + 128], sketch([parts[i] for i in some[k : k + 128]]).view(np.int64), strict=True):
                out[i] = row.tolist()
        return {"samples": out, "total": [float(p[1].sum()) for p in parts]}

    key = F.unhex(F.md5(F.col(text).cast("binary")))
    rows = stored(map_text(docs.select("doc_id", F.col(text).alias("text"), key.alias("key")), run, ["doc_id", "key"], "text", "samples array<bigint>, total double", forget))
    distinct = stored(rows.where("samples is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("samples").alias("samples"), F.first("total").alias("total"), F.count("*").alias("copies")))
    bands = F.array(*(F.xxhash64(F.lit(i), *(F.col("samples")[i * ROWS + j] for j in range(ROWS))) for i in range(BANDS)))
    banded = distinct.select("key", F.posexplode(bands).alias("band", "bucket"))
    heads = banded.groupBy("band", "bucket").agg(F.min("key").alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "bucket", "head")
    members = stored(banded.join(heads, ["band", "bucket"]))
    # texts that share a bucket, once: the rounds read them from here
    shared = members.select("key").distinct().join(distinct.select("key", "rep"), "key").withColumnRenamed("key", "k")
    texts = docs.select(F.col("doc_id").alias("id"), F.col(text).alias("text"), key.alias("key"))
    texts = stored(texts.join(shared, (texts.key == shared.k) & texts.id.eqNullSafe(shared.rep)).select("key", "text"))
    pairs = members.where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b")).distinct()
    links = stored(verify(pairs, texts, idf).where(F.col("similarity") >= least).select("a", "b").distinct())
    label = components(links)
    # what is left: buckets whose members are of more than one class
    marked = members.drop("head").join(label, members.key == label.id, "left").select("band", "bucket", "key", F.coalesce("component", "key").alias("component"))
    mixed_up = marked.groupBy("band", "bucket").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m")).where("x <> y").select("band", "bucket", "m")
    left = marked.join(mixed_up, ["band", "bucket"]).join(distinct.select("key", "samples", "total"), "key").join(texts, "key")
    more = stored(compared(left, idf, least).distinct())
    if more.limit(1).count():
        label = components(links.unionByName(more))
    return rows, distinct.join(label, distinct.key == label.id, "left").select("key", "rep", "copies", F.coalesce("component", "key").alias("component"))

def classes(docs: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), class_size (rows), kept (doc_id = class_id) of every row.

    A class: texts that links of weighted Jaccard >= `least` join, and their exact copies. Texts that agree in a band
    of samples are compared: first each with the smallest of its bucket, then those of a bucket whose classes differ
    and whose total weights allow a link, until none is left. Texts without words, and null,
    have classes of their own: class_id is doc_id. Rows repeated with one doc_id come out as often; a null doc_id is
    never a class_id unless all of its class are null. An empty table gives none.
    """
    rows, joined = joined_texts(docs, text, least)
    per = joined.groupBy("component").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"))
    of_key = cut(joined.select("key", "component").join(per, "component").select(F.col("key").alias("k"), "class_id", "class_size"))
    out = rows.select("doc_id", "key", F.col("samples").isNotNull().alias("some")).join(of_key, F.col("key") == F.col("k"), "left")
    alone = ~F.col("some")
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"), (alone | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"))


def kept_rows(docs: DataFrame, keep: list[str], text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Columns `keep` of one row of each class, by row: of its smallest doc_id, then of its first text by hash, then the
    least by `keep`. Rows whose text is null or without words have classes of their own and stay.
    """
    rows, joined = joined_texts(docs, text, least)
    chosen = joined.groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "key")).alias("c")).select(F.col("c.key").alias("k"), F.col("c.rep").alias("rep"))
    found = rows.groupBy("doc_id", "key").agg(F.count("samples").alias("n"))
    found = found.join(chosen, F.col("key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("rep")), "left").where("n = 0 or k is not null")
    found = cut(found.select(F.col("doc_id").alias("id"), F.col("key").alias("k"), "n"))
    keyed = docs.withColumn("key", F.unhex(F.md5(F.col(text).cast("binary"))))
    same = F.col("key").eqNullSafe(F.col("k")) & F.col("doc_id").eqNullSafe(F.col("id"))
    once = keyed.join(found.where("n <= 1"), same, "left_semi").select(keep)
    repeated = keyed.join(small(found.where("n > 1")), same, "left_semi").groupBy("doc_id", "key").agg(F.min(F.struct(*keep)).alias("r")).select("r.*")
    return once.unionByName(repeated)
