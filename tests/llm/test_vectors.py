"""Vector operators against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from routelake.llm import topk, vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def odd_vectors() -> list[tuple]:
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        v = rng.normal(size=16)
        rows.append((i, (v / np.linalg.norm(v)).astype(np.float32).tolist(), i % 3))
    for i in range(300, 420):  # near and exact copies
        v = np.array(rows[i % 20][1]) + rng.normal(size=16) * 0.025 * (i % 3)
        rows.append((i, v.astype(np.float32).tolist(), None if i % 11 == 0 else rows[i % 20][2]))
    v = rows[0][1]
    return [*rows, (500, None, 1), (501, [], 1), (502, [0.0] * 16, 1), (503, [None, *v[1:]], 1), (504, [float("nan"), *v[1:]], 1), (505, [float("inf"), *v[1:]], 1), (506, v[:8], 0), (None, v, 0), (0, v, 0), (520, v, 0), (540, v, 0), (560, [1e-30 * x for x in v], 0), (20, rows[7][1], 1)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(odd_vectors(), SCHEMA).withColumns({"code": F.lit(1), "a": F.lit(2), "rank": F.lit(3), "v": F.lit(0)})


def finite(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [8192, 60])
def test_search_equals_brute_force(spark, frame, block):
    rows = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int)) for i, v, _ in odd_vectors() if i is not None and finite(v)]
    got = Counter(map(tuple, topk.search(frame, F.col("vec_id") % 20 == 0, block=block).collect()))
    want, asked = Counter(), set()
    for i, q in rows:
        if i % 20 == 0 and (i, tuple(q)) not in asked:  # queries that repeat an id and vector count once
            asked.add((i, tuple(q)))
            found = sorted((-int(q @ v), j) for j, v in rows if j != i and len(v) == len(q))
            want.update((i, k, j, -s) for k, (s, j) in enumerate(found[:20], 1))
    assert got == want and len(asked) > len({i for i, _ in asked})
    assert topk.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    wide = spark.createDataFrame([(20 * i, [1e6 * i, 1.0], 0) for i in range(5)], SCHEMA)
    assert [(r.query_id, r.vec_id, r.score) for r in topk.search(wide, F.lit(True)).where("rank = 1").orderBy("query_id").collect()] == [(0, 20, 4096), (20, 80, 64**2 * (4 * 10**12 + 1)), (40, 80, 64**2 * (8 * 10**12 + 1)), (60, 80, 64**2 * (12 * 10**12 + 1)), (80, 60, 64**2 * (12 * 10**12 + 1))]


def test_bounds_hold_and_stop_early():
    rng = np.random.default_rng(8)
    matrix = rng.normal(scale=8, size=(3000, 32)).round().astype(np.int64)
    matrix[5:40] = matrix[4] + rng.integers(-1, 2, (35, 32))
    index, touched = topk.ImpactIndex(np.arange(3000), matrix), []
    for q in (4, 7, 100):
        ids, score = index.top(matrix[q], q, 10)
        full = matrix @ matrix[q]
        want = [i for i in np.lexsort((np.arange(3000), -full)) if i != q][:10]
        assert ids[topk.best(ids, score, 10)].tolist() == want
        touched.append(len(ids))
    assert min(touched) < 300


def test_links_equal_brute_force(spark, frame):
    rows = [(i, v, n) for i, v, n in odd_vectors()]
    ok = [k for k, (i, v, n) in enumerate(rows) if i is not None and n is not None and finite(v) and any(v)]
    unit = {k: np.array(rows[k][1], np.float32).astype(float) for k in ok}
    links, parent = dict.fromkeys(ok, 0), {k: k for k in ok}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    total = 0
    for x, a in enumerate(ok):
        for b in ok[x + 1 :]:
            u, v = unit[a], unit[b]
            if rows[a][2] == rows[b][2] and len(u) == len(v) and u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= 0.98:
                total, links[a], links[b], parent[root(a)] = total + 1, links[a] + 1, links[b] + 1, root(b)
    group = {}
    for k in ok:
        group.setdefault(root(k), []).append(rows[k][0])
    want = sorted(str((r[0], links.get(k, 0), min(group[root(k)]) if k in links else r[0])) for k, r in enumerate(rows))
    got = [(r.vec_id, r.n_links, r.component_id) for r in vectors.linked(frame).collect()]
    assert len(got) == len(rows)
    same = len([1 for a, b in zip(sorted(map(str, got)), want, strict=True) if a == b])
    assert same >= 0.98 * len(rows) and sum(g[1] for g in got) / 2 >= 0.97 * total > 100
    assert vectors.linked(spark.createDataFrame([], SCHEMA)).count() == 0
    alone = spark.createDataFrame([(1, [1.0, 2.0], 3)], SCHEMA)
    assert [tuple(r) for r in vectors.linked(alone).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("common", [0.0, 1.0, 2.0])
def test_recall_near_the_threshold(spark, common):
    """The table's vectors, alone and with a direction that all share, with copies at angles on both sides of the threshold."""
    rng = np.random.default_rng(9)
    base = np.stack(spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").toPandas().embedding)
    base = base + common * np.eye(base.shape[1])[3] * np.linalg.norm(base, axis=1).mean()
    noise = rng.normal(size=base.shape)
    noise *= (rng.uniform(0.05, 0.25, len(base)) * np.linalg.norm(base, axis=1) / np.linalg.norm(noise, axis=1))[:, None]
    m = np.concatenate([base, base + noise]).astype(np.float32)
    label = np.arange(len(m)) % 5
    frame = spark.createDataFrame([(i, v.tolist(), int(n)) for i, (v, n) in enumerate(zip(m, label, strict=True))], SCHEMA)
    x = m.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = ((x @ x.T >= 0.98) & (label[:, None] == label[None, :])).sum(1) - 1
    got = vectors.linked(frame).toPandas().sort_values("vec_id").n_links.to_numpy()
    assert (got <= links).all() and got.sum() >= 0.98 * links.sum() > 1000


@pytest.mark.parametrize("block", [1024, 7])
def test_blocks_of_a_bucket_count_each_pair_once(spark, monkeypatch, block):
    """One direction with many near copies, equal ones and one id on two vectors among them."""
    rng = np.random.default_rng(10)
    v = rng.normal(size=(60, 8)) * 0.02 + np.arange(1, 9)
    rows = [(i // 2 if i < 4 else i, v[i % 50].astype(np.float32).tolist(), 1) for i in range(60)]
    monkeypatch.setattr(vectors, "BLOCK", block)
    got = vectors.linked(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted((i, 59, 0) for i, _, _ in rows)
