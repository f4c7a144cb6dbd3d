"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed words is shared by all grades; ordered thresholds t1 < t2 < ... give
P(grade >= k) = sigmoid(w.x - t_k), and so the expected grade and the tail probability for selection.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_text, release

WORD = re.compile(r"\w+")
UPPER, MARKS, DIGITS = bytes(range(65, 91)), b"!|#<>{}[]@$%^&*=~", b"0123456789"
_INDEX: dict[str, int] = {}


def forget() -> None:
    """At a task's end: what words were hashed to goes."""
    _INDEX.clear()
    release()


def features(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a whole text: log(1 + count) of hashed words and their beginnings, and a few shape features.

    Beginnings of four and five letters stand for inflected words. Values are divided by the square root of their
    length, so that a long text's many words weigh more than a short one's, but less than their number.
    """
    raw, mask = text.encode(), (1 << bits) - 1
    words = Counter(WORD.findall(text.lower()))
    counts = Counter(words)
    for w, c in words.items():
        if len(w) > 4:
            counts[w[:4] + "*"] += c
            if len(w) > 5:
                counts[w[:5] + "*"] += c
    if len(_INDEX) > 300_000:
        _INDEX.clear()
    found = np.empty(len(counts), np.int64)
    for i, w in enumerate(counts):
        h = _INDEX.get(w)
        if h is None:
            h = _INDEX[w] = zlib.crc32(w.encode())
        found[i] = h
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    value /= (value**2).sum() ** 0.25 or 1.0
    n, total = max(len(raw), 1), max(sum(words.values()), 1)
    shape = [(n - len(raw.translate(None, UPPER))) / n * 4, (n - len(raw.translate(None, MARKS))) / n * 8, (n - len(raw.translate(None, DIGITS))) / n * 4, len(words) / total, min(n / total, 40) / 40, min(total, 1000) / 1000]
    return np.r_[found & mask, mask + 1 + np.arange(len(shape))], np.r_[value, shape]


#: Number of shape features.
SHAPES = 6


def pack(texts: list[str], bits: int) -> dict[str, list]:
    made = [features(t, bits) for t in texts]
    return {"at": [a.astype("<i4").tobytes() for a, _ in made], "value": [v.astype("<f4").tobytes() for _, v in made]}


def slopes(s: np.ndarray, y: np.ndarray, raw: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(mean negative log-likelihood of grades y at scores s, its slopes by score, its slopes by raw: the first threshold and the logarithms of the steps behind it)."""
    t, n, each = np.cumsum(np.r_[raw[:1], np.exp(raw[1:])]), len(y), np.arange(len(y))
    tail = np.c_[np.ones(n), 1 / (1 + np.exp(-np.clip(s[:, None] - t, -30, 30))), np.zeros(n)]
    p = np.maximum(tail[each, y] - tail[each, y + 1], 1e-9)
    slope = tail * (1 - tail)
    gt, top = np.zeros(len(t)), len(t)
    np.add.at(gt, y[y > 0] - 1, (slope[each, y] / p / n)[y > 0])
    np.add.at(gt, y[y < top], -(slope[each, y + 1] / p / n)[y < top])
    after = np.cumsum(gt[::-1])[::-1]  # a step moves all later thresholds
    return -float(np.log(p).mean()), -(slope[each, y] - slope[each, y + 1]) / p / n, np.r_[after[:1], after[1:] * np.exp(raw[1:])]


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int, bits: int, epochs: int = 12, batch: int = 128, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) that maximise the likelihood of (grade, indices, values) rows, by Adam on shuffled batches."""
    width = (1 << bits) + SHAPES
    w, raw = np.zeros(width), np.r_[-1.0, np.zeros(max(grades - 2, 0))]  # thresholds: raw[0], then steps exp(raw[k])
    if not rows or grades < 2:
        return w, np.cumsum(np.r_[raw[:1], np.exp(raw[1:])])
    m, v = [np.zeros(width), np.zeros(len(raw))], [np.zeros(width), np.zeros(len(raw))]
    rng, step = np.random.default_rng(seed), 0
    for epoch in range(epochs):
        order, speed = rng.permutation(len(rows)), rate * (1 - epoch / epochs)
        for k in range(0, len(order), batch):
            part = [rows[i] for i in order[k : k + batch]]
            y = np.array([p[0] for p in part])
            at, value = np.concatenate([p[1] for p in part]), np.concatenate([p[2] for p in part]).astype(np.float64)
            row = np.repeat(np.arange(len(part)), [len(p[1]) for p in part])
            _, gs, gr = slopes(np.bincount(row, w[at] * value, len(part)), y, raw)
            step += 1
            for j, (x, g) in enumerate(((w, np.bincount(at, gs[row] * value, width) + decay * w), (raw, gr))):
                m[j] += 0.1 * (g - m[j])
                v[j] += 0.01 * (g * g - v[j])
                x -= speed * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.99**step)) + 1e-8)
    return w, np.cumsum(np.r_[raw[:1], np.exp(raw[1:])])


def train(docs: DataFrame, graded: DataFrame, grades: int, bits: int = 18, most: int = 12_000, **options) -> tuple[np.ndarray, np.ndarray]:
    """Fits on at most `most` graded rows (doc_id, grade), those of smallest hash of doc_id.

    The bound is the operator's documented parameter: it limits what the driver holds (most * words of a text)
    and what is broadcast. Null ids and grades outside 0..grades-1 take no part; a doc_id with two grades counts twice;
    of rows that share an id, the text of smallest hash is taken.
    """
    sample = graded.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1)).select("doc_id", F.col("grade").cast("int").alias("grade"))
    sample = sample.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "grade").limit(most)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample.distinct()), "doc_id")
    joined = joined.groupBy("doc_id", "grade").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    rows = map_text(joined, lambda texts: pack(texts, bits), ["doc_id", "grade"], "text", "at binary, value binary", forget).collect()
    rows.sort(key=lambda r: (r.doc_id, r.grade, bytes(r.at)))
    return fit([(r.grade, np.frombuffer(r.at, "<i4"), np.frombuffer(r.value, "<f4")) for r in rows], grades, bits, **options)


def grade(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str], bits: int = 18) -> DataFrame:
    """Columns `keep` and expected_grade, p_tail (of the highest grade) for every whole text; null counts as empty."""
    w, t = model[0].astype(np.float32), model[1]

    def run(texts: list[str]) -> dict[str, list]:
        s = np.array([float((w[a] * v).sum()) for a, v in (features(x, bits) for x in texts)])
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - t, -30, 30)))
        return {"expected_grade": tail.sum(1), "p_tail": tail[:, -1]}

    return map_text(docs, run, keep, "text", "expected_grade double, p_tail double", forget)


def graded_labels(labels: DataFrame) -> DataFrame:
    """Three ordered grades from the two marks: 0 toxic, 1 of low quality, 2 good. A row with a null mark takes no part."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("toxic").isNull() | F.col("quality").isNull(), None).otherwise(1 + F.col("quality")).alias("grade"))


def select_good(docs: DataFrame, labels: DataFrame, keep: list[str], least: float = 0.5, bits: int = 18, most: int = 12_000) -> DataFrame:
    """Rows of `docs` whose probability of the highest grade is at least `least`, with expected_grade and p_tail.

    Empty and null texts are scored by their shape alone; repeated rows are scored alike; no labels: every row has
    a probability of the starting thresholds; an empty table gives none. One map over the texts, no shuffle of them.
    """
    return grade(docs, train(docs, graded_labels(labels), 3, bits, most), keep, bits).where(F.col("p_tail") >= least)
