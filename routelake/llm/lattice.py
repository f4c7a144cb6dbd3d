"""LM scoring: subword lattice likelihood.

An existing vocabulary's pieces and scores give a unigram model over subwords; all segmentations of a word count,
and a forward recursion in log space gives its marginal probability. No piece spans a word boundary, so a text's
marginal is the product over its words, which lets each distinct word be scored once. The vocabulary's scores are the
start and the prior of the piece probabilities, which expectation maximisation over distinct training words fits. A word
of the training texts is a piece of its own beside them, weighed by its count: one more way through the lattice.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

#: Longer words, in bytes, take the recursion one by one.
LONG = 64
#: Rounds of fitting: no more than these, and none after one that gains less than this share of the log-likelihood.
ROUNDS, GAIN = 8, 0.01
#: Weights of the subword lattice against training counts that are tried, as multiples of the number of distinct words.
WEIGHTS = tuple(2.0**k for k in range(-6, 7))
MULTIPLIER = 0x9E3779B97F4A7C15
SLOTS = 20


class Vocabulary:
    """Pieces as bytes: a word's start is the byte 20; bytes without a piece of their own are pieces too."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: dict[bytes, float] = {}
        for i in range(model.get_piece_size()):
            text, score = model.id_to_piece(i), model.get_score(i)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or "▁" in text[1:]):
                key = (" " + text[1:] if text[0] == "▁" else text).encode()
                pieces[key] = max(score, pieces.get(key, -math.inf))
        floor = min(pieces.values(), default=0.0)
        for b in range(256):
            pieces.setdefault(bytes([b]), floor - 1)
        self.pieces = list(pieces)
        # scores of merged pieces are minus their rank; frequencies fall with it by the Zipf-Mandelbrot law, 1 / (rank + 2.7)
        self.start = -np.log(2.7 - np.array([min(s, 0.0) for s in pieces.values()]))
        self.start -= np.logaddexp.reduce(self.start)
        self.index = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        # open addressing over the keys of all beginnings of pieces
        table = {self.key(piece[:k]): -1 for piece in self.pieces for k in range(1, len(piece))}
        table |= {self.key(p): i for i, p in enumerate(self.pieces)}
        self.keys, self.ids, self.probes = np.zeros(1 << SLOTS, np.uint64), np.full(1 << SLOTS, -2, np.int32), 1
        for k, i in table.items():
            at, step = self.slot(k), 1
            while self.ids[at] != -2:
                at, step = (at + 1) % (1 << SLOTS), step + 1
            self.keys[at], self.ids[at], self.probes = k, i, max(self.probes, step)

    @staticmethod
    def key(piece: bytes) -> int:
        h = 0
        for b in piece:
            h = ((h ^ (b + 1)) * MULTIPLIER) & (2**64 - 1)
            h ^= h >> 29
        return h

    @staticmethod
    def slot(key: int) -> int:
        return (key * MULTIPLIER & (2**64 - 1)) >> (64 - SLOTS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece of each key, -1 for a piece's beginning, -2 for none."""
        at = ((keys * np.uint64(MULTIPLIER)) >> np.uint64(64 - SLOTS)).astype(np.int64)
        out = np.where(self.keys[at] == keys, self.ids[at], -2)
        left = np.flatnonzero((out == -2) & (self.ids[at] != -2))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << SLOTS) - 1)
            hit = self.keys[at[left]] == keys[left]
            out[left[hit]] = self.ids[at[left[hit]]]
            left = left[~hit & (self.ids[at[left]] != -2)]
        return out

    def lattice(self, words: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """Of words of one length, as a byte matrix: (start, stop, words that have a piece there, pieces), by start."""
        n, out = words.shape[1], []
        codes = words.astype(np.uint64) + np.uint64(1)
        for i in range(n):
            rows, h = np.arange(len(words)), np.zeros(len(words), np.uint64)
            for j in range(i, n):
                h = (h ^ codes[rows, j]) * np.uint64(MULTIPLIER)
                h ^= h >> np.uint64(29)
                got = self.find(h)
                if (is_piece := got >= 0).any():
                    out.append((i, j + 1, rows[is_piece], got[is_piece]))
                alive = got != -2
                if not alive.any():
                    break
                if not alive.all():
                    rows, h = rows[alive], h[alive]
        return out

    def forward(self, lattice: list, p: np.ndarray, rows: int, n: int) -> np.ndarray:
        """Log probability of all ways to each place, by word; terms are added relative to the place before."""
        alpha, chance = np.zeros((n + 1, rows)), np.exp(p)
        ends: list[list] = [[] for _ in range(n + 1)]
        for edge in lattice:
            ends[edge[1]].append(edge)
        for j in range(1, n + 1):
            total = np.zeros(rows)
            for i, _, at, piece in ends[j]:
                total[at] += np.exp(alpha[i, at] - alpha[j - 1, at]) * chance[piece]
            alpha[j] = alpha[j - 1] + np.log(total)
        return alpha

    def expected(self, lattice: list, alpha: np.ndarray, p: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """Expected count of each piece over words that occur `counts` times."""
        beta, chance, found = np.zeros((n + 1, len(counts))), np.exp(p), []
        starts: list[list] = [[] for _ in range(n + 1)]
        for edge in lattice:
            starts[edge[0]].append(edge)
        for i in range(n - 1, -1, -1):
            total = np.zeros(len(counts))
            for _, j, at, piece in starts[i]:
                total[at] += np.exp(beta[j, at] - beta[i + 1, at]) * chance[piece]
            beta[i] = beta[i + 1] + np.log(total)
            for _, j, at, piece in starts[i]:
                found.append((piece, np.exp(alpha[i, at] + beta[j, at] - alpha[n, at]) * chance[piece] * counts[at]))
        return np.bincount(*(np.concatenate(x) for x in zip(*found, strict=True)), len(p))

    def one(self, word: bytes, p: np.ndarray, counts: np.ndarray | None = None, times: float = 1) -> float:
        """Marginal of a long word; adds expected counts."""
        n = len(word)
        alpha = [0.0] + [-math.inf] * n
        edges: list[tuple[int, int, int]] = []
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                if (k := self.index.get(word[i:j])) is not None:
                    alpha[j] = float(np.logaddexp(alpha[j], alpha[i] + p[k]))
                    edges.append((i, j, k))
        if counts is not None:
            beta = [-math.inf] * n + [0.0]
            for i, j, k in reversed(edges):
                beta[i] = float(np.logaddexp(beta[i], beta[j] + p[k]))
                counts[k] += times * math.exp(min(0.0, alpha[i] + p[k] + beta[j] - alpha[n]))
        return alpha[n]

    def edges(self, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, stops, pieces) of one word's lattice, by stop; all beginnings are followed side by side."""
        code, n = np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1), len(word)
        at, h, out = np.arange(n), np.zeros(n, np.uint64), []
        for size in range(1, self.longest + 1):
            h = (h ^ code[at + size - 1]) * np.uint64(MULTIPLIER)
            h ^= h >> np.uint64(29)
            got = self.find(h)
            out.append((at[got >= 0], at[got >= 0] + size, got[got >= 0]))
            alive = (got != -2) & (at + size < n)
            at, h = at[alive], h[alive]
            if not len(at):
                break
        start, stop, piece = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((start, stop))
        return start[order], stop[order], piece[order]

    def long(self, word: bytes, p: np.ndarray, counts: np.ndarray | None = None, times: float = 1) -> float:
        """one() for words of any length."""
        start, stop, piece = self.edges(word)
        alpha = [0.0] + [-math.inf] * len(word)
        for i, j, x in zip(start.tolist(), stop.tolist(), p[piece].tolist(), strict=True):
            a, b = alpha[i] + x, alpha[j]
            alpha[j] = a if b == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
        if counts is not None:
            beta, order = [-math.inf] * len(word) + [0.0], np.argsort(-start, kind="stable")
            for i, j, x in zip(start[order].tolist(), stop[order].tolist(), p[piece[order]].tolist(), strict=True):
                a, b = beta[j] + x, beta[i]
                beta[i] = a if b == -math.inf else max(a, b) + math.log1p(math.exp(-abs(a - b)))
            ways = np.array(alpha)[start] + p[piece] + np.array(beta)[stop] - alpha[-1]
            counts += np.bincount(piece, times * np.exp(np.minimum(ways, 0.0)), len(counts))
        return alpha[-1]

    def words(self, words: list[bytes], p: np.ndarray, times: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(marginal log probability of each word, expected piece counts if `times` is given)."""
        out, total = np.empty(len(words)), np.zeros(len(p))
        sizes = np.array([len(w) for w in words])
        for n in np.unique(sizes):
            at = np.flatnonzero(sizes == n)
            if n >= LONG:
                for i in at:
                    out[i] = self.long(b" " + words[i], p, None if times is None else total, 1 if times is None else times[i])
                continue
            for k in range(0, len(at), 4096):
                part = at[k : k + 4096]
                matrix = np.frombuffer(b"".join(b" " + words[i] for i in part), np.uint8).reshape(len(part), n + 1)
                found = self.lattice(matrix)
                alpha = self.forward(found, p, len(part), n + 1)
                out[part] = alpha[n + 1]
                if times is not None:
                    total += self.expected(found, alpha, p, np.array([times[i] for i in part], float), n + 1)
        return out, total


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def packed(docs: DataFrame, block_bytes: int) -> DataFrame:
    """The texts of (doc_id, text, training) rows in blocks of about `block_bytes`, as word counts by number.

    A row of a text: block, doc_id, held_out, n_tokens without the end, n (distinct words), ids and counts (little-endian
    numbers of the width that n tells). A row of a block: block, words by number, c (their counts in training texts). A
    task makes blocks of the texts as it reads them, so no text is shuffled.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = StructType.fromDDL(f"block bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n int, ids binary, counts binary, words array<binary>, c array<bigint>")
    schema = to_arrow_schema(out)

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        number: dict[bytes, int] = {}
        total, rows, size = np.zeros(1024, np.int64), [], 0

        def done():
            n = len(rows)
            cols = list(zip(*rows, strict=True)) or [()] * 6
            made = [pa.array([block] * (n + 1), schema.types[0]), *(pa.array([*c, None], t) for c, t in zip(cols, schema.types[1:7], strict=True)), pa.array([None] * n + [list(number)], schema.types[7]), pa.array([None] * n + [total[: len(number)].tolist()], schema.types[8])]
            number.clear()
            rows.clear()
            total[:] = 0
            return pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                for doc_id, t, trains in zip(*(c.slice(first, 256).to_pylist() for c in batch.columns), strict=True):
                    found = Counter(tokens(t))
                    ids = np.fromiter((number.setdefault(w, len(number)) for w in found), np.int64, len(found))
                    counts = np.fromiter(found.values(), np.int64, len(found))
                    if len(number) > len(total):
                        total = np.r_[total, np.zeros(2 * len(number), np.int64)]
                    if trains:
                        total[ids] += counts
                    rows.append((doc_id, not trains, int(counts.sum()), len(found), ids.astype("<u2" if ids.max(initial=0) < 1 << 16 else "<u4").tobytes(), counts.astype("<u1" if counts.max(initial=0) < 256 else "<u4").tobytes()))
                    size += len(t or "") + 64
                    if size >= block_bytes:
                        yield done()
                        block, size = block + 1, 0
        if rows:
            yield done()

    return docs.select("doc_id", "text", "training").mapInArrow(run, out)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, {0: "<u1", 1: "<u1", 2: "<u2", 4: "<u4"}[len(raw) // max(n, 1)])


def fit(words: DataFrame, ends: int, path: str, rounds: int = ROUNDS, gain: float = GAIN) -> np.ndarray:
    """Log probability of each piece, and of the end as the last, from training counts of distinct words.

    The vocabulary's scores are a prior that weighs one occurrence a piece. Only one number for each piece comes to the
    driver: the vocabulary bounds it. Sums are of whole numbers, so reruns agree.
    """
    vocab = vocabulary(path)
    p, before = vocab.start, -math.inf
    prior = np.r_[np.exp(vocab.start) * len(vocab.pieces), 0.05]
    for _ in range(rounds):
        pieces = p[: len(vocab.pieces)]

        def run(batches, pieces=pieces):
            import pyarrow as pa

            v, total, value = vocabulary(path), np.zeros(len(pieces)), 0.0
            for batch in batches:
                times = batch.column(1).to_numpy()
                m, part = v.words(batch.column(0).to_pylist(), pieces, times.tolist())
                total, value = total + part, value + float((m * times).sum())
            at = np.flatnonzero(total > 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1], pa.int64()), pa.array(np.rint(np.r_[total[at], value] * 4096).astype(np.int64))], names=["piece", "n"])

        got = {r.piece: r.n / 4096 for r in words.where("c > 0").select("word", "c").mapInArrow(run, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        value, counts = got.pop(-1, 0.0), prior.copy()
        for k, n in got.items():
            counts[k] += n
        counts[-1] += ends
        p = np.log(counts / counts.sum())
        if not got or value - before < -gain * value:
            break
        before = value
    return p


def lattice_weight(scored: DataFrame, n: int, v: int) -> float:
    """How many occurrences the subword lattice counts for beside n training tokens of v kinds: of WEIGHTS, what makes each
    token most likely with its own occurrence left out. A sum for each weight comes to the driver."""
    if n <= 1:
        return 1.0
    # of a word that occurs once, only the lattice is left; its probability may be too small for a double
    way = lambda b: F.when(F.col("c") == 1, F.log(b) + F.col("m")).otherwise(F.log(F.col("c") - 1 + b * F.exp("m")))
    left_out = lambda b: F.sum(F.col("c") * (way(b) - F.log(n - 1 + b)))
    got = scored.where("c > 0").agg(*(left_out(F.lit(w * v)).alias(f"w{i}") for i, w in enumerate(WEIGHTS))).first()
    return v * max(zip(got, WEIGHTS, strict=True))[1] if None not in got else float(v)


def score(docs: DataFrame, path: str, training, block_bytes: int = 16_000_000, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score of every row of `docs`.

    `training`: a boolean column; the model learns from rows where it is true. Scores are log10 of the text's
    probability: base of single words with one added to each count, lattice_score of subwords alone, score of the
    lattice in which training words are pieces too; the end of a text is a token in all. Texts are counted in blocks of
    about `block_bytes` (one text is never cut); a block's distinct words meet their counts
    and marginals in a join and come back to it, so no vocabulary is broadcast. Null text is empty: one token. A null
    `training` counts as held out. Repeated rows each give a row; an empty table gives none; no training rows: every
    word is unknown.
    """
    import pyarrow as pa

    blocks = stored(packed(docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("training")), block_bytes))
    of_blocks, texts = blocks.where("words is not null"), blocks.where("words is null").select(*(F.col(k).alias(k) for k in ("block", "doc_id", "held_out", "n_tokens", "n", "ids", "counts")))
    words = stored(of_blocks.select(F.explode(F.arrays_zip("words", "c")).alias("x")).select(F.col("x.words").alias("word"), F.col("x.c").alias("c")).groupBy("word").agg(F.sum("c").alias("c")))
    ends = texts.where("not held_out").count()
    n, v = words.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    n, v = (n or 0) + ends, v + (ends > 0)
    p = fit(words, ends, path, rounds)
    pieces, end = p[:-1], float(p[-1])

    def marginal(batches):
        vocab = vocabulary(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(vocab.words(batch.column(0).to_pylist(), pieces)[0])], names=["word", "c", "m"])

    scored = stored(words.mapInArrow(marginal, "word binary, c bigint, m double"))
    discard(words)
    weight = lattice_weight(scored, n, v)

    def judge(stats: pa.Table, table: pa.Table) -> pa.Table:
        c, m = np.zeros(stats.num_rows, np.int64), np.zeros(stats.num_rows)
        place = stats.column("place").to_numpy()
        c[place], m[place] = stats.column("c").to_numpy(), stats.column("m").to_numpy()
        known = c > 0
        base, both, m10 = np.log10((c + 1) / (n + v + 1)), np.logaddexp(np.log(c, where=known, out=np.full(len(c), -np.inf)), math.log(weight) + m) / math.log(10) - math.log10(n + weight), m / math.log(10)
        last = (math.log10((ends + 1) / (n + v + 1)), math.log10((ends + weight * math.exp(end)) / (n + weight)), end / math.log(10))
        out = []
        for k, ids, counts in zip(*(table.column(x).to_pylist() for x in ("n", "ids", "counts")), strict=True):
            at, times = unpacked(ids, k).astype(np.int64), unpacked(counts, k).astype(np.int64)
            out.append((int(times[known[at]].sum()) + (ends > 0), *(float((x[at] * times).sum()) + y for x, y in zip((base, both, m10), last, strict=True))))
        cols = list(zip(*out, strict=True)) or [[]] * 4
        n_tokens = pa.array(table.column("n_tokens").to_numpy() + 1)
        return pa.table({"doc_id": table.column("doc_id"), "held_out": table.column("held_out"), "n_tokens": n_tokens, "n_known": pa.array(cols[0], pa.int64()), "train_tokens": pa.array([n] * len(out), pa.int64()), **{x: pa.array(cols[1 + i], pa.float64()) for i, x in enumerate(("base_score", "score", "lattice_score"))}})

    stats = of_blocks.select("block", F.posexplode("words").alias("place", "word")).join(scored, "word").select(F.col("block").alias("block"), "place", "c", "m")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stats.groupBy("block").cogroup(texts.groupBy("block")).applyInArrow(judge, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, lattice_score double")
