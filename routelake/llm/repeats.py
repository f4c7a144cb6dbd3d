"""Suffix-array dedup: repeated byte strings found by longest-previous-factor arrays in suffix order.

Strings are met at anchors: the lowest-hashed gram of each window, which equal strings hold at the same place. Windows
are those of `words` words and, where none lies inside, those of `size` bytes. The occurrences of a gram are gathered
with what stands around them; where contexts differ, the suffixes that begin at each place before the gram are ordered:
the order one byte further left follows from the last by a stable sort on that byte, and neighbours' common prefixes
from range minima. In that order, the previous and the next smaller position of a suffix give its longest previous
factor: an earlier copy, if it is `size` bytes long or more.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

SIZE, GRAM = 400, 32
#: A passage has this many words at least: over 50.
WORDS = 51
#: Contexts that are ordered at a time, and the most that one gram's may be (about 2 kB of memory each). A gram with more
#: is split: each string that holds it becomes a row, and equal ones are counted by a 128-bit hash, combined before the shuffle.
BATCH, HOT = 20_000, 60_000
#: Bytes of a text whose anchors are looked for at a time.
PIECE = 1 << 20
MARKS = ["any_least", "any_most", "early_least", "early_most", "pass_start", "pass_stop"]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_windows(dark: np.ndarray, words: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of all strings of `words` words that begin and end with a word and have `size` bytes at most; dark: bytes above 20."""
    edge = np.diff(np.r_[False, dark, False].astype(np.int8))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    start, stop = start[: max(0, len(start) - words + 1)], stop[words - 1 :]
    able = (stop - start <= size) & (stop - start >= GRAM)
    return start[able], stop[able]


def anchors(data: bytes, size: int = SIZE, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places, hashes, before, after) of a text's anchors; before and after: how far strings of `words` words that hold the gram reach from its place, -1 for none."""
    if len(data) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    start, stop = word_windows(raw > 32, words, size)
    found, hashes = [], []
    for low in range(0, len(data), PIECE):
        # windows that begin in this piece
        part = data[low : low + PIECE + size]
        if len(part) < GRAM:
            continue
        a, b = np.searchsorted(start, [low, low + PIECE])
        at, h = piece(part, start[a:b] - low, stop[a:b] - low, min(PIECE, len(data) - low), size)
        found.append(at + low)
        hashes.append(h)
    place, first = np.unique(np.concatenate(found), return_index=True)
    # the first window that ends behind the gram, the last that begins before it
    a, b = np.searchsorted(stop, place + GRAM), np.searchsorted(start, place, "right") - 1
    some = a <= b
    inside = lambda x, k: x[np.where(some, k, 0)] if len(x) else place
    return place, np.concatenate(hashes)[first], np.where(some, place - inside(start, a), -1), np.where(some, inside(stop, b) - place, -1)


def piece(data: bytes, start: np.ndarray, stop: np.ndarray, most: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the windows start..stop, and of those of `size` bytes, beginning before `most`, that hold none of the others with a space on both sides."""
    grams, width = len(data) - GRAM + 1, size - GRAM + 1
    word = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = np.zeros(grams, np.uint64)
    for k in range(0, GRAM, 8):
        h = mixed(h + word[k : k + grams] + np.uint64(k + 1))
    # least[k]: of 2^k grams from each place; ties go to the leftmost
    least = [(h >> np.uint64(32) << np.uint64(32)) | np.arange(grams, dtype=np.uint64)]
    while 2 << (len(least) - 1) <= min(width, grams):
        half = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-half], least[-1][half:]))
    count = stop - start - GRAM + 1
    lowest, level = np.empty(len(count), np.uint64), np.frexp(count.astype(np.float64))[1] - 1
    for k in range(level.min(initial=0), level.max(initial=-1) + 1):
        some = level == k
        s = start[some]
        lowest[some] = np.minimum(least[k][s], least[k][s + count[some] - (1 << k)])
    made = [lowest]
    whole = min(most, len(data) - size + 1)
    if whole > 0:
        # the first of the other windows that begins behind each place
        begins = np.zeros(len(data) + 1, np.int32)
        begins[start] = 1
        ends = np.r_[stop, len(data) + size][np.cumsum(begins[:whole])]
        own = np.flatnonzero(ends >= np.arange(size, whole + size))
        k = width.bit_length() - 1
        made.append(np.minimum(least[k][own], least[k][own + width - (1 << k)]))
    # neighbouring windows mostly have the same
    at = np.unique(np.concatenate([(x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x) & np.uint64(2**32 - 1) for x in made]).astype(np.int64))
    return at, h[at]


def previous_factors(lcp: np.ndarray, place: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(length, source) of suffixes in order: the longest string that also starts at a smaller place, and which suffix does; 0 and -1 for less than `least`.

    lcp[k] is the common prefix of k - 1 and k. The previous and the next smaller place are reached by jumps over
    places that are known to be greater, with the least common prefix on the way.
    """
    n = len(place)
    length, source = np.zeros(n, np.int64), np.full(n, -1)
    for step in (-1, 1):
        at = np.arange(n) + step
        reach = lcp.copy() if step < 0 else np.r_[lcp[1:], -1]
        live = np.flatnonzero(reach >= least)
        open_ = live[place[at[live]] > place[live]]
        while len(open_):
            over = at[open_]
            reach[open_], at[open_] = np.minimum(reach[open_], reach[over]), at[over]
            open_ = open_[reach[open_] >= least]
            open_ = open_[place[at[open_]] > place[open_]]
        better = (reach >= least) & (reach > length)
        length[better], source[better] = reach[better], at[better]
    return length, source


def bounds(left: list[bytes], right: list[bytes], size: int, words: int) -> np.ndarray:
    """[context, o]: bytes of the string of `words` words that begins o before the gram and holds it; 0 where a word doesn't begin or the string is longer than `size`."""
    most, m = size - GRAM, len(left)
    out = np.zeros((m, most + 1), np.uint16)
    rows = np.frombuffer(b"".join(a.rjust(most + 1, b"\0") + b.ljust(size + 1, b"\0") for a, b in zip(left, right, strict=True)), np.uint8).reshape(m, -1)
    edge = np.diff(np.pad(rows > 32, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1]
    if len(row) < words:
        return out
    last = row[words - 1 :]
    row, start, stop = row[: len(last)], start[: len(last)], stop[words - 1 :]
    able = (row == last) & (stop - start <= size) & (start > 0) & (start <= most + 1) & (stop >= most + 1 + GRAM)
    out[row[able], most + 1 - start[able]] = (stop - start)[able]
    return out


def ordered(group: np.ndarray, left: list[bytes], right: list[bytes], doc: np.ndarray, many: np.ndarray, size: int = SIZE, words: int = WORDS) -> np.ndarray:
    """A row of MARKS for each context; contexts stand in position order within their groups, -1 stands for none.

    any, early: (least, greatest) o such that the string of `size` bytes from o before the gram is in another context,
    or in an earlier one. pass: how far strings that another document holds reach before and behind the gram's place:
    those of `size` bytes, and those of `words` words. doc: a number for each document of a group; many: contexts that
    stand in several.
    """
    m, most = len(group), size - GRAM
    lsize, rsize = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    before = np.zeros((m, most + 1), np.uint8)
    for i, x in enumerate(left):
        before[i, : len(x)] = np.frombuffer(x, np.uint8)[::-1]
    need_all = bounds(left, right, size, words)
    order = np.array(sorted(range(m), key=lambda i: (group[i], right[i])), np.int64)
    after = np.frombuffer(b"".join(x.ljust(size + 1, b"\0") for x in right), np.uint8).reshape(m, size + 1)
    a, b = order[:-1], order[1:]
    differ = after[a] != after[b]
    common = np.where(differ.any(1), differ.argmax(1), size + 1)
    # common[k]: of the suffixes at k - 1 and k; -1 between groups
    lcp = np.r_[-1, np.where(group[a] == group[b], np.minimum(common, np.minimum(rsize[a], rsize[b])), -1)]
    out = np.full((m, 6), -1)

    def across(run: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each member of runs of equal strings has one in another document."""
        first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        own = doc[at]
        other = (np.minimum.reduceat(own, first) != np.maximum.reduceat(own, first)) | ((np.diff(np.r_[first, len(run)]) > 1) & np.logical_or.reduceat(many[at], first))
        return np.repeat(other, np.diff(np.r_[first, len(run)]))

    for o in range(most + 1):
        if o:
            # a byte further left; contexts without one leave
            has = lsize[order] >= o
            kept = np.flatnonzero(has)
            if len(kept) < 2:
                break
            if len(kept) < len(order):
                lcp = np.r_[-1, _range_min(lcp, kept[:-1] + 1, kept[1:] + 1)]
                order = order[kept]
            key = group[order].astype(np.int64) * 256 + before[order, o - 1]
            step = np.argsort(key, kind="stable")
            same = np.r_[False, key[step[1:]] == key[step[:-1]]]
            if (np.diff(step) == 1).all():
                lcp = np.where(same, lcp + 1, np.where(np.r_[False, group[order[1:]] == group[order[:-1]]], 0, -1))
            else:
                fresh = np.zeros(len(step), lcp.dtype)
                k = np.flatnonzero(same)
                fresh[k] = _range_min(lcp, step[k - 1] + 1, step[k] + 1) + 1
                new = order[step]
                fresh[~same] = np.where(np.r_[False, group[new[1:]] == group[new[:-1]]], 0, -1)[~same]
                lcp, order = fresh, new
        if o % 8 == 7:
            # what shares less with its neighbours than reaches over the gram never shares more from further left
            reach = np.maximum(lcp, np.r_[lcp[1:], -1]) >= o + GRAM
            if not reach.all():
                kept = np.flatnonzero(reach)
                if len(kept) < 2:
                    break
                lcp, order = np.r_[-1, _range_min(lcp, kept[:-1] + 1, kept[1:] + 1)], order[kept]
        joined = lcp >= size
        if joined.any():
            # only suffixes in runs of long common prefixes have a factor of `size`
            some = np.flatnonzero(joined | np.r_[joined[1:], False])
            length, source = previous_factors(np.where(joined[some], lcp[some], -1), order[some], size)
            late = length >= size
            hit = late.copy()
            hit[source[late]] = True  # what a later one repeats
            at = order[some]
            for k, x in ((0, at[hit]), (2, at[late])):
                out[x, k] = np.where(out[x, k] < 0, o, out[x, k])
                out[x, k + 1] = o
            x = at[across(np.cumsum(~joined[some]), at)]
            out[x, 4], out[x, 5] = o, np.maximum(out[x, 5], size - o)
        begins = np.flatnonzero(need_all[order, o])
        if len(begins) > 1:
            need = need_all[order[begins], o].astype(np.int64)
            own = np.r_[-1, _range_min(lcp, begins[:-1] + 1, begins[1:] + 1)]
            tied = np.r_[False, (need[1:] == need[:-1]) & (own[1:] >= need[1:])]
            if tied.any():
                other = across(np.cumsum(~tied), order[begins])
                x = order[begins][other]
                out[x, 4], out[x, 5] = np.maximum(out[x, 4], o), np.maximum(out[x, 5], need[other] - o)
    return out


def _range_min(x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Least of x[start:stop] for each pair, none of them empty."""
    padded = np.r_[x, np.iinfo(x.dtype).max]
    return np.minimum.reduceat(padded, np.column_stack([start, stop]).ravel())[::2]


def find(docs: DataFrame, text: str, size: int, words: int) -> DataFrame:
    """(doc_id, tkey, h, ctx, places, lsize, rsize, before, after) of a text's anchors; tkey: a hash of the text. Places of one text with one context make one row."""
    import pyarrow as pa

    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows: list[int] = []
                seen: dict[tuple[int, int], list[int]] = {}
                cols: list[tuple] = []
                for i, t in enumerate(part.column(2).to_pylist()):
                    data = (t or "").encode()
                    for p, h, b, a in zip(*(x.tolist() for x in anchors(data, size, words)), strict=True):
                        low, high = max(0, p - size + GRAM - 1), min(len(data), p + size + 1)
                        ctx = xxhash.xxh3_64_intdigest(data[low:high], seed=p - low)
                        if (at := seen.get((h, ctx))) is not None:
                            at.append(p)
                        else:
                            seen[h, ctx] = at = [p]
                            rows.append(i)
                            cols.append((h, ctx, at, p - low, high - p, b, a))
                    seen.clear()
                if rows:
                    taken = part.select([0, 1]).take(pa.array(rows))
                    h, ctx, at, lsize, rsize, b, a = zip(*cols, strict=True)
                    signed = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                    yield pa.RecordBatch.from_arrays([*taken.columns, signed(h), signed(ctx), pa.array(at, pa.list_(pa.int64())), *(pa.array(x, pa.int16()) for x in (lsize, rsize, b, a))], names=["doc_id", "tkey", "h", "ctx", "places", "lsize", "rsize", "before", "after"])

    rows = docs.select("doc_id", F.xxhash64(text).alias("tkey"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {doc_id}, tkey bigint, h bigint, ctx bigint, places array<bigint>, lsize smallint, rsize smallint, before smallint, after smallint")


def contexts(docs: DataFrame, text: str, reps: DataFrame, size: int) -> DataFrame:
    """(h, ctx, many, doc_id, tkey, pos, left, right) of the representatives, read from their texts."""
    import pyarrow as pa

    kind = docs.schema["doc_id"].dataType.simpleString()
    wanted = reps.groupBy(F.col("doc_id").alias("want"), F.col("tkey").alias("want_key")).agg(F.collect_list(F.struct("h", "ctx", "pos", "many")).alias("places"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("tkey"), F.col(text).alias("text"))
    joined = rows.join(wanted, rows.doc_id.eqNullSafe(F.col("want")) & (rows.tkey == F.col("want_key"))).select("doc_id", "tkey", "text", "places")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                data, places = batch.column(2)[i].as_py().encode(), batch.column(3)[i].as_py()
                for k in range(0, len(places), 20_000):
                    some = places[k : k + 20_000]
                    at = [p["pos"] for p in some]
                    yield pa.RecordBatch.from_arrays([*(pa.array([p[c] for p in some], t) for c, t in (("h", pa.int64()), ("ctx", pa.int64()), ("many", pa.bool_()))), *(pa.array([batch.column(c)[i].as_py()] * len(some), batch.schema.types[c]) for c in (0, 1)), pa.array(at, pa.int64()), pa.array([data[max(0, p - size + GRAM - 1) : p] for p in at], pa.binary()), pa.array([data[p : p + size + 1] for p in at], pa.binary())], names=["h", "ctx", "many", "doc_id", "tkey", "pos", "left", "right"])

    return joined.mapInArrow(run, f"h bigint, ctx bigint, many boolean, doc_id {kind}, tkey bigint, pos bigint, left binary, right binary")


def in_order(found: DataFrame, size: int, words: int) -> DataFrame:
    """(h, ctx, MARKS) of contexts, by suffix order; a gram's contexts stay together."""
    import pyarrow as pa

    names = ["h", "ctx", *MARKS]

    def out(rows: list[tuple]):
        news = lambda k: [i == 0 or rows[i][:k] != rows[i - 1][:k] for i in range(len(rows))]
        group, doc = np.cumsum(news(1)), np.cumsum(news(3))
        made = ordered(group, [r[6] for r in rows], [r[7] for r in rows], doc, np.array([r[5] for r in rows]), size, words)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()), *(pa.array(made[:, k].astype(np.int64)) for k in range(len(MARKS)))], names=names)

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= BATCH and held[-1][0] != row[0]:
                    yield out(held)
                    held = []
                if not held or held[-1][:5] != row[:5]:  # rows that repeat an id and text
                    held.append(row)
        if held:
            yield out(held)

    rows = found.repartition("h").sortWithinPartitions("h", F.col("doc_id").asc_nulls_first(), "tkey", "pos", "ctx").select("h", "doc_id", "tkey", "pos", "ctx", "many", "left", "right")
    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in names))


def by_windows(found: DataFrame, size: int, words: int) -> DataFrame:
    """The same for grams with very many contexts: each string of `size` bytes, or of `words` words, that holds the gram is a row, and equal ones are counted by a 128-bit hash."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = batch.column(6)[i].as_py(), batch.column(7)[i].as_py()
                data, own = left + right, bounds([left], [right], size, words)[0]
                wanted = [(o, size) for o in range(min(len(left), size - GRAM) + 1) if len(right) >= size - o] + [(int(o), int(own[o])) for o in np.flatnonzero(own)]
                n = len(wanted)
                yield pa.RecordBatch.from_arrays([*(pa.array([batch.column(k)[i].as_py()] * n, batch.schema.types[k]) for k in range(6)), pa.array([o for o, _ in wanted], pa.int32()), pa.array([e for _, e in wanted], pa.int32()), pa.array([k < n - int((own > 0).sum()) for k in range(n)]), pa.array([xxhash.xxh3_128_digest(data[len(left) - o : len(left) - o + e]) for o, e in wanted], pa.binary())], names=["h", "ctx", "many", "doc_id", "tkey", "pos", "o", "bytes", "fixed", "window"])

    kind = found.schema["doc_id"].dataType.simpleString()
    windows = found.dropDuplicates(["h", "ctx"]).select("h", "ctx", "many", "doc_id", "tkey", "pos", "left", "right").mapInArrow(run, f"h bigint, ctx bigint, many boolean, doc_id {kind}, tkey bigint, pos bigint, o int, bytes int, fixed boolean, window binary")
    key, place = ["h", "o", "fixed", "window"], F.struct("doc_id", "tkey", "pos", "ctx")
    of_doc = F.struct("doc_id", "tkey")
    counts = windows.groupBy(*(F.col(k).alias(f"{k}_") for k in key)).agg(F.count("*").alias("n"), F.min(place).alias("first"), (F.bool_or("many") | (F.min(of_doc) != F.max(of_doc))).alias("across")).where("n > 1")
    on = F.lit(True)
    for k in key:
        on = on & (F.col(k) == F.col(f"{k}_"))
    hits = windows.join(counts, on)
    cut, late = F.when(F.col("fixed"), F.col("o")), F.when(F.col("fixed") & ~place.eqNullSafe(F.col("first")), F.col("o"))
    reach = lambda c: F.when(F.col("across"), c)
    return hits.groupBy("h", "ctx").agg(*(F.coalesce(f(c), F.lit(-1)).cast("long").alias(k) for k, f, c in zip(MARKS, (F.min, F.max, F.min, F.max, F.max, F.max), (cut, cut, late, late, reach(F.col("o")), reach(F.col("bytes") - F.col("o"))), strict=True)))


def repeats(docs: DataFrame, size: int = SIZE, keep_first: bool = False, text: str = "text", hot: int = HOT, words: int = WORDS) -> DataFrame:
    """doc_id, n_bytes, kept (binary: what is left of the text), spans (array<struct<start, stop>>: removed runs of bytes), passages (the same).

    Removed: each byte of a string of `size` bytes of UTF-8 that also starts anywhere else, in the same text or
    another; with `keep_first`, only of one that starts earlier, by doc_id (null first) and place. Strings are judged
    on the input. passages: runs of bytes, of `words` words or more, that strings cover which another row holds too:
    strings of `size` bytes, and shorter ones of `words` whole words (runs of bytes above 20). They are only told.
    Null text is empty; texts under `size` bytes keep all; rows that repeat a doc_id and text are copies
    of each other (with `keep_first`, their first strings stay in each); an empty table gives none. A gram's contexts
    are counted before they are read, so copies cost one context; `hot`: see by_windows.
    """
    import pyarrow as pa

    all_ = stored(find(docs, text, size, words))
    total = all_.groupBy(F.col("h").alias("g")).agg(F.sum(F.size("places")).alias("total")).where("total > 1").select("g")
    some = stored(all_.join(total, F.col("h") == F.col("g"), "left_semi"))
    discard(all_)
    # what a context says of itself
    facts = [F.first(c).alias(c) for c in ("lsize", "rsize", "before", "after")]
    groups = stored(some.groupBy("h", "ctx").agg(F.sum(F.size("places")).alias("n"), (F.count("*") > 1).alias("many"), F.min(F.struct("doc_id", "tkey", F.col("places")[0].alias("pos"))).alias("rep"), *facts))
    several = groups.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("m")).where("m > 1")
    reps = stored(groups.join(several, F.col("h") == F.col("g")).select("h", "ctx", "rep.*", "many", "m"))
    found = lambda where: contexts(docs, text, reps.where(where), size)
    made = in_order(found(F.col("m") <= hot), size, words)
    if reps.where(F.col("m") > hot).limit(1).count():
        made = made.unionByName(by_windows(found(F.col("m") > hot), size, words))
    made = stored(made)
    discard(reps)
    marks = groups.join(made.withColumnsRenamed({"h": "g", "ctx": "c"}), (F.col("h") == F.col("g")) & (F.col("ctx") == F.col("c")), "left")
    # a context that occurs twice is repeated as a whole; smallints would overflow in sums with places
    lsize, rsize = F.least(F.col("lsize").cast("long"), F.lit(size - GRAM)), F.col("rsize").cast("long")
    whole_least, whole_most = F.greatest(F.lit(0), F.lit(size) - rsize), lsize
    fits = whole_least <= whole_most
    twice = (F.col("n") > 1) & fits
    part = lambda k, w, on: F.when(on, w).otherwise(F.coalesce(F.col(k), F.lit(-1))).cast("long")
    if keep_first:
        ends = [*(part(f"early_{k}", w, F.lit(False)).alias(f"r_{k}") for k, w in (("least", whole_least), ("most", whole_most))), *(F.when(twice, w).otherwise(-1).cast("long").alias(k) for k, w in (("least", whole_least), ("most", whole_most)))]
    else:
        ends = [part(f"any_{k}", w, twice).alias(k) for k, w in (("least", whole_least), ("most", whole_most))]
    in_many = lambda k, own, cut: F.greatest(F.coalesce(F.col(k), F.lit(-1)), F.when(F.col("many"), F.greatest(F.col(own).cast("long"), F.when(fits, cut).otherwise(-1))).otherwise(-1)).cast("long")
    ends += [in_many("pass_start", "before", whole_most).alias("ahead"), in_many("pass_stop", "after", F.lit(size) - whole_least).alias("behind")]
    marks = marks.select("h", "ctx", "rep", *ends).where("least >= 0 or ahead >= 0" + (" or r_least >= 0" if keep_first else "")).withColumnsRenamed({"h": "g", "ctx": "c"})
    # written, so that a context of very many rows can be split where it meets them
    marks = stored(marks)
    for done in (groups, made):
        discard(done)
    hits = some.join(marks, (F.col("h") == F.col("g")) & (F.col("ctx") == F.col("c")))
    run_of = lambda p, a, b: F.struct((p - a).alias("start"), (p + b).alias("stop"))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    cuts = F.when(F.col("least") >= 0, F.transform("places", lambda p: run_of(p, F.col("most"), F.lit(size) - F.col("least")))).otherwise(none)
    if keep_first:
        # the first place of the representative is the first of all
        own = F.struct("doc_id", "tkey", F.col("places")[0].alias("pos")).eqNullSafe(F.col("rep"))
        later = F.when(F.col("least") >= 0, F.transform(F.slice("places", 2, F.greatest(F.size("places"), F.lit(1))), lambda p: run_of(p, F.col("most"), F.lit(size) - F.col("least")))).otherwise(none)
        lone = F.when(F.col("r_least") >= 0, F.array(run_of(F.col("places")[0], F.col("r_most"), F.lit(size) - F.col("r_least")))).otherwise(none)
        # contexts that stand once have only what an earlier context holds
        cuts = F.when(own, F.concat(lone, later)).otherwise(cuts)
    told = F.when(F.col("ahead") >= 0, F.transform("places", lambda p: run_of(p, F.col("ahead"), F.col("behind")))).otherwise(none)
    runs = hits.select("doc_id", "tkey", cuts.alias("cuts"), told.alias("told")).groupBy(F.col("doc_id").alias("of"), F.col("tkey").alias("of_key")).agg(F.flatten(F.collect_list("cuts")).alias("cuts"), F.flatten(F.collect_list("told")).alias("told"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("tkey"), F.col(text).alias("text"))
    joined = rows.join(runs, rows.doc_id.eqNullSafe(F.col("of")) & (rows.tkey == F.col("of_key")), "left").select("doc_id", "text", F.array_sort("cuts").alias("cuts"), F.array_sort("told").alias("told"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def merged(found: list[dict] | None) -> list[dict]:
        spans: list[dict] = []
        for r in found or ():
            if spans and r["start"] <= spans[-1]["stop"]:
                spans[-1]["stop"] = max(spans[-1]["stop"], r["stop"])
            else:
                spans.append(dict(r))
        return spans

    def cut_out(batches):
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                made: list[tuple] = []
                for t, found, told in zip(*(part.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                    data, rest, at = (t or "").encode(), [], 0
                    spans = merged(found)
                    for s in spans:
                        rest.append(data[at : s["start"]])
                        at = s["stop"]
                    passages = [s for s in merged(told) if np.count_nonzero(np.diff(np.r_[False, np.frombuffer(data[s["start"] : s["stop"]], np.uint8) > 32].astype(np.int8)) == 1) >= words]
                    made.append((len(data), b"".join([*rest, data[at:]]), spans, passages))
                cols = list(zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()), pa.array(cols[2], spans_type), pa.array(cols[3], spans_type)], names=["doc_id", "n_bytes", "kept", "spans", "passages"])

    spans = "array<struct<start:bigint,stop:bigint>>"
    return joined.mapInArrow(cut_out, f"doc_id {kind}, n_bytes bigint, kept binary, spans {spans}, passages {spans}")


def digests(made: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of what repeats returns, and n_passages."""
    return made.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.size("passages").cast("long").alias("n_passages"))
