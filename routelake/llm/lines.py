"""Line dedup: segment-partition edit join over distinct lines. DataFrame functions only.

A line of each length is split into threshold + 1 segments. Two lines within the threshold share one segment exactly,
near its place; so each line probes the segments of lines as long as it or shorter by up to the threshold. What meets
is verified by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small, stored

THRESHOLD, LEAST = 2, 30
#: Lines that share a segment; where there are more, they only meet if a part of their bits agrees too.
CROWD = 256


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0), line (without spaces around) of every line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn("line", F.btrim("line", F.lit(" \t\r\v\f")))


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(place from 1, size) of segment i of `parts`; the last length % parts are longer by one."""
    base, rest = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    long_before = F.greatest(F.lit(0), rest - (parts - i))
    return base * i + long_before + 1, base + F.when(F.lit(i) >= parts - rest, 1).otherwise(0)


def probe_keys(line: Column, threshold: int) -> list[tuple[bool, Column]]:
    """(own, hash) of the substrings that may equal a segment: edits before and after it bound how far it can have moved.

    own marks the line's own segments, which are also what the index holds of it.
    """
    n, out = F.length(line), []
    for shorter in range(threshold + 1):
        m = (n - shorter).cast("int")
        for i in range(threshold + 1):
            place, size = segment(m, i, threshold + 1)
            after = threshold - i
            out += [(shorter == shift == 0, F.xxhash64(F.lit(i), m, line.substr(place + shift, size))) for shift in range(max(-i, shorter - after), min(i, shorter + after) + 1)]
    return out


def place_of(doc_id: str = "doc_id", line_no: str = "line_no") -> Column:
    """One number that orders lines by doc_id, null first, then line_no; unlike a struct, hash aggregation takes it."""
    null = F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)")
    return (F.coalesce(F.col(doc_id).cast("decimal(20,0)"), null) * F.lit(1 << 31).cast("decimal(10,0)") + F.col(line_no)).cast("decimal(31,0)")


def pair_bits(line: Column) -> Column:
    """128 bits in two longs: the parity of how often the pairs of adjacent characters that hash to each bit occur. An edit flips 4 at most."""
    none = F.lit(0).cast("long")

    def step(acc, c):
        h = F.hash(acc["last"], c)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)))
        low = h.bitwiseAND(F.lit(64)) == 0
        return F.struct(c.alias("last"), acc["lo"].bitwiseXOR(F.when(low, bit).otherwise(none)).alias("lo"), acc["hi"].bitwiseXOR(F.when(low, none).otherwise(bit)).alias("hi"))

    return F.aggregate(letters(line), F.struct(F.lit("").alias("last"), none.alias("lo"), none.alias("hi")), step)


def bit_parts(lo: Column, hi: Column, parts: int) -> list[Column]:
    """At least `parts` parts of the 128 bits. Bits that differ in fewer than `parts` places agree in a part."""
    each = -(-parts // 2)
    width = -(-64 // each)
    return [F.shiftrightunsigned(w, i * width).bitwiseAND(F.lit((1 << width) - 1)) for w in (lo, hi) for i in range(each)]


def numbered_parts(lo: Column, hi: Column, parts: int) -> Column:
    """array<bigint> of the parts, each with its number in the lowest five bits."""
    return F.array(*(F.call_function("shiftleft", p, F.lit(5)).bitwiseOR(F.lit(i)) for i, p in enumerate(bit_parts(lo, hi, parts))))


def first_agreeing(lo: Column, hi: Column, parts: int) -> Column:
    """The number of the first part that agrees, of bits that differ where lo and hi are set."""
    found = None
    for i, p in reversed(list(enumerate(bit_parts(lo, hi, parts)))):
        found = F.when(p == 0, i) if found is None else F.when(p == 0, i).otherwise(found)
    return found


def common(a: str, b: str, last: bool, most: Column) -> Column:
    """Length, `most` at the most, of what a and b share at their beginning (or end): longer and longer steps would overrun, so from the largest down."""
    steps = F.array(*(F.lit(1 << k) for k in range(20, -1, -1)))
    start = lambda p, k: -(p + k) if last else p + 1
    return F.aggregate(steps, F.lit(0), lambda p, k: F.when((p + k <= most) & (F.col(a).substr(start(p, k), k) == F.col(b).substr(start(p, k), k)), p + k).otherwise(p))


def stripped(pairs: DataFrame, a: str, b: str, threshold: int) -> DataFrame:
    """a and b without what they share at both ends, but for threshold + 1 characters there: their distance stays."""
    out = pairs.withColumn("head", common(a, b, False, F.least(F.length(a), F.length(b))))
    out = out.withColumn("tail", common(a, b, True, F.least(F.length(a), F.length(b)) - F.col("head")))
    out = out.withColumns({"head": F.greatest(F.col("head") - threshold - 1, F.lit(0)), "tail": F.greatest(F.col("tail") - threshold - 1, F.lit(0))})
    return out.withColumns({x: F.col(x).substr(F.col("head") + 1, F.length(x) - F.col("head") - F.col("tail")) for x in (a, b)}).drop("head", "tail")


def letters(s: Column) -> Column:
    return F.split(s, "")


def agreeing(a: str, b: str, threshold: int) -> Column:
    """False only if more edits than the threshold part the lines: of `pieces` pieces of a, all but that many stand in b, moved by that many places at most."""
    pieces = 4 * (threshold + 1)
    n = F.length(a)
    found = F.lit(0)
    for i in range(pieces):
        place, size = segment(n, i, pieces)
        piece = F.col(a).substr(place, size)
        found = found + F.when(F.contains(F.col(b).substr(F.greatest(F.lit(1), place - threshold), size + 2 * threshold), piece), 1).otherwise(0)
    return found >= pieces - threshold


def distance(a: str, b: str, threshold: int) -> Column:
    """Edit distance of the lines a and b, longer than the threshold and at most that apart in length; exact up to the threshold."""
    # bound to a variable, or each step would split the lines again
    return F.transform(F.array(F.struct(letters(F.col(a)).alias("s"), letters(F.col(b)).alias("t"))), lambda p: banded(p["s"], p["t"], threshold))[0]


def banded(a: Column, b: Column, threshold: int) -> Column:
    """The same of arrays of characters.

    A word of 2 * threshold + 2 bits holds the band of a column of the matrix; its highest bit is row j + threshold.
    The value is followed along the band's lower edge, then along the last row.
    """
    t, width = threshold, 2 * threshold + 2
    ones, m = (1 << width) - 1, F.size(a)

    def step(acc, j):
        c = F.get(b, j - 1)
        same = F.lit(0).cast("long")
        for k in range(2 * t + 1):
            row = j - t + k
            same = same + F.when((row >= 1) & (F.get(a, row - 1) == c), F.lit(1 << (k + 1)).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.struct(same.alias("x"), acc["vp"].alias("vp"), acc["vn"].alias("vn"), acc["d"].alias("d"), j.alias("j"))

    def carried(acc, j):
        s = F.array(step(acc, j))

        def first(x):
            d0 = ((x["x"].bitwiseAND(x["vp"]) + x["vp"]).bitwiseXOR(x["vp"])).bitwiseOR(x["x"]).bitwiseOR(x["vn"]).bitwiseAND(F.lit(ones))
            return F.struct(d0.alias("d0"), x["vp"].alias("vp"), x["vn"].alias("vn"), x["d"].alias("d"), x["j"].alias("j"))

        def second(x):
            hp = x["vn"].bitwiseOR(F.lit(ones).bitwiseXOR(x["d0"].bitwiseOR(x["vp"])))
            hn = x["d0"].bitwiseAND(x["vp"])
            down = F.shiftright(x["d0"], 1)
            vp = hn.bitwiseOR(F.lit(ones).bitwiseXOR(down.bitwiseOR(hp)))
            vn = down.bitwiseAND(hp)
            over = x["j"] + t - m  # columns past the point where the band's edge meets the last row
            bit = lambda v, k: F.when(F.call_function("shiftright", v, k).bitwiseAND(F.lit(1)) == 1, 1).otherwise(0)
            edge = F.when(x["d0"].bitwiseAND(F.lit(1 << (width - 1))) == 0, 1).otherwise(0)
            last = bit(hp, F.lit(width - 1) - over) - bit(hn, F.lit(width - 1) - over)
            return F.struct(vp.cast("long").alias("vp"), vn.cast("long").alias("vn"), (x["d"] + F.when(over <= 0, edge).otherwise(last)).cast("int").alias("d"))

        return F.transform(F.transform(s, first), second)[0]

    start = F.struct(F.lit(ones & ~((1 << (t + 1)) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"), F.lit(t).cast("int").alias("d"))
    return F.aggregate(F.sequence(F.lit(1), F.size(b)), start, carried)["d"]


def near_lines(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST, short: bool = False) -> tuple[DataFrame, DataFrame]:
    """(distinct lines: key, at (place_of the first), n; links: a, b, distance between different lines).

    A segment that one line alone has in the index gives pairs at once. What probes a segment of several lines is kept
    as (segment, line), a row for each probe; their pairs are then made where pair_bits() differ in no more bits than
    the threshold allows, so that a segment which many lines share doesn't give all its pairs; of more than CROWD lines
    only those are compared that agree in one of more parts of these bits than the threshold can change. With `short`, lines under
    `least` characters are among the distinct ones, without probes and links.
    """
    # a second hash keeps apart lines that agree in the first; its lowest bit says if the line is long enough for links
    key2 = F.hash("line").bitwiseAND(F.lit(-2)).bitwiseOR((F.length("line") >= least).cast("int"))
    rows = lines(docs).where(F.length("line") >= (1 if short else least)).select(F.xxhash64("line").alias("key"), key2.alias("key2"), place_of().alias("at"), "line")
    made = probe_keys(F.col("line"), threshold)
    names = [f"k{i}" for i in range(len(made))]
    # 0 for short lines, by a product: conditions would keep Spark from sharing what the keys have in common
    long_enough = F.col("key2").bitwiseAND(F.lit(1)).cast("long")
    keyed = rows.select("key", "key2", "at", *((h * long_enough).alias(k) for k, (_, h) in zip(names, made, strict=True)))
    # numbers only, so that equal lines are added up by hash before the shuffle
    distinct = stored(keyed.groupBy("key", "key2").agg(F.min("at").alias("at"), F.count("*").alias("n"), *(F.max(k).alias(k) for k in names)))
    own = [k for k, (x, _) in zip(names, made, strict=True) if x]
    probing = distinct.where(F.col("key2").bitwiseAND(F.lit(1)) == 1)
    index = probing.select(F.col("key").alias("a"), F.explode(F.array(*own)).alias("value")).groupBy("value").agg(F.min("a").alias("a"), F.count("*").alias("held"))
    probes = probing.select(F.col("key").alias("b"), F.explode(F.array(*(F.struct(F.col(k).alias("value"), F.lit(x).alias("own")) for k, (x, _) in zip(names, made, strict=True)))).alias("p")).select("b", "p.*")
    # the index has one row a segment, so the map of a partition is no larger than its share of them; probes needn't be sorted
    met = cut(probes.join(index.hint("shuffle_hash"), "value").where("held > 1 or a <> b"))
    shared = met.where("held > 1").select("value", "b", "own", "held")
    alone = met.where("held = 1").select("a", "b")
    wanted = cut(met.select(F.col("b").alias("k"), F.col("held") > 1).union(alone.select("a", F.lit(False))).toDF("k", "shared").groupBy("k").agg(F.max("shared").alias("shared")).join(distinct.select(F.col("key").alias("k"), "at"), "k"))
    some = small(wanted)
    bits = F.when(F.col("shared"), pair_bits(F.col("line")))
    text = cut(rows.join(some, (rows.key == some.k) & (rows.at == some["at"])).select("key", "line", "shared").dropDuplicates(["key", "line"]).withColumn("bits", bits).select("key", "line", "bits.lo", "bits.hi"))
    crowded = F.when(F.col("held") > CROWD, numbered_parts(F.col("lo"), F.col("hi"), 4 * threshold + 1)).otherwise(F.array(F.lit(-1).cast("long")))
    marked = shared.join(text.select(F.col("key").alias("b"), "lo", "hi"), "b").withColumn("part", F.explode(crowded)).drop("held")
    members = marked.where("own").select("value", "part", F.col("b").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
    lo, hi = F.col("lo").bitwiseXOR(F.col("lo_a")), F.col("hi").bitwiseXOR(F.col("hi_a"))
    flips = F.bit_count(lo) + F.bit_count(hi)
    # a pair is made in the first part that agrees, not in each
    once = (F.col("part") < 0) | (F.col("part").bitwiseAND(F.lit(31)) == first_agreeing(lo, hi, 4 * threshold + 1))
    like = members.join(marked.drop("own"), ["value", "part"]).where((F.col("a") != F.col("b")) & (flips <= 4 * threshold) & once).select("a", "b")
    pairs = cut(alone.union(like).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = pairs.join(text.select(F.col("key").alias("a"), F.col("line").alias("s")), "a").join(text.select(F.col("key").alias("b"), F.col("line").alias("t")), "b")
    both = stripped(both.where((F.abs(F.length("s") - F.length("t")) <= threshold) & agreeing("s", "t", threshold)), "s", "t", threshold)
    # generated, not filtered: a filter would be moved below and work out the distance a second time
    near = F.filter(F.array(distance("s", "t", threshold)), lambda d: d <= threshold)
    return distinct.select("key", "at", "n"), stored(both.select("a", "b", F.explode(near).alias("distance")))


def removed_lines(docs: DataFrame, threshold: int = THRESHOLD, least: int = LEAST, short: bool = False) -> DataFrame:
    """doc_id, line_no of every line to remove: of `least` characters or more, and equal to or within `threshold` edits of one that comes first.

    With `short`, also of every shorter line, but for blank ones, that is equal to one that comes first. Lines come by
    doc_id, then line_no, null ids first; each is judged on the input, whatever goes elsewhere.
    """
    distinct, links = near_lines(docs, threshold, least, short)
    at = distinct.select("key", "at")
    ends = links.join(at.select(F.col("key").alias("a"), F.col("at").alias("at_a")), "a").join(at.select(F.col("key").alias("b"), F.col("at").alias("at_b")), "b")
    later = ends.select(F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("key")).distinct().withColumn("later", F.lit(True))
    # only lines that occur again, or come later than one like them, have something to remove
    # written, so that a line of very many rows can be split where it meets its row here
    acts = stored(distinct.join(later, "key", "left").where("n > 1 or later").select("key", F.when(F.col("later"), None).otherwise(F.col("at")).alias("kept_at")))
    found = lines(docs).where(F.length("line") >= (1 if short else least)).select(F.xxhash64("line").alias("key"), "doc_id", "line_no")
    return found.join(acts, "key").where(F.col("kept_at").isNull() | (place_of() != F.col("kept_at"))).select("doc_id", "line_no")


def dedup(docs: DataFrame, keep: list[str], threshold: int = THRESHOLD, least: int = LEAST, short: bool = False) -> DataFrame:
    """Columns `keep`, text without the removed lines, n_lines, n_removed of every row.

    Lines are split at line feeds and compared without white space around. Null text stays null, without lines; blank
    lines stay, and unless `short` is set all lines under `least` characters. Rows that repeat a doc_id count as one
    document: what goes from one goes from all, by line number. doc_id is a whole number. An empty table gives none.
    """
    gone = removed_lines(docs, threshold, least, short).distinct().groupBy("doc_id").agg(F.collect_list("line_no").alias("gone"))
    rows = docs.select(*dict.fromkeys([*keep, "text"]))
    joined = rows.join(gone.withColumnRenamed("doc_id", "gone_id"), F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
    split = F.split("text", "\n", -1)
    # array_except works by hash; the parts are bound to a variable, or each line would split the text again
    left = lambda p: F.transform(F.array_except(F.sequence(F.lit(0), F.size(p["lines"]) - 1), p["gone"]), lambda i: F.get(p["lines"], i))
    rest = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.transform(F.array(F.struct(split.alias("lines"), "gone")), lambda p: F.array_join(left(p), "\n"))[0])
    return joined.select(*(k for k in keep if k != "text"), rest.alias("text"), F.coalesce(F.size(split), F.lit(0)).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))
