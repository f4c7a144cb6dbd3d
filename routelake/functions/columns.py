"""Column functions: networks, AS paths, event ids. Catalyst expressions, no Python per row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def origin_asn(as_path: Column | str) -> Column:
    """Last AS of a path; null for none, and for a set at the end, whose origin is ambiguous."""
    last = F.element_at(F.split(F.trim(F.regexp_replace(_c(as_path), r"\s+", " ")), " "), -1)
    return F.regexp_extract(last, r"^([+-]?[0-9]+)", 1).try_cast("bigint")


def event_id(message: Column | str, is_loc_rib: Column | str, peer: Column | str, prefix: Column | str, action: Column | str) -> Column:
    """SHA-256 of the message's bytes, then peer/prefix/action, or prefix/action in a Loc-RIB."""
    tail = F.when(_c(is_loc_rib), F.concat_ws("/", _c(prefix), _c(action))).otherwise(F.concat_ws("/", F.coalesce(_c(peer), F.lit("")), _c(prefix), _c(action)))
    return F.unhex(F.sha2(F.concat(_c(message), tail.cast("binary")), 256))


def masklen(prefix: Column | str) -> Column:
    return F.substring_index(_c(prefix), "/", -1).try_cast("int")


def family(prefix: Column | str) -> Column:
    return F.when(F.contains(_c(prefix), F.lit(":")), 6).otherwise(4)


def ipv4_number(address: Column | str) -> Column:
    """An IPv4 address, or a prefix's, as a number; null if it is none."""
    def read(parts: Column) -> Column:
        # a part that is none makes the sum null
        number = lambda acc, p: acc * 256 + F.when(p.rlike("^[0-9]{1,3}$") & (F.length(p) <= 3), F.when(p.try_cast("int") <= 255, p.try_cast("int")))
        return F.when(F.size(parts) == 4, F.aggregate(parts, F.lit(0).cast("bigint"), number))

    return bound(F.split(F.substring_index(_c(address), "/", 1), r"\."), read)


def ipv4_text(number: Column | str) -> Column:
    n = _c(number)
    return F.concat_ws(".", *(F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)))


def ipv6_groups(address: Column | str) -> Column:
    """An IPv6 address's eight groups as numbers, :: filled; a dotted quad at the end counts as two."""
    text = F.lower(F.substring_index(_c(address), "/", 1))
    tail = F.regexp_extract(text, r"([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$", 1)
    quad = ipv4_number(tail)
    hexed = F.concat(F.hex(F.shiftright(quad, 16)), F.lit(":"), F.hex(quad.bitwiseAND(F.lit(65535))))
    text = F.when(tail != "", F.concat(F.substring(text, F.lit(1), F.length(text) - F.length(tail)), hexed)).otherwise(text)
    side = lambda t: F.filter(F.split(t, ":"), lambda x: x != "")
    left, right = side(F.substring_index(text, "::", 1)), F.when(F.contains(text, F.lit("::")), side(F.substring_index(text, "::", -1))).otherwise(F.array().cast("array<string>"))
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right))), right)
    return F.transform(filled, lambda g: F.conv(g, 16, 10).cast("bigint"))


def halves(address: Column | str) -> Column:
    """struct<hi, lo>: an address's 128 bits as two numbers; IPv4 stands in lo's low half."""
    part = lambda g, k: F.aggregate(F.slice(g, k + 1, 4), F.lit(0).cast("bigint"), lambda acc, x: F.shiftleft(acc, 16).bitwiseOR(x))
    v6 = bound(ipv6_groups(address), lambda g: F.struct(part(g, 0).alias("hi"), part(g, 4).alias("lo")))
    return F.when(family(address) == 6, v6).otherwise(F.struct(F.lit(0).cast("bigint").alias("hi"), ipv4_number(address).alias("lo")))


def masked(address: Column, fam: Column, length: Column) -> Column:
    """halves() with the bits behind a mask of `length` cleared."""
    bits = F.when(fam == 6, length).otherwise(length + 96).cast("int")
    keep = lambda n: F.when(n <= 0, F.lit(0).cast("bigint")).when(n >= 64, F.lit(-1).cast("bigint")).otherwise(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (64 - n).cast("int")))
    hi = address["hi"].bitwiseAND(keep(bits))
    return F.struct(hi.alias("hi"), address["lo"].bitwiseAND(keep(bits - 64)).alias("lo"))


def has_host_bits(prefix: Column | str) -> Column:
    return bound(halves(prefix), lambda h: masked(h, family(prefix), masklen(prefix)) != h)


def contains(prefix: Column | str, address: Column | str) -> Column:
    """Whether a network holds an address or a smaller network."""
    p, fam = _c(prefix), family(prefix)
    own = F.when(F.contains(_c(address), F.lit("/")), masklen(address)).otherwise(F.when(fam == 6, 128).otherwise(32))
    return (fam == family(address)) & (masklen(p) <= own) & (masked(halves(address), fam, masklen(p)) == masked(halves(p), fam, masklen(p)))


def sort_key(prefix: Column | str) -> Column:
    """Networks in order: family, address, length. Numbers are moved so that signed order is unsigned order."""
    h, low = halves(prefix), F.lit(-(2**63))
    return F.struct(family(prefix), h["hi"].bitwiseXOR(low), h["lo"].bitwiseXOR(low), masklen(prefix))


def attrs_json(attrs: Column | str) -> Column:
    """JSON text of attributes by name, in the order of names; null for none."""
    sorted_ = F.array_sort(F.map_entries(_c(attrs)))
    return bound(sorted_, lambda x: F.when(F.size(x) > 0, F.to_json(F.map_from_entries(x))))


def contains_all(array: Column | str, values: list[str]) -> Column:
    return F.size(F.array_except(F.array(*map(F.lit, values)), _c(array))) == 0
