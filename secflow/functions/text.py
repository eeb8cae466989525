"""Text, time and address expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def split_fields(value: Column, delimiter: str, limit: int = -1) -> Column:
    """Split that forgets trailing empty fields."""
    # a plain character keeps the split on its fast path, which compiles no pattern
    return F.split(F.rtrim(value, F.lit(delimiter)), delimiter, limit)


def name_tokens(name: Column) -> Column:
    """Each character as ``socos`` + lower-case hex code; whitespace-only names give ''."""
    chars = F.filter(F.split(name, ""), lambda c: c != "")
    tokens = F.transform(chars, lambda c: F.concat(F.lit("socos"), F.lower(F.hex(F.ascii(c)))))
    return F.when(F.trim(name) != "", F.array_join(tokens, "")).otherwise(F.lit(""))


def stable_id(*parts: Column | str) -> Column:
    """Deterministic 32-hex id: a retried task or replayed batch writes the same key again."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", *cols))


def parse_time(text: Column) -> Column:
    return F.try_to_timestamp(F.trim(text), F.lit(TIME_FORMAT))


def format_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 address as an unsigned 32-bit number; NULL for anything but four numbers."""
    cut = F.substring_index
    octets = [cut(ip, ".", 1), cut(cut(ip, ".", 2), ".", -1), cut(cut(ip, ".", 3), ".", -1), cut(ip, ".", -1)]
    a, b, c, d = [o.try_cast("bigint") for o in octets]
    dots = F.length(ip) - F.length(F.translate(ip, ".", ""))
    return F.when(dots == 3, a * 16777216 + b * 65536 + c * 256 + d)


def ip_bounds(span: str) -> tuple[int, int]:
    """``begin-end`` dotted range as two numbers."""
    def number(ip: str) -> int:
        total = 0
        for octet in ip.strip().split("."):
            total = total * 256 + int(octet)
        return total

    low, high = span.split("-")
    return number(low), number(high)


def ip_in_any(ip: Column, spans: list[str]) -> Column:
    """Membership for a single test; for several, number the address once and use number_in_any."""
    return number_in_any(ip_to_long(ip), spans)


def number_in_any(number: Column, spans: list[str]) -> Column:
    """Inclusive membership of an address number in any of the ``begin-end`` ranges."""
    inside = F.lit(False)
    for low, high in map(ip_bounds, spans):
        inside = inside | number.between(low, high)
    return F.coalesce(inside, F.lit(False))


def ip_prefix(ip: Column) -> Column:
    """First three octets."""
    return F.substring_index(ip, ".", 3)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, d: s + d))
