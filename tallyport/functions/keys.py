"""Key functions: identifier checks and the log's partition hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Constants of the murmur2 hash used to place keyed records.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
MASK32 = 0xFFFFFFFF
MASK31 = 0x7FFFFFFF
CANONICAL = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"


def canonical_uuid(text: Column) -> Column:
    """Lower-case hyphenated form of an identifier, or NULL when it is malformed.

    Two spellings of one identifier must meet in one row, so keys use this form. Most have it
    already and need one look instead of four.
    """
    digits = F.lower(F.regexp_replace(text, "^urn:|uuid:|[{}-]", ""))
    hyphenated = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(text.rlike(CANONICAL), text).when(digits.rlike("^[0-9a-f]{32}$"), hyphenated)


def murmur2(key: Column) -> Column:
    """32-bit murmur2 of the UTF-8 bytes, as a non-negative BIGINT.

    All products stay below 2^63, so plain BIGINT arithmetic with masks is exact.
    """
    data = F.encode(key, "UTF-8")
    size = F.octet_length(data).cast("bigint")

    def times_m(x: Column) -> Column:
        return (x * F.lit(MULTIPLIER).cast("bigint")).bitwiseAND(F.lit(MASK32))

    def fold(x: Column, bits: int) -> Column:
        return x.bitwiseXOR(F.shiftrightunsigned(x, bits))

    def little_endian(start: Column, width: Column | int) -> Column:
        piece = F.rpad(F.hex(F.substring(data, start, width if isinstance(width, Column) else F.lit(width))), 8, "0")
        turned = F.concat(*[F.substring(piece, at, 2) for at in (7, 5, 3, 1)])
        return F.conv(turned, 16, 10).cast("bigint")

    def step(h: Column, i: Column) -> Column:
        word = times_m(fold(times_m(little_endian(i * 4 + 1, 4)), 24))
        return times_m(h).bitwiseXOR(word)

    words = F.floor(size / 4).cast("int")
    whole = F.when(words > 0, F.sequence(F.lit(0), words - 1)).otherwise(F.array().cast("array<int>"))
    start = F.lit(SEED).cast("bigint").bitwiseXOR(size)
    mixed = F.aggregate(whole, start, step)
    tail = size % 4
    with_tail = F.when(
        tail > 0, times_m(mixed.bitwiseXOR(little_endian(words * 4 + 1, tail.cast("int"))))
    ).otherwise(mixed)
    return fold(times_m(fold(with_tail, 13)), 15)


def log_partition(key: Column, partitions: int) -> Column:
    """Partition a keyed record is placed in."""
    return (murmur2(key).bitwiseAND(F.lit(MASK31)) % partitions).cast("int")
