"""Repeatable pseudo-random numbers from a row key.

``row_hash`` folds a 64-bit key to 32 bits, adds a constant of the seed and the
draw, and mixes with two rounds of xor-shift and multiply: the same in every
engine with 64-bit integers, one-to-one on keys below 2**32, and independent
of how rows are spread over partitions or retried.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_RANGE = 1 << 32
LOW_32 = HASH_RANGE - 1

# Odd multipliers below 2**31, so that no product of a 32-bit number overflows.
MIX, FOLD = 0x45D9F3B, 0x27D4EB2D


def mixed(number: int) -> int:
    """The mixing rounds on a 32-bit integer, as in ``row_hash``."""
    for _ in range(2):
        number = (number ^ number >> 16) * MIX & LOW_32
    return number ^ number >> 16


def hash_constant(seed: int, draw: int) -> int:
    """What sets one seed and draw apart from all others."""
    return mixed(mixed(seed & LOW_32) + draw + 1 & LOW_32)


def row_hash(key: Column | str, seed: int = 0, draw: int = 0) -> Column:
    """A bigint in [0, 2**32) for an integer key; ``draw`` numbers independent draws.

    Both halves of the key count. Keys that are not integers go through
    ``integer_key`` first. A null key hashes to 0: splits, folds and ranks all
    take it from here, so such a row is a training row, of fold 0 and first.
    """
    column = (F.col(key) if isinstance(key, str) else key).cast("bigint")
    upper = (F.shiftrightunsigned(column, 32) * F.lit(FOLD)).bitwiseAND(F.lit(LOW_32))
    value = column.bitwiseAND(F.lit(LOW_32)).bitwiseXOR(upper).bitwiseXOR(F.lit(hash_constant(seed, draw)))
    for _ in range(2):
        value = (value.bitwiseXOR(F.shiftright(value, 16)) * F.lit(MIX)).bitwiseAND(F.lit(LOW_32))
    return F.coalesce(value.bitwiseXOR(F.shiftright(value, 16)), F.lit(0).cast("bigint"))


def integer_key(*columns: str) -> Column:
    """A bigint key from any columns."""
    return F.xxhash64(*columns)


def hash_share(key: Column | str, seed: int = 0, draw: int = 0) -> Column:
    """``row_hash`` as a double in [0, 1)."""
    return row_hash(key, seed, draw).cast("double") / F.lit(float(HASH_RANGE))


def hash_amount(key: Column | str, limit: float, seed: int = 0, draw: int = 0) -> Column:
    """A double in [-limit, limit)."""
    return (hash_share(key, seed, draw) * 2.0 - 1.0) * limit
