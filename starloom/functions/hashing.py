"""Seeded row hashes: a sample or split must not change with the partitioning or on a retried task."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.numeric import as_col

HASH_BITS = 32
HASH_RANGE = 1 << HASH_BITS
_LOW31 = 0x7FFFFFFF
_LOW32 = 0xFFFFFFFF
# Odd multipliers with well spread bits.
_ROUNDS = ((15, 2654435761), (13, 2246822519), (16, 3266489917))


def seeded_hash(key: Column | str, seed: int = 42) -> Column:
    """Uniform hash in [0, 2^32) of one bigint key; only plain integer operations, so any SQL engine can repeat it.

    Other keys are reduced with `xxhash64` first, see `row_key`.
    """
    h = as_col(key).cast("bigint")
    h = h.bitwiseXOR(F.shiftrightunsigned(h, 31)).bitwiseAND(F.lit(_LOW31))
    h = (h * F.lit(2654435761) + F.lit(seed)).bitwiseAND(F.lit(_LOW32))
    for shift, factor in _ROUNDS:
        h = h.bitwiseXOR(F.shiftrightunsigned(h, shift)).bitwiseAND(F.lit(_LOW31))
        h = (h * F.lit(factor)).bitwiseAND(F.lit(_LOW32))
    return h


def row_key(*cols: str) -> Column:
    """Non-negative bigint key of any columns."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 63) - 1))
