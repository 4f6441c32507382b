"""Sets of 64-bit hashes as bits of a fixed size, for tasks to look up in: a full one lets more through, loses nothing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sieve, as a power of two: 16 MB, whatever the input.
SIEVE = 27


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a sieve lets each key through: all that it was made of, and a few others."""
    slot = keys >> np.uint64(64 - SIEVE)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def sieve(keys: DataFrame) -> np.ndarray:
    """One bit for each possible start of a hash in column `h`, as bytes."""
    slots = keys.select(F.shiftrightunsigned("h", 64 - SIEVE).alias("slot")).select(
        F.shiftright("slot", 15).alias("part"), F.col("slot").bitwiseAND(32767).alias("place")
    )
    parts = slots.groupBy("part", "place").agg(F.lit(1)).groupBy("part").agg(F.bitmap_construct_agg("place").alias("bits")).toArrow()
    bits = np.zeros((1 << (SIEVE - 15), 4096), np.uint8)
    for part, own in zip(parts.column("part").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        bits[part] = np.frombuffer(own, np.uint8)
    return bits.reshape(-1)
