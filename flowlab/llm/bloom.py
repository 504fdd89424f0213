"""Bloom filters of bounded size, to tell tasks which rows may matter before anything is shuffled."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and bits in all (32 MB): a filter for more keys is fuller and lets more rows through, never fewer.
BITS_EACH, MOST_BITS, PROBES = 12, 1 << 28, 4


def _probes(key: Column, bits: int) -> Column:
    """The filter's bit positions for a 64-bit key."""
    return F.array(*[F.pmod(F.shiftrightunsigned(key, 13 * i), F.lit(bits)) for i in range(PROBES)])


def build(keys: DataFrame, column: str) -> tuple[np.ndarray, int]:
    """A Bloom filter of the 64-bit keys, which must be hashes: bits are set by an aggregation, and at most MOST_BITS / 8 bytes reach the driver."""
    n = keys.count()
    bits = 1 << max(10, min(MOST_BITS.bit_length() - 1, (n * BITS_EACH).bit_length()))
    set_bits = (
        keys.select(F.explode(_probes(F.col(column), bits)).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("v"))
    )
    out = np.zeros(bits // 64, np.int64)
    for batch in set_bits.toArrow().to_batches():
        out[batch["w"].to_numpy()] = batch["v"].to_numpy()
    return out.view(np.uint64), bits


def hits(table: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    hit = np.ones(keys.shape, bool)
    for i in range(PROBES):
        p = (keys >> np.uint64(13 * i)) & np.uint64(bits - 1) if i else keys & np.uint64(bits - 1)
        hit &= (table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return hit
