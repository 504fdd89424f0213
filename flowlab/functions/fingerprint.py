"""Row fingerprints over feature columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fingerprint_md5(columns: list[str], digits: int = 4) -> Column:
    """MD5 of the columns rounded to decimals, joined by |, null as ~."""
    parts = [F.coalesce(F.col(f"`{c}`").cast(f"decimal(18,{digits})").cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def fingerprint_hash(columns: list[str]) -> Column:
    """64-bit hash in which nulls count (a plain hash skips them)."""
    return F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def md5_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    """A stable bucket of a key: 60 bits of an MD5, so other engines can compute it too."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 15), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def md5_share(key: Column, salt: str = "") -> Column:
    """A stable number in [0, 1) for a key."""
    return md5_bucket(key, 1_000_000, salt) / 1_000_000
