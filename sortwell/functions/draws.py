"""Reproducible pseudo-random order and numbers from hashes of (seed, …, key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sortwell.functions.hashing import _col


def stable_order(key: Column | str, *seed_parts: object) -> Column:
    """Hex string that orders rows at random, the same way on every run and partitioning."""
    prefix = ":".join(str(p) for p in seed_parts)
    return F.md5(F.concat(F.lit(prefix + ":"), _col(key).cast("string")))


def uniform(key: Column | str, *seed_parts: object) -> Column:
    """Uniform DOUBLE in [0, 1): 13 hex digits of the same hash over 2^52."""
    digits = F.substring(stable_order(key, *seed_parts), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))
