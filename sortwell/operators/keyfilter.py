"""Stored bitmaps of key hashes, which tell of most new keys that a table does not hold them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.session import lookup_side

# Bits per key at which about one new key in sixteen passes by chance.
BITS_PER_KEY = 16
BITMAP_BYTES = 4096
MAX_BITS = 1 << 32


def bits_for(n_keys: int) -> int:
    """The size of the filter: a power of two, at least one bitmap."""
    return min(MAX_BITS, 1 << max(15, math.ceil(math.log2(max(1, n_keys) * BITS_PER_KEY))))


def _slot(key: str, bits: int) -> Column:
    """Place of a key in the filter, from 1 as the bitmap functions count."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_filter(df: DataFrame, key: str, bits: int) -> DataFrame:
    """bucket, bitmap: one row per `BITMAP_BYTES` bytes of the filter that hold a key. Filters of the same
    `bits` merge by `merged_filter`; null keys are left out."""
    slots = df.where(F.col(key).isNotNull()).select(_slot(key, bits).alias("slot"))
    return slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def merged_filter(filters: DataFrame) -> DataFrame:
    """Filters of several shards as one."""
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def maybe_known(df: DataFrame, filters: DataFrame, key: str, bits: int) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and few others. No row moves as long as the
    filter is within the bound that `lookup_side` checks on its rows, `BITMAP_BYTES` each."""
    slot = _slot(key, bits)
    probe = df.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot)})
    # A bitmap's bit p is bit p % 8 of its byte p / 8.
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    side = lookup_side(filters.select(F.col("bucket").alias("_bucket"), F.col("bitmap").alias("_bitmap")), max_rows=4096)
    hit = F.call_function("shiftright", byte, (F.col("_bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return probe.join(side, "_bucket").where(hit).select(*df.columns)


def overlap_of_new_keys(
    new: DataFrame, stored: DataFrame, filters: DataFrame, *, key: str, split: str, bits: int
) -> DataFrame:
    """For each split of `stored`, the number of distinct new keys that it holds already; exact.

    New keys are pruned by the stored filter where they are; only those that pass meet the stored rows, in
    one aggregation of both, in which repeated keys combine before the shuffle.
    """
    asked = maybe_known(new.select(key), filters, key, bits)
    both = asked.select(key, F.lit(None).cast("string").alias("_split")).unionByName(
        stored.where(F.col(key).isNotNull()).select(key, F.coalesce(F.col(split).cast("string"), F.lit("(none)")).alias("_split"))
    )
    per_key = both.groupBy(key).agg(
        F.max(F.col("_split").isNull()).alias("_new"), F.collect_set("_split").alias("_splits")
    )
    shared = per_key.where("_new").select(F.explode("_splits").alias(split))
    return shared.groupBy(split).agg(F.count(F.lit(1)).alias("n_shared"))
