"""Exact duplicates by digest or hash, and repeated keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.operators.groups import attach_to_members
from sortwell.session import settled


def exact_duplicates(
    df: DataFrame, *, key: str, digest: str, order: str | None = None, hot_rows: int = 1_000_000
) -> DataFrame:
    """Star relations: the first row of each digest paired with every later one, n - 1 rows per
    group. "First" follows `order` (unique), else the smallest key."""
    order = order or key
    # Digests come from whole contents; settle them so that contents are read once.
    rows = settled(
        df.where(F.col(digest).isNotNull()).select(
            F.col(key).alias("_key"), F.col(order).alias("_order"), F.col(digest).alias("digest")
        )
    )
    first_key = F.min("_key") if order == key else F.min_by("_key", "_order")
    groups = (
        rows.groupBy("digest")
        .agg(
            F.min("_order").alias("_first_order"),
            first_key.alias("first_key"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.col("_n") > 1)
    )
    stars = attach_to_members(
        rows, groups, "digest", spread_by="_key", size_col="_n", hot_rows=hot_rows
    )
    return stars.where(F.col("_order") != F.col("_first_order")).select(
        "digest", "first_key", F.col("_key").alias("duplicate_key")
    )


def hash_groups(hashes: DataFrame, *, key: str, hash_col: str) -> DataFrame:
    """Hashes shared by more than one key: the hash, its smallest key and the number of keys.

    Members are not gathered into one cell; `hash_group_members` lists them in rows.
    """
    # Counting the hash leaves rows without one at zero; a filter before the aggregation would
    # make Spark work out a computed hash twice.
    groups = hashes.groupBy(hash_col).agg(F.min(key).alias("first_key"), F.count(hash_col).alias("n_keys"))
    return groups.where(F.col("n_keys") > 1)


def hash_group_members(
    hashes: DataFrame, *, key: str, hash_col: str, hot_rows: int = 1_000_000
) -> DataFrame:
    """One row per key whose hash is shared: the hash, the key and the number of keys with it."""
    rows = settled(hashes.select(key, hash_col))
    groups = hash_groups(rows, key=key, hash_col=hash_col).select(hash_col, "n_keys")
    return attach_to_members(
        rows, groups, hash_col, spread_by=key, size_col="n_keys", hot_rows=hot_rows
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
