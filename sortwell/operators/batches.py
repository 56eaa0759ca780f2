"""Assigning rows to batches of a fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.functions.draws import stable_order
from sortwell.session import settled

_BUCKET_DIGITS = 4  # 65,536 buckets


def _check(batch_size: int) -> None:
    if batch_size <= 0:
        raise ValueError(f"a batch needs at least one row, not {batch_size}")


def _shuffled_positions(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """Position in hash order: rows before the hash bucket plus the rank inside the bucket.

    Hashes fill the buckets evenly whatever the keys look like, so every window group holds about
    rows / 65,536 rows, and the table of offsets has at most 65,536.
    """
    rows = df.select(key, stable_order(key, seed, epoch).alias("_hash")).withColumn(
        "_bucket", F.substring("_hash", 1, _BUCKET_DIGITS)
    )
    sizes = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    offsets = sizes.select("_bucket", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash", key))
    return rows.join(F.broadcast(offsets), "_bucket").select(
        key, (F.col("_before") + rank - 1).alias("position")
    )


def _ordered_positions(df: DataFrame, key: str) -> DataFrame:
    """Position in key order: a range sort, settled, then one offset per sorted partition.

    The offsets must come from the very partitions the rows are in, hence the settled copy of the
    keys. There is one offset per partition of the sort, which bounds the broadcast.
    """
    sorted_keys = settled(
        df.select(key).orderBy(key).withColumn("_id", F.monotonically_increasing_id())
    ).select(
        key,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    sizes = sorted_keys.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = sizes.select("_part", before.alias("_before"))
    return sorted_keys.join(F.broadcast(offsets), "_part").select(
        key, (F.col("_before") + F.col("_row")).alias("position")
    )


def assign_batches(
    df: DataFrame, *, key: str, batch_size: int = 32, shuffle: bool = False, seed: int = 42, epoch: int = 0
) -> DataFrame:
    """Key, position and batch_id. Evaluation keeps key order; training reshuffles every epoch.

    The last batch may be short. Only keys are moved; join other columns by key afterwards.
    """
    _check(batch_size)
    placed = _shuffled_positions(df, key, seed, epoch) if shuffle else _ordered_positions(df, key)
    batch = F.floor(F.col("position") / F.lit(batch_size)).cast("bigint")
    return placed.withColumn("batch_id", batch)


def batch_summary(df: DataFrame, *, split: str, batch_size: int = 32) -> DataFrame:
    """Per split: samples, batches and the size of the last batch, from the row counts alone."""
    _check(batch_size)
    n, b = F.col("n_samples"), F.lit(batch_size)
    return (
        df.groupBy(split)
        .agg(F.count(F.lit(1)).alias("n_samples"))
        .withColumn("n_batches", F.ceil(n / b).cast("bigint"))
        .withColumn("last_batch", n - (F.col("n_batches") - 1) * b)
    )


def write_batches(
    df: DataFrame, path: str, *, key: str, batch_size: int = 32, batches_per_shard: int = 64,
    shuffle: bool = False, seed: int = 42, epoch: int = 0, max_shards: int = 100_000,
) -> None:
    """Write rows with their position and batch_id in shards of whole batches.

    Shard s holds batches s * batches_per_shard to the next shard's first one, in one folder and in order
    of position, so a reader that streams a shard's files gets its batches one after another. Rows go
    straight to the task of their shard (`repartitionById`), which has a bounded number of them.
    """
    if batches_per_shard <= 0:
        raise ValueError(f"a shard needs at least one batch, not {batches_per_shard}")
    placed = assign_batches(df, key=key, batch_size=batch_size, shuffle=shuffle, seed=seed, epoch=epoch)
    shard = F.floor(F.col("batch_id") / F.lit(batches_per_shard)).cast("int")
    shards = -(-df.count() // (batch_size * batches_per_shard))
    dealt = df.join(placed, key).withColumn("shard", shard).repartitionById(max(1, min(shards, max_shards)), "shard")
    dealt.sortWithinPartitions("shard", "position").write.mode("overwrite").partitionBy("shard").parquet(path)


def resume_batches(spark: SparkSession, path: str, *, batch_id: int, batches_per_shard: int = 64) -> DataFrame:
    """The rows of batch `batch_id` and all after it. Only shards from its own on are listed and read."""
    rows = spark.read.parquet(path)
    first = batch_id // batches_per_shard
    return rows.where((F.col("shard") >= first) & (F.col("batch_id") >= batch_id))
