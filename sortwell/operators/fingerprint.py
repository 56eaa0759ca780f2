"""Comparing whole tables by order-free fingerprints of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortwell.session import one_row, settled

SUM = "decimal(38,0)"
BUCKETS = 4096


def row_hash(df: DataFrame, columns: list[str], salt: int) -> Column:
    """A 64-bit hash of a row. Nulls count, as each column's flag is hashed too; nested columns are hashed
    as JSON, which shows where their nulls are."""
    parts = [F.lit(salt)]
    for c in columns:
        nested = isinstance(df.schema[c].dataType, (T.ArrayType, T.StructType, T.MapType))
        value = F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}) if nested else F.col(c)
        parts += [F.col(c).isNull(), value]
    return F.xxhash64(*parts)


def bucket_of(df: DataFrame, columns: list[str], buckets: int) -> Column:
    return F.pmod(row_hash(df, columns, 0), F.lit(buckets)).cast("int")


def bucket_fingerprints(df: DataFrame, columns: list[str] | None = None, *, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n (rows), sum_a and sum_b (of two hashes): the multiset of rows, in any order.

    Rows are dealt to buckets by their hash and combine before the shuffle, so a task sends one row per
    bucket, whatever its input. Two tables that differ agree in a bucket with a chance of about 2^-128.
    """
    columns = columns or df.columns
    hashed = df.select(
        bucket_of(df, columns, buckets).alias("bucket"),
        *[row_hash(df, columns, s).cast(SUM).alias(f"h{s}") for s in (1, 2)],
    )
    return hashed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("h1").cast(SUM).alias("sum_a"), F.sum("h2").cast(SUM).alias("sum_b")
    )


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: n_rows and a hex digest that is the same for equal multisets of rows."""
    sums = bucket_fingerprints(df, columns, buckets=1)
    whole = one_row(
        sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")),
        sums.agg(F.sha2(F.concat_ws(
            ":", *[F.coalesce(F.sum(c), F.lit(0)).cast(SUM).cast("string") for c in ("n", "sum_a", "sum_b")]
        ), 256).alias("fingerprint")),
    )
    return whole.select("n_rows", "fingerprint")


def differing_rows(first: DataFrame, second: DataFrame, *, buckets: int = BUCKETS) -> DataFrame:
    """Rows that the two tables don't have equally often, with `n_more` = times in the first less times
    in the second.

    Fingerprints of buckets are compared first. Only rows of buckets that differ are shuffled, so equal
    tables never move a row, and a few differences move a few rows in `buckets`.
    """
    columns = first.columns
    second = second.select(*columns)
    sides = [bucket_fingerprints(df, columns, buckets=buckets) for df in (first, second)]
    signed = sides[0].withColumn("_sign", F.lit(1)).unionByName(sides[1].withColumn("_sign", F.lit(-1)))
    sums = [F.sum(F.col(c).cast(SUM) * F.col("_sign")) for c in ("n", "sum_a", "sum_b")]
    differs = signed.groupBy("bucket").agg(*[s.alias(f"_d{i}") for i, s in enumerate(sums)])
    # At most `buckets` rows.
    open_ = settled(differs.where("_d0 <> 0 OR _d1 <> 0 OR _d2 <> 0").select(F.col("bucket").alias("_bucket")))
    if open_.isEmpty():
        return first.where(F.lit(False)).withColumn("n_more", F.lit(0).cast("bigint"))

    def inside(df: DataFrame, sign: int) -> DataFrame:
        dealt = df.withColumn("_bucket", bucket_of(df, columns, buckets))
        return dealt.join(F.broadcast(open_), "_bucket", "left_semi").select(*columns, F.lit(sign).alias("_sign"))

    both = inside(first, 1).unionByName(inside(second, -1))
    return both.groupBy(*columns).agg(F.sum("_sign").alias("n_more")).where(F.col("n_more") != 0)
