"""Table, class, format and dimension profiles."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.operators.reconcile import reconcile_summary
from sortwell.session import one_row


def table_profile(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all in one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per non-null label; the caller orders the handful of result rows."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_percentages(df: DataFrame, label: str) -> DataFrame:
    """Rows of each non-null label and their share in percent, of the labelled rows and of all.

    One aggregation; the totals are windows over its rows, one per class.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    known = F.sum(F.when(F.col(label).isNotNull(), F.col("n"))).over(every)
    share = lambda total: F.lit(100.0) * F.col("n") / total
    found = counts.select(
        label, "n", share(known).alias("pct_of_labelled"), share(F.sum("n").over(every)).alias("pct_of_all")
    )
    return found.where(F.col(label).isNotNull())


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Loss weights by square root of inverse frequency: sqrt(N / (C * n))."""
    counts = class_counts(df, label)
    totals = counts.agg(F.sum("n").cast("double").alias("rows"), F.count(F.lit(1)).alias("classes"))
    ratio = totals.select((F.col("rows") / F.col("classes")).alias("r")).scalar()
    return counts.withColumn("weight", F.sqrt(ratio / F.col("n")))


def format_counts(files: DataFrame, fmt: str = "format", *, readable: Column | None = None) -> DataFrame:
    rows = files if readable is None else files.where(readable)
    return rows.where(F.col(fmt).isNotNull()).groupBy(fmt).agg(F.count(F.lit(1)).alias("n"))


def dimension_stats(files: DataFrame, columns: tuple[str, ...] = ("width", "height")) -> DataFrame:
    """Minimum, maximum and mean of every named column in one row."""
    kinds = {"min": F.min, "max": F.max, "mean": F.avg}
    return files.agg(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in kinds.items()])


def distinct_combinations(files: DataFrame, columns: tuple[str, ...] = ("width", "height")) -> DataFrame:
    known = functools.reduce(operator.and_, [F.col(c).isNotNull() for c in columns])
    return files.where(known).agg(F.count_distinct(*columns).alias("n_combinations"))


def top_combinations(
    files: DataFrame, columns: tuple[str, ...] = ("width", "height"), k: int = 10
) -> DataFrame:
    """The `k` most frequent combinations, ties in column order."""
    counts = files.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), *columns).limit(k)


def verified_ratio(df: DataFrame, verified: Column) -> DataFrame:
    """Rows that pass, all rows, their ratio and whether all pass. A null does not pass."""
    ok = F.coalesce(verified, F.lit(False))
    return df.agg(
        F.count_if(ok).alias("n_verified"),
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(ok.cast("double")).alias("ratio"),
        F.coalesce(F.bool_and(ok), F.lit(True)).alias("all_verified"),
    )


def first_k(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    return df.orderBy(*keys).limit(k)


def audit_summary(
    manifest: DataFrame, files: DataFrame, *, key: str, digest: str, readable: Column,
    dimensions: tuple[str, str], dimension_files: DataFrame | None = None,
) -> DataFrame:
    """One row: records, files, missing, extra, unreadable, duplicate relations, dimensions.

    Duplicate relations are counted over the manifest rows whose file exists, as rows minus
    distinct digests.
    """
    dims = files if dimension_files is None else dimension_files
    # One row per key before the join, so that an often repeated manifest key is no hot key there.
    mentions = manifest.groupBy(key).agg(F.count(F.lit(1)).alias("mentions"))
    existing = mentions.join(files.select(key, digest), key)
    per_digest = existing.where(F.col(digest).isNotNull()).groupBy(digest).agg(F.sum("mentions").alias("n"))
    return one_row(
        manifest.agg(F.count(F.lit(1)).alias("n_records")),
        files.agg(
            F.count(F.lit(1)).alias("n_files"),
            F.count_if(~F.coalesce(readable, F.lit(False))).alias("n_unreadable"),
        ),
        reconcile_summary(manifest, files, key=key).select("n_missing", "n_extra"),
        per_digest.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate_pairs")),
        distinct_combinations(dims, dimensions).withColumnRenamed("n_combinations", "n_dimensions"),
    )
