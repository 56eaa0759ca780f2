"""Evaluation metrics of predicted against true classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortwell.session import small_table


def confusion_matrix(df: DataFrame, *, truth: str, pred: str, vocab: list) -> DataFrame:
    """Rows per (truth, prediction): every pair of vocabulary classes, zeros included, and every
    other pair that occurs. Nulls and unlisted values have cells of their own, so all rows count."""
    dtype = df.schema[truth].dataType
    schema = T.StructType([T.StructField("truth", dtype), T.StructField("prediction", dtype)])
    grid = small_table(df.sparkSession, [(t, p) for t in vocab for p in vocab], schema)
    zeros = grid.withColumn("n", F.lit(0).cast("bigint"))
    counts = df.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return zeros.unionByName(counts).groupBy("truth", "prediction").agg(F.sum("n").alias("n"))


def accuracy(df: DataFrame, *, truth: str, pred: str) -> DataFrame:
    """Share of all rows whose prediction is the truth; a null on either side is a miss."""
    hit = F.coalesce(F.col(truth) == F.col(pred), F.lit(False)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def precision_recall(df: DataFrame, *, truth: str, pred: str, vocab: list) -> DataFrame:
    """Per vocabulary class: support, precision, recall and F1; an undefined value is 0.

    Support counts all rows with that truth, whatever their prediction; a row with null or unlisted
    truth lowers the precision of the class it is predicted as.
    """
    cells = confusion_matrix(df, truth=truth, pred=pred, vocab=vocab)
    roles = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("class"), F.lit(1).alias("is_true"),
                    F.coalesce(F.col("truth") == F.col("prediction"), F.lit(False)).cast("int").alias("is_hit"),
                    F.col("n"),
                ),
                F.struct(
                    F.col("prediction").alias("class"), F.lit(0).alias("is_true"),
                    F.lit(0).alias("is_hit"), F.col("n"),
                ),
            )
        )
    )
    n = F.col("n")
    listed = F.col("class").isin(vocab)
    sums = roles.where(listed).groupBy("class").agg(
        F.sum(n * F.col("is_hit")).alias("hits"),
        F.sum(n * F.col("is_true")).alias("support"),
        F.sum(n * (1 - F.col("is_true"))).alias("predicted"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return sums.select(
        "class",
        "support",
        ratio(hits, predicted).alias("precision"),
        ratio(hits, support).alias("recall"),
        ratio(2 * hits, support + predicted).alias("f1"),
    )


def macro_f1(df: DataFrame, *, truth: str, pred: str, vocab: list) -> DataFrame:
    """Unweighted mean of the class F1 values."""
    return precision_recall(df, truth=truth, pred=pred, vocab=vocab).agg(F.avg("f1").alias("macro_f1"))
