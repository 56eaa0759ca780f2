"""Reproducible samples per class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.functions.draws import stable_order


def sample_per_class(df: DataFrame, *, key: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """min(n, class size) rows of each class in hash order, numbered from 1 in `place`.

    Spark cuts each class to `n` rows per input partition before the shuffle (window group limit),
    so a dominant class does not reach one task as a whole.
    """
    if n <= 0:
        raise ValueError("n must be greater than zero")
    order = Window.partitionBy(label).orderBy(stable_order(key, seed), key)
    return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
