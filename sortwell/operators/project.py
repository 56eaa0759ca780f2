"""Label mapping, provenance columns and class filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortwell.session import small_table


def _lookup(df: DataFrame, on: str, rows: list[tuple], fields: list[T.StructField]) -> DataFrame:
    """Left join a driver-known table; its size is that of a Python list, so it is broadcast."""
    key = T.StructField("_lookup", df.schema[on].dataType)
    table = small_table(df.sparkSession, rows, T.StructType([key, *fields]))
    return df.join(F.broadcast(table), F.col(on) == F.col("_lookup"), "left").drop("_lookup")


def canonicalise(
    df: DataFrame, label_col: str, mapping: dict, *, out: str = "canonical_label",
    on_unknown: str = "error",
) -> DataFrame:
    """Add the canonical name of a source label.

    `on_unknown`: "error" fails the job, "null" leaves the name empty, "quarantine" returns only
    the rows whose label is not in the mapping.
    """
    if on_unknown not in ("error", "null", "quarantine"):
        raise ValueError("on_unknown must be error, null or quarantine")
    rows = list(mapping.items())
    mapped = _lookup(df, label_col, rows, [T.StructField(out, T.StringType())])
    if on_unknown == "quarantine":
        return mapped.where(F.col(out).isNull()).drop(out)
    if on_unknown == "error":
        label = F.coalesce(F.col(label_col).cast("string"), F.lit("null"))
        unknown = F.raise_error(F.concat(F.lit("no canonical label is mapped to "), label))
        mapped = mapped.withColumn(out, F.coalesce(F.col(out), unknown.cast("string")))
    return mapped


def with_provenance(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Add constant columns; a None becomes a typed STRING null."""
    return df.withColumns(
        {
            name: F.lit(value) if value is not None else F.lit(None).cast("string")
            for name, value in constants.items()
        }
    )


def encode_labels(df: DataFrame, label_col: str, vocab: list[str], *, out: str = "class_index") -> DataFrame:
    """Class name to its position in the vocabulary."""
    rows = [(name, index) for index, name in enumerate(vocab)]
    return _lookup(df, label_col, rows, [T.StructField(out, T.IntegerType())])


def decode_labels(df: DataFrame, index_col: str, vocab: list[str], *, out: str = "class_name") -> DataFrame:
    """Position in the vocabulary to class name."""
    return _lookup(df, index_col, list(enumerate(vocab)), [T.StructField(out, T.StringType())])


def label_display(df: DataFrame, label_col: str, registry: list[dict]) -> DataFrame:
    """Add display name, abbreviation and category from label registry rows."""
    names = ("display_name", "abbreviation", "category")
    rows = [(r["label"], *(r[n] for n in names)) for r in registry]
    return _lookup(df, label_col, rows, [T.StructField(n, T.StringType()) for n in names])


def filter_class(df: DataFrame, label_col: str, label: object) -> DataFrame:
    return df.where(F.col(label_col) == F.lit(label))
