"""Tables in committed versions.

A version is a folder of its own under `path`. It counts once its commit record exists, which is one small
file, written last and never changed; readers take the latest committed version, or a given one. A job
that dies half-way leaves a folder without a record, which nobody reads, and the version before stays
the latest. Rewriting never touches what readers may be reading.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sortwell.operators.fingerprint import table_fingerprint
from sortwell.session import small_table
from sortwell.sources.tables import _exists

RECORD = "version bigint, folder string, format string, schema string, partitions array<string>, n_rows bigint, fingerprint string"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit records of a table; none where nothing was committed yet."""
    if not _exists(spark, f"{path}/_commits/*/*.json"):
        return small_table(spark, [], RECORD)
    return spark.read.schema(RECORD).json(f"{path}/_commits/*/*.json")


def latest_commit(spark: SparkSession, path: str, version: int | None = None):
    """The record of a version, by default the latest one."""
    found = commits(spark, path)
    if version is not None:
        found = found.where(F.col("version") == version)
    record = found.orderBy(F.desc("version"), "folder").first()
    if record is None:
        raise FileNotFoundError(f"{path} has no committed version" + ("" if version is None else f" {version}"))
    return record


def write_version(df: DataFrame, path: str, *, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> int:
    """Write a new version and commit it; gives its number.

    Rows and fingerprint are taken from what was written, so they tell whether a reader gets all of it.
    The record's folder is named by the version: of two writers that began from the same version, the
    second fails at its commit instead of replacing the first.
    """
    spark = df.sparkSession
    last = commits(spark, path).agg(F.max("version")).first()[0] or 0
    folder = f"v{last + 1:08d}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).format(fmt).option("header", True).save(f"{path}/{folder}")
    record = small_table(
        spark, [(last + 1, folder, fmt, df.schema.json(), list(partition_by))], ", ".join(RECORD.split(", ")[:5])
    )
    written = table_fingerprint(_read(spark, f"{path}/{folder}", fmt, df.schema))
    whole = record.withColumns({c: written.select(c).scalar() for c in written.columns})
    whole.coalesce(1).write.mode("errorifexists").json(f"{path}/_commits/v{last + 1:08d}")
    return last + 1


def _read(spark: SparkSession, folder: str, fmt: str, schema) -> DataFrame:
    rows = spark.read.schema(schema).option("header", True).format(fmt).load(folder)
    return rows.select(*schema.names)


def read_version(spark: SparkSession, path: str, version: int | None = None, *, check: bool = False) -> DataFrame:
    """The rows of the latest committed version, or of a given one, with the schema they were written
    with. `check` compares them with the record first and fails if any are missing or changed."""
    record = latest_commit(spark, path, version)
    rows = _read(spark, f"{path}/{record.folder}", record.format, StructType.fromJson(json.loads(record.schema)))
    if check:
        found = table_fingerprint(rows).first()
        if (found.n_rows, found.fingerprint) != (record.n_rows, record.fingerprint):
            raise ValueError(f"version {record.version} of {path} is not what was committed")
    return rows
