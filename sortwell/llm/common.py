"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortwell.session import settled

# Rows per task number that are added up in one group first, so that no group grows with all tasks.
MERGED_TASKS = 1024

# White space as the contracts define it: space and the controls 9 to 13.
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs


def held_out(doc_id: Column | str) -> Column:
    """True for a quarter of the documents, by checksum of the id; never learned from."""
    text = (F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % 4 == 2, F.lit(False))


def whole_text(text: Column | str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` worked out once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint folder, which driver and executors share."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        settled(spark.range(0))
    return f"{sc.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


# Tables that a Python worker keeps from task to task, by the operator whose tasks use them.
WORKER_TABLES: dict[str, Callable[[], None]] = {}


def drop_tables(own: str | None) -> None:
    """Forget the tables of all operators but `own`."""
    for name, clear in WORKER_TABLES.items():
        if name != own:
            clear()


def hand_back() -> None:
    """Give the system the memory that Arrow and the C library hold but don't use."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux"):
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def lean(run: Callable[[Iterator], Iterable], own: str | None = None) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow, in workers that outlive it and are shared by all operators: they begin
    without the tables of other operators and keep no unused memory when the task is over."""

    def task(stream):
        drop_tables(own)
        try:
            yield from run(stream)
        finally:
            hand_back()

    return task


# A group of more than this part of all rows is broadcast in `looked_up`.
HOT_SHARE = 1000


def rows_with(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose key is in the one column of `kept`, nulls alike, with their own
    columns; names may clash.

    Rows of keys that more than a thousandth of all rows repeat, fewer than a thousand keys, stay where
    they are and meet a broadcast; the others are joined.
    """
    name = kept.columns[0]
    wanted, packed = kept.distinct(), docs.select(F.struct("*").alias("row"))
    own = F.col("row").getField(key)
    sizes = docs.groupBy(F.col(key).alias("hot_key")).agg(F.count("*").alias("n"))
    hot = settled(sizes.where(F.col("n") > max(1, docs.count() // HOT_SHARE)).select("hot_key"))
    if hot.isEmpty():
        return packed.join(wanted, own.eqNullSafe(F.col(name)), "left_semi").select("row.*")
    is_hot = own.eqNullSafe(F.col("hot_key"))
    wanted_hot = wanted.join(F.broadcast(hot), F.col(name).eqNullSafe(F.col("hot_key")), "left_semi")
    often = packed.join(F.broadcast(hot), is_hot, "left_semi").join(F.broadcast(wanted_hot), own.eqNullSafe(F.col(name)), "left_semi")
    rest = packed.join(F.broadcast(hot), is_hot, "left_anti").join(wanted, own.eqNullSafe(F.col(name)), "left_semi")
    return often.unionByName(rest).select("row.*")


def looked_up(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Join settled rows with a table that has one row per group and the group's number of rows.

    Groups with more than a thousandth of all `total` rows are fewer than a thousand, so these are
    broadcast; the others are joined.
    """
    large = F.col(size) > total // HOT_SHARE
    hot = F.broadcast(groups.where(large))
    return rows.join(hot, keys).unionByName(
        rows.join(hot.select(*keys), keys, "left_anti").join(groups.where(~large), keys)
    )
