"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A looked-up table is broadcast only up to this many rows; larger ones take a shuffle join.
MAX_BROADCAST_ROWS = 100_000


def build_session(app: str = "sortwell", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; `conf` keys use `_` for `.`."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Rows that go through Arrow here are whole images, so batches stay short.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
        # Settled tables go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def settled(df: DataFrame) -> DataFrame:
    """Materialise a narrow intermediate in the cluster's shared checkpoint folder.

    Used where several later steps read the same costly result, so that a lost executor never
    triggers the whole chain again and no step sees a differently ordered copy.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="sortwell-checkpoint-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the settled tables, which driver and executors share."""
    if spark.sparkContext.getCheckpointDir() is None:
        settled(spark.range(0))
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def widened(settled_df: DataFrame, key: str) -> DataFrame:
    """Give a settled table at least one partition per core before its rows are multiplied.

    Small tables come out of a shuffle in one partition. Large ones have enough and stay as they
    are.
    """
    cores = settled_df.sparkSession.sparkContext.defaultParallelism
    if settled_df.rdd.getNumPartitions() >= cores:
        return settled_df
    return settled_df.repartition(cores, key)


def small_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A driver-known list (vocabulary, registry, label map) as a local relation."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays(
        [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema=schema)


def bounded_copy(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame | None:
    """The table as a broadcast local relation, or None when it has more than `max_rows` rows.

    take() reads a few partitions first and stops as soon as the bound is passed, so a long table
    costs no full scan.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return None
    return F.broadcast(df.sparkSession.createDataFrame([tuple(r) for r in rows], schema=df.schema))


def lookup_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Prepare an aggregated table (one row per class) for a join with the base rows.

    It is worked out once and settled; then it is broadcast when it is within the bound, and joined
    as it is otherwise.
    """
    kept = settled(df)
    return F.broadcast(kept) if kept.count() <= max_rows else kept


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side without a join."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    columns = [c for frame in frames for c in frame.columns]
    return merged.agg(*[F.max(c).alias(c) for c in columns])
