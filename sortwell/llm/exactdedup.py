"""Exact duplicates by an extendible-hash index in the shared folder.

A text counts with every run of white space replaced by one space; null is empty. Its 64-bit hash is
the key. The directory starts with one bucket and doubles as long as a bucket is overfull: that
bucket splits on the next bit of its keys, the others keep their depth. It is built from one count
per key prefix, so its size is fixed by `MAX_DEPTH`. Before the shuffle every task collapses the
equal texts it has read, so a group of copies sends one row per task. Bucket k is owned
by task k, which gets all keys of its range in order; keys that collide are chained, and texts are compared byte by byte. It writes
one index row per different text (bucket, key, sha256, smallest id, group size) to the shared
folder; documents look their group up there. Groups of more than a thousandth of all rows, less
than a thousand of them, are broadcast for that; the others are joined.

Defined results: rows without an id get the smallest id of their group, null where no row has one,
and are kept only in that case. Rows that repeat id and text are one document: both count in
group_size and both are kept or dropped. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import SPACE_RUN, lean, looked_up, rows_with, settled, shared_folder, whole_text

MAX_DEPTH = 16
BUCKET_BYTES = 32 << 20
# Text that a task holds at once while it collapses equal rows.
HELD_BYTES = 24 << 20


def normalised(text: str = "text"):
    return F.regexp_replace(whole_text(text), SPACE_RUN, " ")


def directory(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """First prefix and depth of every bucket, given the bytes below each prefix of full depth."""
    full = len(sizes).bit_length() - 1
    first, depth = [], []
    open_ = np.zeros(1, dtype=np.int64)  # prefixes of the present depth that are still buckets
    for d in range(full + 1):
        below = sizes.reshape(1 << d, -1).sum(axis=1)
        overfull = (below[open_] > capacity) & (d < full)
        done = open_[~overfull]
        first += (done << (full - d)).tolist()
        depth += [d] * len(done)
        open_ = np.concatenate([2 * open_[overfull], 2 * open_[overfull] + 1])
    order = np.argsort(first)
    return np.array(first, dtype=np.int64)[order], np.array(depth, dtype=np.int64)[order]


def smaller(a, b):
    return b if a is None else a if b is None else min(a, b)


def collapsed(batch_rows, held_bytes: int):
    """Runs through (key, text, id) rows and yields (key, text, smallest id, rows) entries."""
    chains: dict[int, list[list]] = {}
    held = 0
    for key, text, number in batch_rows:
        chain = chains.setdefault(key, [])
        for entry in chain:
            if entry[0] == text:
                entry[1] = smaller(entry[1], number)
                entry[2] += 1
                break
        else:
            chain.append([text, number, 1])
            held += len(text) + 100
        if held >= held_bytes:
            yield from ((k, *e) for k, c in chains.items() for e in c)
            chains, held = {}, 0
    yield from ((k, *e) for k, c in chains.items() for e in c)


def chained(rows):
    """Rows (bucket, key, text, id, count, sha256) in order of the key: adds equal texts up."""
    current, chain = None, []
    for bucket, key, text, number, count, digest in rows:
        if (bucket, key) != current:
            yield from ((*current, e[3], e[1], e[2]) for e in chain)
            current, chain = (bucket, key), []
        for entry in chain:
            if entry[0] == text:
                entry[1] = smaller(entry[1], number)
                entry[2] += count
                break
        else:
            chain.append([text, number, count, digest])
    yield from ((*current, e[3], e[1], e[2]) for e in chain)


def in_batches(rows, types: list[pa.DataType], names: list[str], text_at: int | None = None):
    """Arrow batches of at most 2,000 rows or about 8 MB of text."""
    own, size = [], 0
    for row in rows:
        own.append(row)
        size += len(row[text_at]) if text_at is not None else 0
        if len(own) == 2000 or size > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own), types)], names=names)
            own, size = [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*own), types)], names=names)


def build_index(docs: DataFrame, keys: DataFrame, key: str, bucket_bytes: int, max_depth: int) -> tuple[DataFrame, int]:
    """The index as a table in the shared folder, and the number of rows in `keys`."""
    spark = docs.sparkSession
    per_key = keys.groupBy("h").agg(F.max("size").alias("size"), F.count("*").alias("n"))
    counts = per_key.groupBy(F.shiftrightunsigned("h", 64 - max_depth).alias("prefix")).agg(
        F.sum("size").alias("size"), F.sum("n").alias("n")
    )
    sizes, total = np.zeros(1 << max_depth, dtype=np.int64), 0
    for row in counts.toLocalIterator():  # at most 2**max_depth rows
        sizes[row.prefix] = row["size"]
        total += row.n
    first, _ = directory(sizes, bucket_bytes)
    owners = spark.sparkContext.broadcast(first)
    id_type = pa.string() if docs.schema[key].dataType.simpleString() == "string" else pa.int64()
    id_name = "string" if id_type == pa.string() else "bigint"

    def combine(stream):
        def rows():
            for batch in stream:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

        def placed():
            for h, text, number, count in collapsed(rows(), HELD_BYTES):
                prefix = (h % (1 << 64)) >> (64 - max_depth)
                yield int(np.searchsorted(owners.value, prefix, side="right") - 1), h, text, number, count

        return in_batches(placed(), [pa.int32(), pa.int64(), pa.string(), id_type, pa.int64()],
                          ["bucket", "h", "text", "id", "n"], text_at=2)

    def own(stream):
        def rows():
            for batch in stream:
                yield from zip(*(batch.column(i).to_pylist() for i in range(6)))

        return in_batches(chained(rows()), [pa.int32(), pa.int64(), pa.binary(), id_type, pa.int64()],
                          ["bucket", "h", "sha", "keep_id", "group_size"])

    text = normalised()
    entries = docs.select(F.xxhash64(text).alias("h"), text.alias("text"), F.col(key)).mapInArrow(
        lean(combine), f"bucket int, h bigint, text string, id {id_name}, n bigint"
    )
    # Bucket k goes to task k, so every owner has one range of keys.
    owned = entries.repartitionById(max(1, len(first)), "bucket").sortWithinPartitions("bucket", "h")
    index = owned.withColumn("sha", F.unhex(F.sha2("text", 256))).mapInArrow(
        lean(own), f"bucket int, h bigint, sha binary, keep_id {id_name}, group_size bigint"
    )
    folder = shared_folder(spark, "hash-index")
    index.write.parquet(folder)
    return spark.read.schema(index.schema).parquet(folder), total


def exact_groups(docs: DataFrame, key: str = "doc_id", bucket_bytes: int = BUCKET_BYTES,
                 max_depth: int = MAX_DEPTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`."""
    docs = docs.select(key, "text")
    text = normalised()
    keys = settled(docs.select(
        key, F.xxhash64(text).alias("h"), F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).alias("size")
    ))
    index, total = build_index(docs, keys, key, bucket_bytes, max_depth)
    groups = index.select("h", "sha", "keep_id", "group_size")
    found = looked_up(keys, groups, ["h", "sha"], "group_size", total)
    return found.select(
        key, "keep_id", "group_size", F.col("keep_id").eqNullSafe(F.col(key)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with their own columns."""
    return rows_with(docs, exact_groups(docs, key).where("kept").select(F.col(key).alias("kept_id")), key)
