"""Small image files packed into shards of even size, and image headers read from them.

Millions of small files cost a listing and an open each in every job. They are listed once, dealt to
shards of `target_bytes` in order of their keys and written as rows; later jobs read shards. Headers
give format, width and height without decoding a pixel.
"""

from __future__ import annotations

import struct
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.session import lookup_side, settled

TARGET_BYTES = 128 << 20
# Marker bytes of JPEG frames that state the picture's size, and of segments without a length.
JPEG_FRAMES = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
JPEG_BARE = {0x01, *range(0xD0, 0xD8)}
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def shard_numbers(files: DataFrame, *, key: str = "key", length: str = "length", target_bytes: int = TARGET_BYTES) -> DataFrame:
    """key, shard: files in order of their keys, a new shard after every `target_bytes`.

    A shard has less than `target_bytes` and one file. Only keys and lengths are sorted; sizes of sorted
    partitions are added up in one row each.
    """
    ordered = settled(files.select(key, length).orderBy(key, length).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.sum(length).alias("_bytes"))
    before = F.sum("_bytes").over(Window.orderBy("_part")) - F.col("_bytes")
    offsets = lookup_side(sizes.select("_part", before.alias("_before")))
    inside = F.sum(length).over(Window.partitionBy("_part").orderBy("_id")) - F.col(length)
    placed = ordered.withColumn("_part", part).join(offsets, "_part")
    start = F.col("_before") + inside
    return placed.select(key, F.floor(start / F.lit(target_bytes)).cast("int").alias("shard"))


def pack_files(files: DataFrame, path: str, *, key: str = "key", target_bytes: int = TARGET_BYTES, max_tasks: int = 100_000) -> None:
    """Write files (unique key, length, content) as rows of shards, one folder per shard, in order of their keys."""
    numbers = settled(shard_numbers(files, key=key, target_bytes=target_bytes))
    shards = (numbers.agg(F.max("shard")).first()[0] or 0) + 1
    dealt = files.join(numbers, key).repartitionById(min(shards, max_tasks), "shard")
    dealt.sortWithinPartitions("shard", key).write.partitionBy("shard").parquet(path)


def packed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of all shards; a shard is a partition, and contents are read only when selected."""
    return spark.read.parquet(path)


def png_header(data: bytes) -> tuple[int, int, bool]:
    """Width, height, and whether all chunks are there with their checksums."""
    width, height = struct.unpack(">II", data[16:24])
    at = len(PNG_SIGNATURE)
    while at + 12 <= len(data):
        size, kind = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        if data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(data[at + 4 : at + 8 + size])):
            return width, height, False
        if kind == b"IEND":
            return width, height, True
        at += 12 + size
    return width, height, False


def jpeg_header(data: bytes) -> tuple[int | None, int | None, bool]:
    """Width and height from the frame segment, and whether the file ends with its end marker."""
    at, complete = 2, data.rstrip(b"\0\r\n").endswith(b"\xff\xd9")
    while at + 4 <= len(data) and data[at] == 0xFF:
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in JPEG_BARE:
            at += 2
        elif marker in JPEG_FRAMES and at + 9 <= len(data):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height, complete
        elif marker in (0xD9, 0xDA):
            break
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None, None, False


def header_of(data: bytes | None) -> tuple[str | None, int | None, int | None, str | None]:
    """Format, width, height and what is wrong with a file (null if nothing is)."""
    if not data:
        return None, None, None, "empty file"
    if data.startswith(PNG_SIGNATURE) and len(data) >= 33:
        kind, (width, height, complete) = "PNG", png_header(data)
    elif data.startswith(b"\xff\xd8\xff"):
        kind, (width, height, complete) = "JPEG", jpeg_header(data)
    else:
        return None, None, None, "unknown format"
    if not width or not height:
        return kind, None, None, "no size in its header"
    return kind, width, height, None if complete else "incomplete file"


def header_integrity(files: DataFrame, *, key: str = "key") -> DataFrame:
    """key, length, format, width, height, error for every file, from its headers. One file at a time is in
    memory besides its batch; no pixel is decoded and no content is shuffled."""
    types = dict(files.dtypes)

    def run(stream):
        for batch in stream:
            found = [header_of(value.as_py()) for value in batch.column(1)]
            kinds, widths, heights, errors = zip(*found) if found else ((), (), (), ())
            sizes = [len(value.as_py() or b"") for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kinds, pa.string()), pa.array(widths, pa.int32()),
                 pa.array(heights, pa.int32()), pa.array(errors, pa.string())],
                names=[key, "length", "format", "width", "height", "error"],
            )

    schema = f"`{key}` {types[key]}, length bigint, format string, width int, height int, error string"
    return files.select(key, "content").mapInArrow(run, schema)
