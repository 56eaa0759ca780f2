"""Image files: listing, integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sortwell.functions.hashing import content_digest
from sortwell.sources.tables import _exists


def file_key(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def from_uri(uri: Column) -> Column:
    """Path of a file URI; a plus sign in it is itself, not a blank."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def find_image_dir(spark: SparkSession, candidates: list[str], glob: str = "*.jpg") -> str:
    """First candidate folder that holds a matching file; sub-folders are not searched."""
    for folder in candidates:
        if _exists(spark, f"{folder.rstrip('/')}/{glob}"):
            return folder
    raise FileNotFoundError(f"no folder among {candidates} holds {glob}")


def scan_image_files(spark: SparkSession, candidates: list[str], glob: str = "*.jpg") -> DataFrame:
    """key, path, length, content of every matching file in the first candidate folder with any.

    Contents are read only when selected. Spark's file scans pass over files of zero bytes, so
    these are added from the listing that the scan holds anyway.
    """
    folder = find_image_dir(spark, candidates, glob).rstrip("/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    rows = files.select(file_key(F.col("path")).alias("key"), "path", "length", "content")
    listed = _listed_files(spark, files).withColumn("key", file_key(F.col("path")))
    empty = listed.join(rows.select("key"), "key", "left_anti").select(
        "key", "path", F.lit(0).cast("bigint").alias("length"), F.lit(b"").alias("content")
    )
    return rows.unionByName(empty)


def _listed_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """`files.inputFiles()` as a DataFrame, without a detour through Python lists."""
    jvm = spark.sparkContext._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    listed = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    uri = DataFrame(listed.toDF(), spark)
    return uri.select(from_uri(F.col("value")).alias("path"))


def decode_images(spark: SparkSession, candidates: list[str], glob: str = "*.jpg") -> DataFrame:
    """key, height, width, n_channels, data (BGR rows); sizes are -1 when decoding fails."""
    folder = find_image_dir(spark, candidates, glob).rstrip("/")
    images = spark.read.format("image").option("pathGlobFilter", glob).load(folder)
    i = F.col("image")
    return images.select(
        file_key(from_uri(i["origin"])).alias("key"),
        i["height"].alias("height"),
        i["width"].alias("width"),
        i["nChannels"].alias("n_channels"),
        i["data"].alias("data"),
    )


def file_format(content: Column) -> Column:
    """Format by magic bytes, whatever the file name says."""
    head = F.hex(F.substring(content, 1, 12))
    # Published file signatures.
    return (
        F.when(head.startswith("FFD8FF"), "JPEG")
        .when(head.startswith("89504E470D0A1A0A"), "PNG")
        .when(head.startswith("47494638"), "GIF")
        .when(head.startswith("424D"), "BMP")
        .when(head.startswith("49492A00") | head.startswith("4D4D002A"), "TIFF")
        .when(head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250"), "WEBP")
    )


def image_integrity(spark: SparkSession, candidates: list[str], glob: str = "*.jpg") -> DataFrame:
    """key, width, height, format, digest, header_ok, decode_ok, error for every file.

    `header_ok`: the file starts like an image. `decode_ok`: all of it could be decoded. The two
    scans are joined on the key, unique in a flat folder; only narrow columns are shuffled.
    """
    files = scan_image_files(spark, candidates, glob).select(
        "key", "length", file_format(F.col("content")).alias("format"),
        content_digest("content").alias("digest"),
    )
    sizes = decode_images(spark, candidates, glob).select("key", "height", "width")
    decoded = F.coalesce(F.col("width") > 0, F.lit(False))
    joined = files.join(sizes, "key", "left")
    error = (
        F.when(F.col("length") == 0, "empty file")
        .when(F.col("format").isNull(), "unknown format")
        .when(~decoded, "cannot be decoded")
    )
    return joined.select(
        "key",
        F.when(decoded, F.col("width")).alias("width"),
        F.when(decoded, F.col("height")).alias("height"),
        "format",
        "digest",
        F.col("format").isNotNull().alias("header_ok"),
        decoded.alias("decode_ok"),
        error.alias("error"),
    )
