"""From raw documents to token ids: language, exact copies, near copies, mix, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns a DataFrame, which
`run` writes as Parquet in the shared folder and reads again for the next one. All but the last keep
the columns of `docs`. The first one drops documents without a recognised language: those without a
letter (null and empty texts among them) and those whose likeliest language has a probability below
0.5. In the given tables that is none. The second and third keep the smallest id of each group of equal
and of near texts; rows that repeat id and text are one document to them and stay or go together. Rows
without an id stay only where no row of their group has one. The mix decides the order of the rows in its files; a scan deals files out by
size, so the last stage reads the order from the files' numbers and the rows' places in them and
returns it as `position`, 0 for the first row of the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.llm import bpe, exactdedup, jaccard_join, langid, mixing
from sortwell.llm.common import documents, shared_folder
from sortwell.llm.queries import VOCABULARY
from sortwell.session import lookup_side

# Partition and file numbers in the names that Spark's writers give.
FILE_NUMBERS = r"part-(\d+)-.*?(?:-c|\.c)(\d+)\."


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.with_language(docs)


def exact_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exactdedup.without_copies(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def positioned(docs: DataFrame) -> DataFrame:
    """doc_id, text and `position`, the row's place in the order in which `docs` was written. Rows
    that don't come from files are in the order of their partitions. Files are numbered in Spark; their
    table is broadcast only within the bound that `lookup_side` checks."""
    try:
        parts = docs.select("doc_id", "text", F.col("_metadata.file_path").alias("part"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        number = F.monotonically_increasing_id()
        parts = docs.select("doc_id", "text", F.format_string("part-%010d-c0.", F.shiftright(number, 33)).alias("part"),
                            number.bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    name = F.element_at(F.split("part", "/"), -1)
    numbers = [F.expr(f"try_cast({part} as bigint)") for part in ("first", "second")]
    named = counts.withColumns({"first": F.regexp_extract(name, FILE_NUMBERS, 1), "second": F.regexp_extract(name, FILE_NUMBERS, 2)})
    before = Window.orderBy(*numbers, "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = lookup_side(named.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return parts.join(starts, "part").select("doc_id", "text", (F.col("start") + F.col("row")).alias("position"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(positioned(docs), VOCABULARY, carried=["position"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", recognised),
    ("exact_dedup", exact_copies_out),
    ("ngram_jaccard", near_copies_out),
    ("mixing", mixed),
    ("bpe", encoded),
]

# Language models, Jaccard components and token ids are out of reach of SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
