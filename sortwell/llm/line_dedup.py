"""Line dedup: lines that many documents share stay in one of them only.

Texts are split at \\n. A line's key is the line without white space at both ends, A-Z in lower case.
Every line with a key of at least `min_chars` code points is exploded to (document, place, 128-bit hash
of the key). A hash found in `min_docs` documents or more is dropped everywhere except in the document
with the largest id that holds it, there with all its lines. The places to drop go back to their texts,
and the lines at the other places are put together in order.

Scale. Only hashes and places are shuffled for counting, and counting distinct documents combines
before each of its two shuffles, so a line of a third of all documents is as good as any other. For the
way back, hashes found in more than a thousandth of all lines (fewer than a thousand) are broadcast,
the others joined. Texts are shuffled once, by document and hash of the text, to meet their places;
rows that repeat id and text very often get theirs by a broadcast of fewer than a thousand lists, which
hold fewer than a thousand times the mean number of lines of a text between them.

Defined results: a null or empty text is one empty line. Documents are told apart by id, so rows that
repeat an id count once and each lose the same lines; all rows without an id count as one document, which
comes before all others. Ties cannot occur, as ids are compared and not rows. Only the id and the text are
read; the other columns of `docs` are carried in one struct, so none of them can clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import HOT_SHARE, let, looked_up, settled, whole_text

MIN_CHARS = 40
MIN_DOCS = 5
SPACE = " \t\n\x0b\f\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else: `lower` alone would change other letters as well."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACE)))


def keyed_lines(docs: DataFrame, key: str, min_chars: int) -> DataFrame:
    """doc, t (hash of the text), at (place from 0), h: every line that is long enough to count."""
    lines = docs.select(
        F.col(key).alias("doc"), F.xxhash64("text").alias("t"), F.posexplode(F.split(whole_text(), "\n")).alias("at", "line")
    )
    keys = lines.select("doc", "t", "at", line_key(F.col("line")).alias("line"))
    return keys.where(F.char_length("line") >= min_chars).select("doc", "t", "at", F.unhex(F.md5("line")).alias("h"))


def shared_hashes(lines: DataFrame, min_docs: int) -> DataFrame:
    """h, keeper (largest id with it, null if only rows without an id have it), n (lines with it)."""
    per_doc = lines.groupBy("h", "doc").agg(F.count("*").alias("n"))
    found = per_doc.groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"), F.sum("n").alias("n"))
    return found.where(F.col("n_docs") >= min_docs).select("h", "keeper", "n")


def dropped_places(lines: DataFrame, min_docs: int) -> DataFrame:
    """doc, t, places: the sorted places of all lines to drop, one row per document and text."""
    lines = settled(lines)
    shared = settled(shared_hashes(lines, min_docs))
    found = looked_up(lines, shared, ["h"], "n", lines.count())
    dropped = found.where(~F.col("doc").eqNullSafe(F.col("keeper"))).select("doc", "t", "at").distinct()
    return dropped.groupBy("doc", "t").agg(F.array_sort(F.collect_list("at")).alias("places"))


def with_places(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Left join of rows (doc, t, ...) with their places; very often repeated rows take a broadcast."""
    same = [F.col("doc").eqNullSafe(F.col("doc_p")), F.col("t") == F.col("t_p")]
    renamed = places.withColumnsRenamed({"doc": "doc_p", "t": "t_p"})
    sizes = rows.groupBy("doc", "t").agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("n")).first().n
    hot = settled(sizes.where(F.col("n") > max(1, total // HOT_SHARE)).select("doc", "t"))
    if hot.isEmpty():
        return rows.join(renamed, same, "left").drop("doc_p", "t_p")
    hot = F.broadcast(hot.withColumnsRenamed({"doc": "doc_p", "t": "t_p"}))
    often = rows.join(hot, same, "left_semi")
    of_often = places.join(hot, same, "left_semi").withColumnsRenamed({"doc": "doc_p", "t": "t_p"})
    rest = rows.join(hot, same, "left_anti")
    return often.join(F.broadcast(of_often), same, "left").unionByName(rest.join(renamed, same, "left")).drop("doc_p", "t_p")


def without_shared_lines(docs: DataFrame, key: str = "doc_id", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`row` (struct of all columns of `docs`), kept_text, n_lines (before dropping), n_dropped."""
    places = settled(dropped_places(keyed_lines(docs.select(key, "text"), key, min_chars), min_docs))
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64("text").alias("t"), F.struct("*").alias("row"))
    none = F.array().cast("array<int>")

    def kept(lines: Column) -> Column:
        staying = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("places", none))
        text = F.array_join(F.transform(staying, lambda at: F.get(lines, at)), "\n")
        return F.struct(text.alias("text"), F.size(lines).cast("bigint").alias("n"))

    text = whole_text(F.col("row").getField("text"))
    found = with_places(rows, places).select(
        "row", F.size(F.coalesce("places", none)).cast("bigint").alias("n_dropped"),
        let(F.split(text, "\n"), kept).alias("kept"),
    )
    return found.select("row", F.col("kept.text").alias("kept_text"), F.col("kept.n").alias("n_lines"), "n_dropped")


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256: one row for each row of `docs`."""
    found = without_shared_lines(docs.select("doc_id", "text"), **options)
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
