"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and all 1- to 3-grams are hashed
to `2**bits` features. Counting runs over every labelled row in Spark: tasks add up one count
matrix each and hand it on in slices, which are summed by (language, slice). The log-probability
matrix has a fixed number of columns and one row per language (at most `MAX_LANGS`, checked), so it
is broadcast; scoring adds its columns up over the sparse n-gram occurrences of a batch.

Defined results: null text or text without a letter gives `und` with score 0, and so does every
text when nothing is labelled; ties go to the first language in order. A repeated row is scored
twice. Only doc_id, text and, for training, lang are read, so further columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import MERGED_TASKS, held_out, lean

ORDERS = (1, 2, 3)
BITS = 16
SLICE = 4096
MAX_LANGS = 256
# Code points handled at once; bounds the temporaries of a task.
WINDOW = 1 << 19


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Index ranges of at most WINDOW characters, or one text."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > WINDOW:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def prepared(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with spaces for all but letters, and each text's start.

    A zero follows every text; no n-gram holds one.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer(
        ("\0".join(low) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32
    )
    lengths = np.fromiter(map(len, low), dtype=np.int64, count=len(low)) + 1
    points = np.where(letters()[points], points, np.uint32(32))
    ends = np.cumsum(lengths)
    points[ends - 1] = 0
    return points, ends - lengths


def gram_hashes(points: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Start positions and feature numbers of the n-grams of each order, window by window."""
    longest = max(ORDERS)
    for at in range(0, len(points), WINDOW):
        part = points[at : at + WINDOW + longest - 1]
        blank, end = part == 32, part == 0
        value = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, longest + 1):
            size = min(WINDOW, len(part) - n + 1)
            if size <= 0:
                break
            value = value[:size] * np.uint32(0x01000193) + part[n - 1 : n - 1 + size]
            last = slice(n - 1, n - 1 + size)
            if n == 1:
                bad, skipped = end[:size], blank[:size] | end[:size]  # a lone space tells nothing
            else:
                bad = skipped = bad[:size] | end[last] | (blank[n - 2 : n - 2 + size] & blank[last])
            if n in ORDERS:
                starts = np.flatnonzero(~skipped)
                mixed = (value[starts] ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                mixed ^= mixed >> np.uint32(15)
                yield starts + at, (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)


def train(docs: DataFrame, label: str = "lang", bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix (feature, language) of smoothed log probabilities, priors last.

    `docs` has text and the label; rows with a null in either are not learned from.
    """
    width = 1 << bits

    def count(stream):
        sums: dict[str, np.ndarray] = {}
        for batch in stream:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                total = sums.setdefault(lang, np.zeros(width + 1, dtype=np.int64))
                total[width] += len(own)
                for i, j in batches(own):
                    for _, hashed in gram_hashes(prepared(own[i:j])[0], bits):
                        total[:width] += np.bincount(hashed, minlength=width)
        rows = [
            (lang, k, total[k * SLICE : (k + 1) * SLICE].tobytes())
            for lang, total in sums.items()
            for k in range(-(-len(total) // SLICE))
            if total[k * SLICE : (k + 1) * SLICE].any()
        ]
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()),
                 pa.array([TaskContext.get().partitionId() // MERGED_TASKS] * len(rows), pa.int32()), pa.array(columns[2], pa.binary())],
                names=["lang", "slice", "part", "counts"],
            )

    def add(key, table):
        total = sum(np.frombuffer(x.as_buffer(), dtype=np.int64) for x in table.column("counts"))
        return pa.table({"lang": [key[0].as_py()], "slice": pa.array([key[1].as_py()], pa.int32()),
                         "part": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    # Tasks' counts are added up in two steps, so a group holds a bounded number of them.
    schema = "lang string, slice int, part int, counts binary"
    known = docs.where(F.col("text").isNotNull() & F.col(label).isNotNull())
    counted = known.select("text", F.col(label).cast("string")).mapInArrow(lean(count), schema)
    summed = counted.groupBy("lang", "slice", "part").applyInArrow(add, schema).groupBy("lang", "slice").applyInArrow(add, schema)
    # Bounded: `2**bits` features for each of at most MAX_LANGS languages, checked on the way.
    totals: dict[str, np.ndarray] = {}
    for row in summed.toLocalIterator():
        if row.lang not in totals and len(totals) == MAX_LANGS:
            raise ValueError(f"more than {MAX_LANGS} languages in column {label}")
        total = totals.setdefault(row.lang, np.zeros(width + 1, dtype=np.int64))
        part = np.frombuffer(row.counts, dtype=np.int64)
        total[row.slice * SLICE : row.slice * SLICE + len(part)] = part
    langs = sorted(totals)
    if not langs:
        return [], np.zeros((width + 1, 0))
    counts = np.stack([totals[x] for x in langs], axis=1).astype(np.float64)
    matrix = np.empty_like(counts)
    matrix[:width] = np.log((counts[:width] + 0.5) / (counts[:width].sum(axis=0) + 0.5 * width))
    matrix[width] = np.log(counts[width] / counts[width].sum())
    return langs, matrix


def score_texts(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    width = matrix.shape[0] - 1
    bits = width.bit_length() - 1
    found, scores = ["und"] * len(texts), np.zeros(len(texts))
    whole = [t or "" for t in texts]
    for i, j in batches(whole):
        points, starts = prepared(whole[i:j])
        logs = np.zeros((j - i, len(langs)))
        grams = np.zeros(j - i, dtype=np.int64)
        for at, hashed in gram_hashes(points, bits):
            if not len(at):
                continue
            # Sparse rows: consecutive occurrences of one text are added up.
            row = np.searchsorted(starts, at, side="right") - 1 if j - i > 1 else np.zeros(len(at), dtype=np.int64)
            first = np.flatnonzero(np.diff(row, prepend=-1))
            step = max(1, WINDOW * 4 // max(1, len(langs)))
            for k in range(0, len(at), step):
                cut = first[(first > k) & (first < k + step)]
                heads = np.concatenate(([k], cut))
                sums = np.add.reduceat(matrix[hashed[k : k + step]], heads - k, axis=0)
                np.add.at(logs, row[heads], sums)
            np.add.at(grams, row[first], np.diff(np.append(first, len(at))))
        if langs:
            logs += matrix[width]
            best = logs.argmax(axis=1)
            posterior = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for k in np.flatnonzero(grams):
                found[i + k], scores[i + k] = langs[best[k]], posterior[k]
    return found, scores


def identify(docs: DataFrame, langs: list[str], matrix: np.ndarray, key: str = "doc_id") -> DataFrame:
    """key, lang_pred, score for every row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix.astype(np.float64)))
    key_type = docs.schema[key].dataType

    def score(stream):
        for batch in stream:
            found, scores = score_texts(batch.column(1).to_pylist(), *model.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=[key, "lang_pred", "score"],
            )

    return docs.select(key, "text").mapInArrow(
        lean(score), f"`{key}` {key_type.simpleString()}, lang_pred string, score double"
    )


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, with a model from the rows that are not held out."""
    langs, matrix = train(docs.where(~held_out("doc_id")).select("text", "lang"))
    return identify(docs, langs, matrix).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows whose language is recognised with at least `min_score`, with their own columns."""
    langs, matrix = train(docs.where(~held_out("doc_id")).select("text", "lang"))
    model = docs.sparkSession.sparkContext.broadcast((langs, matrix))

    def keep(stream):
        for batch in stream:
            found, scores = score_texts(batch.column(batch.schema.get_field_index("text")).to_pylist(), *model.value)
            mask = [lang != "und" and score >= min_score for lang, score in zip(found, scores)]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
