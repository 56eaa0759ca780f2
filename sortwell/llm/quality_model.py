"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: character 1- to 3-grams as they stand, 1- to
5-grams of character classes (upper, lower, digit, space, others as they are), and 1- to 3-grams of
words that only tell whether a word repeats the one before, with the share of such words. Indicators
are scaled by the log ratio of class counts, and a linear hinge-loss model is fitted on them by dual
coordinate descent (Hsieh et al. 2008; Wang and Manning 2012). Margins become probabilities by a
logistic curve through margins of folds that were not fitted on.

The model is fitted in the driver on at most `MAX_SAMPLE` labelled rows, those with the smallest
checksums; the sample's ids are broadcast under that bound. Weights have `2**BITS` entries whatever
the data. Scoring reads every text whole.

Defined results: a null text or one without words gets score 0; without labels of both classes
every other text gets the share of label 1, or 0.5. Repeated rows are scored one by one. Rows with a
null id are never learned from. Of documents only doc_id and text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import held_out

BITS = 15
MAX_SAMPLE = 6_000
FOLDS = 3
EPOCHS = 25
COST = 1.0
THRESHOLD = 0.7
PIECE = 1 << 19
SPACES = np.array([32, 9, 10, 11, 12, 13], dtype=np.uint32)


def class_codes(points: np.ndarray) -> np.ndarray:
    """Code points with letters, digits and white space replaced by one stand-in each."""
    codes = points.copy()
    high = points >= 128
    lower = (points >= 97) & (points <= 122)
    upper = (points >= 65) & (points <= 90)
    # Latin letters of two cases; anything else beyond ASCII counts as lower case.
    upper |= high & (points >= 0xC0) & (points <= 0xDE)
    codes[lower | (high & ~upper)] = 97
    codes[upper] = 65
    codes[(points >= 48) & (points <= 57)] = 48
    codes[np.isin(points, SPACES)] = 32
    return codes


def mark(seen: np.ndarray, codes: np.ndarray, orders: int, salt: int) -> None:
    """Set the features of all n-grams up to `orders`, piece by piece."""
    bits = np.uint32(32 - (len(seen).bit_length() - 1))
    for at in range(0, len(codes), PIECE):
        part = codes[at : at + PIECE + orders - 1]
        value = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, orders + 1):
            size = min(PIECE, len(part) - n + 1)
            if size <= 0:
                break
            value = value[:size] * np.uint32(0x01000193) + part[n - 1 : n - 1 + size]
            mixed = (value ^ np.uint32((salt * 31 + n) * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            mixed ^= mixed >> np.uint32(15)
            seen[(mixed * np.uint32(0xC2B2AE35)) >> bits] = True


def features(text: str, seen: np.ndarray) -> np.ndarray:
    """Feature numbers of a text; `seen` is a cleared work table of all features."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    words = text.split()
    if not words:
        return np.zeros(0, dtype=np.int32)
    mark(seen, points, 3, 1)
    mark(seen, class_codes(points), 5, 2)
    hashes = np.fromiter(map(hash_of, words), dtype=np.int64, count=len(words))
    again = np.concatenate(([0], hashes[1:] == hashes[:-1])).astype(np.uint32) + 1
    mark(seen, again, 3, 3)
    share = int(10 * (again == 2).mean())
    mark(seen, np.arange(share + 1, dtype=np.uint32), 1, 4)
    found = np.flatnonzero(seen).astype(np.int32)
    seen[found] = False
    return found


def hash_of(word: str) -> int:
    return hash(word)  # only compared within one text


def feature_rows(docs: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """`columns` of docs and the features of `text` as 32-bit numbers in one binary."""
    schema = docs.select(*columns).schema

    def run(stream):
        seen = np.zeros(1 << bits, dtype=bool)
        at = len(columns)
        for batch in stream:
            found = [features(t or "", seen).tobytes() for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array(found, pa.binary())], names=[*columns, "features"]
            )

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", features binary"
    return docs.select(*columns, "text").mapInArrow(run, ddl)


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, width: int) -> np.ndarray:
    """Log ratio of the smoothed shares of each feature among rows of label 1 and the others."""
    counts = np.ones((2, width))
    for found, label in zip(rows, labels):
        counts[int(label > 0), found] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(rows: list[np.ndarray], labels: np.ndarray, width: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model, by dual coordinate descent.

    Rows count with weights that balance the classes. Returned weights are for plain indicators: the
    log ratios are multiplied in.
    """
    ratio = log_ratios(rows, labels, width)
    w, bias = np.zeros(width), 0.0
    alpha = np.zeros(len(rows))
    share = (labels > 0).mean()
    upper = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)) * COST
    values = [ratio[found] for found in rows]
    values = [x / max(np.linalg.norm(x), 1e-9) for x in values]
    norm = 2.0  # rows have length 1, and 1 for the bias
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            found, x, y = rows[i], values[i], labels[i]
            slope = y * (w[found] @ x + bias) - 1
            new = min(max(alpha[i] - slope / norm, 0.0), upper[i])
            step = (new - alpha[i]) * y
            if step:
                alpha[i] = new
                w[found] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w * ratio, bias, ratio


def margin(found: np.ndarray, model: tuple[np.ndarray, float, np.ndarray]) -> float:
    w, bias, ratio = model
    return float(w[found].sum() / max(np.linalg.norm(ratio[found]), 1e-9) + bias)


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps with smoothed targets."""
    up, down = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -40, 40)))
        weight = np.maximum(p * (1 - p), 1e-9)
        slope = np.array([((p - target) * margins).sum() + 1e-6 * a, (p - target).sum()])
        curve = np.array([[(weight * margins**2).sum() + 1e-6, (weight * margins).sum()], [(weight * margins).sum(), weight.sum() + 1e-6]])
        step = np.linalg.solve(curve, slope)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = MAX_SAMPLE, bits: int = BITS):
    """(model, slope, offset), or the share of label 1 where one class is missing.

    At most `sample` rows reach the driver, whatever repeats: of several labels of one id the smallest
    counts, of several texts the one with the smallest hash.
    """
    known = labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    order = F.crc32(F.concat(F.lit("sample:"), F.col("doc_id").cast("string")).cast("binary"))
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y"))
    chosen = known.select(F.col("doc_id").alias("labelled_id"), "y", order.alias("o"))
    chosen = chosen.orderBy("o", "labelled_id", "y").limit(sample).select("labelled_id", "y")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    texts = texts.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first"))
    texts = texts.select("doc_id", "y", "first.text")
    rows, ys = [], []
    for row in feature_rows(texts, ["y", "doc_id"], bits).orderBy("doc_id").toLocalIterator():
        rows.append(np.frombuffer(row.features, dtype=np.int32))
        ys.append(1.0 if row.y == 1 else -1.0)
    y = np.array(ys)
    if min((y > 0).sum(), (y < 0).sum()) < FOLDS:
        return float((y > 0).mean()) if len(y) else 0.5
    folds = np.zeros(len(y), dtype=int)
    for sign in (1, -1):  # every fold gets its part of both classes
        own = np.flatnonzero(y == sign)
        folds[own] = np.arange(len(own)) % FOLDS
    margins = np.zeros(len(y))
    for k in range(FOLDS):
        inside = np.flatnonzero(folds != k)
        model = descend([rows[i] for i in inside], y[inside], 1 << bits)
        for i in np.flatnonzero(folds == k):
            margins[i] = margin(rows[i], model)
    return descend(rows, y, 1 << bits), *logistic_curve(margins, y)


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = MAX_SAMPLE,
                   bits: int = BITS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""
    fitted = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, sample, bits))
    key_type = docs.schema["doc_id"].dataType

    def run(stream):
        seen = np.zeros(1 << bits, dtype=bool)
        for batch in stream:
            scores = []
            for text in batch.column(1).to_pylist():
                found = features(text or "", seen)
                if not len(found):
                    scores.append(0.0)
                elif isinstance(fitted.value, float):
                    scores.append(fitted.value)
                else:
                    model, slope, offset = fitted.value
                    scores.append(1 / (1 + math.exp(-max(-40.0, min(40.0, slope * margin(found, model) + offset)))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key_type.simpleString()}, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
