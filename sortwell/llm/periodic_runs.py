"""Periodic runs: stretches of words that repeat with a period, and texts without the repeats.

A run is a stretch with smallest period q (words q apart are identical) and a length of at least
max(`LEAST`, `TIMES` * q) words that cannot be extended with this period. All of them are found.

* **Tiles.** A document is exploded into overlapping tiles for every octave of periods: for periods
  from S to 2S - 1 (the first octave: 1 to 15, with S = 8) the places are cut into cells of S words. A
  tile owns `CELLS` cells and holds one cell before and three after them, so an octave takes twice the
  words, whatever the length of the document. The words that equal the word q places on, one after
  another, are at least 2q long in a run, so they cover a whole cell. Only tiles with a cell that may
  repeat at a distance of the octave become rows; hashes of all windows of S words, made from those of
  the octave before, tell that by one comparison a word.
* **Boundary Z-functions.** A tile is solved without its neighbours. The Z-function from the left end
  of a cell gives for all periods at once how far the cell and what follows repeats, that of the
  reversed words before it how far the repeat reaches back. A cell that repeats whole gives a
  fragment (period, first and last place). Words are compared, not hashes, so a tile that was kept by
  a collision gives nothing. A period is left out where the first q words are themselves a repetition
  (the Z-function shows that too), so the fragments of all periods grow with the number of words.
* **Stitching.** Fragments are shuffled by document and period and joined where they touch.

Tiles are dealt over all tasks by document, octave and place, so one very long document keeps many
tasks busy. Texts stay where they are: a document without tiles is finished in the scan, the text of
one with tiles is kept in the table that is written to the shared folder and joined with its runs. Rows
are told apart by a number of their own, so copies, however many, don't meet in one task.

A document's words and the largest tile, which is of the same order, have to fit in a task.

Defined results: a null or empty text has no words and no runs; rows that repeat an id or a text are
searched one by one; equal ratios of length and period are ordered by start, then period. Only the id
and the text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.llm.common import let, shared_folder, whole_text

LEAST = 24
TIMES = 3
SMALLEST_CELL = 8
CELLS = 4
# Words of tiles, or characters of texts, in one Arrow batch.
BATCH_SIZE = 1 << 20
# Words of tiles that a task solves.
TASK_WORDS = 1 << 21
# Odd numbers that spread the bits of a hash.
SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def numbered(words: list) -> np.ndarray:
    """Words as numbers, equal ones alike."""
    known: dict = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int32)


def octaves(n: int) -> Iterator[int]:
    """Cell sizes of the octaves whose shortest run fits into n words."""
    size = SMALLEST_CELL
    if n >= LEAST:
        yield size
        size *= 2
        while TIMES * size <= n:
            yield size
            size *= 2


def periods(size: int) -> tuple[int, int]:
    """First period of an octave and the one after its last."""
    return (1 if size == SMALLEST_CELL else size), 2 * size


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of 2 * size words from those of `size` words."""
    mixed = hashes[:-size] * SPREAD[0] + (hashes[size:] ^ (hashes[size:] >> np.uint64(29))) * SPREAD[1]
    return mixed ^ (mixed >> np.uint64(32))


def promising(hashes: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the cells that may repeat at a distance of the octave, from the hashes of all windows."""
    rows = -(-len(hashes) // size)
    table = np.zeros(rows * size, dtype=np.uint64)
    table[: len(hashes)] = hashes
    table = table.reshape(rows, size)
    first = table[:, :1]
    found = np.zeros(rows, dtype=bool)
    found[:-1] = (table[1:] == first[:-1]).any(axis=1)
    if size == SMALLEST_CELL:
        found |= (table[:, 1:] == first).any(axis=1)
    return np.flatnonzero(found)


def tiles(words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(cell size, first place of its first own cell, words) of every tile that may hold a fragment."""
    n = len(words)
    hashes, window = (words.astype(np.uint64) + np.uint64(1)) * SPREAD[2], 1
    for size in octaves(n):
        while window < size:
            hashes, window = doubled(hashes, window), 2 * window
        for tile in np.unique(promising(hashes, size) // CELLS).tolist():
            own = tile * CELLS * size
            yield size, own, words[max(0, own - size) : own + (CELLS + 3) * size]


def z_function(s: list) -> list[int]:
    """For every place, how many items from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def repeated(z: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of the periods `found` are multiples of a period that their first words have already."""
    d = np.arange(1, int(found.max()) // 2 + 1)
    # A divisor d of q is such a period if d + z[d] >= q, and q is 2d or more and one of those found.
    d = d[d + z[d] >= np.maximum(2 * d, found.min())]
    out = np.zeros(len(found), dtype=bool)
    while len(d):
        least = int(d[0])
        out |= (found % least == 0) & (found > least) & (least + z[least] >= found)
        # What a multiple of it shows, it shows as well, unless the multiple reaches further.
        d = d[(d % least != 0) | (d + z[d] > least + z[least])]
    return out


def fragments(size: int, own: int, words: list) -> Iterator[tuple[int, int, int]]:
    """(period, low, high): places low to high - 1 equal the places a period on, and whole cells of the
    tile lie among them. Reaches at most one cell beyond a whole cell on either side."""
    first, end = periods(size)
    before = min(own, size)
    for cell in range(CELLS):
        at = before + cell * size
        ahead = words[at : at + 4 * size]
        if len(ahead) < size + first:
            return
        z = np.array(z_function(ahead), dtype=np.int64)
        found = np.arange(first, min(end, len(ahead)))
        found = found[z[found] >= size]
        if not len(found):
            continue
        found = found[~repeated(z, found)]
        back = words[max(0, at - size) : at][::-1]
        around = words[max(0, at - size) : at + 2 * size][::-1]
        # No word is -1, so nothing matches across it.
        reach = z_function([*back, -1, *around])
        last = len(back) + 1 + len(around)
        place = own + cell * size
        for q in found.tolist():
            # The word before the repeat of the cell, place at + q - 1, is counted from the end of `around`.
            i = last - (q + min(at, size))
            behind = min(reach[i], size) if back else 0
            yield q, place - behind, place + min(int(z[q]), 2 * size)


def batched(rows, schema: pa.Schema, size_of) -> Iterator[pa.RecordBatch]:
    own, size = [], 0
    for row in rows:
        own.append(row)
        size += 50 + size_of(row)
        if size >= BATCH_SIZE:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*own), schema)], schema=schema)
            own, size = [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*own), schema)], schema=schema)


def tiled(docs: DataFrame, key: str) -> DataFrame:
    """Written to the shared folder. One row per document (size null): rid, id, n_words, the text if it
    has tiles, else the checksum of its words; and one per tile: rid, size, own, words."""
    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("id"), "text")

    def run(stream):
        for batch in stream:
            id_type_here = batch.schema.field("id").type
            schema = pa.schema([("rid", pa.int64()), ("id", id_type_here), ("n_words", pa.int64()), ("text", pa.string()),
                                ("sha", pa.string()), ("size", pa.int64()), ("own", pa.int64()), ("words", pa.list_(pa.int32()))])

            def found():
                for rid, number, text in zip(*(batch.column(i) for i in range(3))):
                    text = text.as_py() or ""
                    words = text.encode().split()
                    any_tile = False
                    for size, own, part in tiles(numbered(words)):
                        any_tile = True
                        yield rid.as_py(), None, None, None, None, size, own, part
                    sha = None if any_tile else hashlib.sha256(b" ".join(words)).hexdigest()
                    yield rid.as_py(), number.as_py(), len(words), text if any_tile else None, sha, None, None, None

            yield from batched(found(), schema, lambda r: len(r[3] or "") + (0 if r[7] is None else len(r[7])))

    schema = f"rid bigint, id {id_type}, n_words bigint, text string, sha string, size bigint, own bigint, words array<int>"
    folder = shared_folder(docs.sparkSession, "period-tiles")
    rows.mapInArrow(run, schema).write.parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def solved(tile_rows: DataFrame) -> DataFrame:
    """rid, period, low, high of all fragments. Tiles are dealt over as many tasks as their words need:
    the bytes of their shuffle say little about the work."""
    words = tile_rows.agg(F.sum("size")).first()[0] or 0
    tasks = max(tile_rows.sparkSession.sparkContext.defaultParallelism, (CELLS + 4) * words // TASK_WORDS)
    schema = pa.schema([("rid", pa.int64()), ("period", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

    def run(stream):
        for batch in stream:
            def found():
                for rid, size, own, words in zip(*(batch.column(i) for i in range(4))):
                    for row in fragments(size.as_py(), own.as_py(), words.values.to_numpy().tolist()):
                        yield rid.as_py(), *row

            yield from batched(found(), schema, lambda r: 0)

    return tile_rows.repartition(tasks, "rid", "size", "own").mapInArrow(run, "rid bigint, period bigint, low bigint, high bigint")


def stitched(found: DataFrame) -> DataFrame:
    """rid, start, length, period of every run."""
    upto = Window.partitionBy("rid", "period").orderBy("low", "high")
    before = F.max("high").over(upto.rowsBetween(Window.unboundedPreceding, -1))
    starts = found.withColumn("new", F.when(F.col("low") > before, 1).otherwise(0))
    joined = starts.withColumn("part", F.sum("new").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("rid", "period", "part").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    runs = whole.select("rid", "start", (F.col("high") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """`words` without those that some run holds after its first period."""
    out, at = [], 0
    for low, high in sorted((start + period, start + length) for start, length, period in runs):
        if low > at:
            out += words[at:low]
        at = max(at, high)
    return out + words[at:]


def periodic_runs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period), collapsed (words that stay, joined by one
    space; null where no word goes) and collapsed_sha256: one row for each row of `docs`."""
    rows = tiled(docs, key)
    runs = stitched(solved(rows.where("size is not null").select("rid", "size", "own", "words")))
    by_start = F.array_sort(F.collect_list(F.struct("start", "period", "length")))
    per_row = runs.groupBy("rid").agg(F.transform(by_start, lambda r: F.struct(r["start"], r["length"], r["period"])).alias("runs"))
    # Only rows with tiles can have runs, so the others don't move.
    own = rows.where("size is null").select("rid", "id", "n_words", "text", "sha")
    id_type = own.schema["id"].dataType.simpleString()
    none = F.array().cast(f"array<{RUN}>")
    found = own.where("sha is null").select("rid", "id", "n_words", "text").join(per_row, "rid", "left").select(
        "id", "n_words", F.coalesce("runs", none).alias("runs"), "text"
    )

    def collapse(stream):
        for batch in stream:
            texts, hashes = [], []
            for runs, text in zip(batch.column(2), batch.column(3)):
                words = text.as_py().encode().split()
                found = [(r["start"], r["length"], r["period"]) for r in runs.as_py()]
                kept = b" ".join(kept_words(words, found))
                texts.append(kept.decode() if found else None)
                hashes.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(texts, pa.string()), pa.array(hashes, pa.string())],
                names=["id", "n_words", "runs", "collapsed", "collapsed_sha256"],
            )

    schema = f"id {id_type}, n_words bigint, runs array<{RUN}>, collapsed string, collapsed_sha256 string"
    plain = own.where("sha is not null").select(
        "id", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("sha").alias("collapsed_sha256")
    )
    return found.mapInArrow(collapse, schema).unionByName(plain)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text, the words of a tenth of the documents repeated from some place on.

    With h the checksum of the id and g = floor(h / 10), word i >= a becomes word a + (i - a) % p where
    a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), if h % 10 = 0 and there are n > 0 words.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def changed(words: Column) -> Column:
        n = F.size(words)
        g = F.floor(h / 10)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = F.lit(1) + F.floor((n - a) / (3 + g % 8)).cast("int")
        copies = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(
            F.slice(words, F.lit(1), a), F.slice(F.flatten(copies), F.lit(1), n - a)), " ")).otherwise("")

    words = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    planted = F.when((h % 10 == 0) & F.col("text").isNotNull(), let(words, changed)).otherwise(F.col("text"))
    return docs.select("doc_id", planted.alias("text"))


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run with the greatest ratio of length to period, and the checksums."""
    found = periodic_runs(with_planted_period(docs))

    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        tie = F.when(F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"]), -1).otherwise(1)
        return F.when(left > right, -1).when(left < right, 1).otherwise(tie)

    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    text = F.array_join(F.transform("runs", line), "")
    best = F.get(F.array_sort("runs", order), F.lit(0))
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
        F.sha2(text, 256).alias("runs_sha256"), F.col("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
