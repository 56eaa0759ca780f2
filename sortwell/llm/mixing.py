"""Mixing sources to target weights by a Pfair schedule of their blocks.

Every source is put in a reproducible order and cut into blocks of `block_rows` documents. With
weight w (a share of all slots), block j of a source is released at slot floor(j / w) and due at
slot ceil((j + 1) / w). Serving the released block with the earliest deadline in every slot keeps
each source within less than one block of its share at every slot. Weights are whole numbers out of
`UNITS`, or exact where their ratios have smaller terms, so nothing adds up over a long input: the
schedule runs over all blocks there are, one heap step a block, and repeats nothing. All rows stay:
a source that ends leaves its later slots empty, and the others keep their pace. A source of weight
0 comes after all others.

The driver works the schedule out in pieces of `PIECE` blocks. Up to `MAX_BROADCAST_BLOCKS` blocks
(32 rows each) it is broadcast; a longer one goes to the shared folder piece by piece and is joined.

Numbering inside a source is spread out: documents are dealt by hash into buckets, bucket sizes are
added up per source, and rows are numbered inside their bucket only. The key of the hash is doc_id;
it should be unique, as rows that share an id share a bucket.

Defined results: a null source is a source of its own; rows with a null id share one place in the
order of their source; repeated rows get places of their own. An empty table gives an empty result. The columns of
`docs` are carried in one struct, so none of them can clash.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.llm.common import shared_folder
from sortwell.session import small_table

MAX_SOURCES = 10_000
UNITS = 1 << 53
BLOCK_ROWS = 32
PIECE = 1 << 18
MAX_BROADCAST_BLOCKS = 1 << 19
LAST_SLOT = (1 << 63) - 1


def slots_of(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots per period by largest remainder. A weight above 0 gets one slot at least, taken
    from the source with most slots."""
    total = sum(Fraction(w) for w in weights.values())
    exact = {s: Fraction(w) * period / total for s, w in weights.items()}
    slots = {s: int(x) for s, x in exact.items()}
    left = period - sum(slots.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:left]:
        slots[s] += 1
    for s in sorted(slots):
        if exact[s] and not slots[s]:
            slots[max(slots, key=lambda x: (slots[x], x))] -= 1
            slots[s] = 1
    return slots


def units_of(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers: in their own ratios if their sum is at most `UNITS`, else out
    of `UNITS`, which is as fine as the weights themselves."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[w.denominator for w in exact.values()])
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    if sum(whole.values()) <= UNITS * common:
        return {s: n // common for s, n in whole.items()}
    return slots_of(weights, UNITS)


def pfair_blocks(units: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, index, release, deadline, slot) of all `blocks`: earliest deadline first among
    released blocks, ties by source. A slot that no block is released for stays empty."""
    total = sum(units.values())
    waiting = [(0, s, 0) for s in sorted(blocks) if blocks[s] and units[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    slot = 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            release, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * total // units[s]), s, i, release))
        deadline, s, i, release = heapq.heappop(ready)
        yield s, i, release, deadline, slot
        slot += 1
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * total // units[s], s, i + 1))
    end = slot
    for s in sorted(blocks):
        for i in range(blocks[s] if units[s] else 0, blocks[s]):
            yield s, i, end, slot + 1, slot
            slot += 1


def pfair_period(slots: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """The blocks of one period, in which every source has `slots` blocks."""
    return list(pfair_blocks(slots, slots))


def schedule(spark: SparkSession, units: dict[str, int], blocks: dict[str, int]) -> DataFrame:
    """s, block, r, d, t: release, deadline and slot of every block."""
    ddl = "s string, block bigint, r bigint, d bigint, t bigint"

    def checked() -> Iterator[tuple[str, int, int, int, int]]:
        for row in pfair_blocks(units, blocks):
            if row[3] > LAST_SLOT:
                raise ValueError(f"the weight of {row[0]} is too small for {blocks[row[0]]} blocks")
            yield row

    rows = checked()
    if sum(blocks.values()) <= MAX_BROADCAST_BLOCKS:
        return F.broadcast(small_table(spark, list(rows), ddl))
    folder = shared_folder(spark, "mixing-schedule")
    while piece := list(itertools.islice(rows, PIECE)):
        small_table(spark, piece, ddl).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.schema(ddl).parquet(folder)


def source_key(source: str):
    return F.when(F.col(source).isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))


def pfair_slots(docs: DataFrame, weights: dict[str | None, float] | None = None, key: str = "doc_id",
                source: str = "source", block_rows: int = BLOCK_ROWS, smoothing: float = 0.5,
                seed: int = 7) -> DataFrame:
    """`row` (struct of all columns of `docs`), block, place, slots, period, release, deadline, slot.

    `weights` gives target shares per source; sources it does not name are an error. Without it
    the weight is the source's row count to the power `smoothing`. The weight in use is slots /
    period. Sorting by (slot, place) gives the mix.
    """
    spark = docs.sparkSession
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    rows = docs.select(
        F.struct("*").alias("row"), source_key(source).alias("s"), F.col(key).alias("id"), order.alias("o")
    )
    sizes = {r.s: r.n for r in rows.groupBy("s").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    if weights is None:
        share = {s: n**smoothing for s, n in sizes.items()}
    else:
        given = {"null" if s is None else f"={s}": w for s, w in weights.items()}
        if missing := sorted(set(sizes) - set(given)):
            raise ValueError(f"no weight for {missing[:5]}")
        share = {s: given[s] for s in sizes}
        if wrong := sorted(s for s, w in share.items() if not 0 <= w < math.inf):
            raise ValueError(f"no share of slots: weight of {wrong[:5]}")
        if share and not any(share.values()):
            raise ValueError("no weight above 0")
    units = units_of(share) if share else {}
    table = schedule(spark, units, {s: -(-n // block_rows) for s, n in sizes.items()})
    # About 500 rows a bucket, and never more than 65,536 buckets a source.
    digits = min(4, max(1, -(-(max(1, sum(sizes.values()) // 512)).bit_length() // 4)))
    rows = rows.withColumn("bucket", F.substring("o", 1, digits))
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("s", "bucket").agg(F.count("*").alias("n")).select(
        "s", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = Window.partitionBy("s", "bucket").orderBy(F.col("id").isNotNull(), "o", "id")
    numbered = rows.withColumn("k", F.row_number().over(inside) - 1).join(starts, ["s", "bucket"])
    number = F.col("start") + F.col("k")
    blocks = numbered.select(
        "row", "s", (F.floor(number / block_rows)).alias("block"), (number % block_rows).alias("place")
    )
    widths = small_table(spark, list(units.items()), "s string, w bigint")
    return blocks.join(F.broadcast(widths), "s").join(table, ["s", "block"]).select(
        "row", "block", "place", F.col("w").alias("slots"), F.lit(sum(units.values())).cast("bigint").alias("period"),
        F.col("r").alias("release"), F.col("d").alias("deadline"), F.col("t").alias("slot"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` in the order of the mix, over range partitions."""
    found = pfair_slots(docs, **options)
    return found.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select("row.*")


def mixing_plan(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source and each document's block, place, release, deadline and slot."""
    found = pfair_slots(docs.select("doc_id", "source"), **options)
    return found.select("row.doc_id", "row.source", "block", "place", "slots", "period", "release", "deadline", "slot")
