"""Spans of patterns in whole texts, as DataFrame functions.

A text is searched in its row; what leaves the row are the matches and the lengths of the gaps
between them. Places are running sums over these, per row and kind, so a text with very many
matches costs no more per match than another. Places are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.llm.common import settled, whole_text

# Characters kept on either side of a match as its context.
CONTEXT = 24


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    base: bool = True


def matches(text: Column, number: int, kind: Kind) -> Column:
    """Array of (kind, i, gap, match, before, after): every match with the gap before it."""
    pattern = F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.arrays_zip(
        gaps.alias("gap"), found.alias("match"), F.slice(gaps, 2, 1 << 30).alias("next")
    )

    def entry(x: Column, i: Column) -> Column:
        return F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["match"].alias("match"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["next"], F.lit(CONTEXT)).alias("after"),
        )

    whole = F.filter(F.transform(pairs, entry), lambda x: x["match"].isNotNull())
    return F.when(text.rlike(kind.pattern), whole).otherwise(F.array().cast(whole_type()))


def whole_type() -> str:
    return "array<struct<kind:int,i:int,gap:int,match:string,before:string,after:string>>"


def found_rows(docs: DataFrame, kinds: list[Kind], key: str = "doc_id") -> DataFrame:
    """rid, key, found: one settled row per row of `docs`, without its text."""
    text = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), whole_text().alias("text"))
    found = F.concat(*[matches(F.col("text"), n, kind) for n, kind in enumerate(kinds)])
    return settled(text.select("rid", "key", found.alias("found")))


def located(rows: DataFrame) -> DataFrame:
    """rid, kind, start, end, match, before, after for every match."""
    flat = rows.where(F.size("found") > 0).select("rid", F.explode("found").alias("x")).select("rid", "x.*")
    upto = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    end = F.sum((F.col("gap") + size).cast("bigint")).over(upto)
    return flat.select("rid", "kind", end.alias("end"), "match", "before", "after").withColumn(
        "start", F.col("end") - F.length("match")
    )


def digests(rows: DataFrame, spans: DataFrame, kinds: list[Kind]) -> DataFrame:
    """key, a count for each base kind, base_sha256 and spans for every row.

    `spans` has rid, kind, start and end of what counts.
    """
    names = F.array(*[F.lit(k.name) for k in kinds])
    base = [n for n, k in enumerate(kinds) if k.base]

    def joined(of: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(of), lambda s: F.concat_ws(
            ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    entry = F.struct("start", "kind", "end")
    per_row = spans.groupBy("rid").agg(
        *[F.count_if(F.col("kind") == n).alias(f"n_{kinds[n].name}") for n in base],
        F.collect_list(F.when(F.col("kind").isin(base), entry)).alias("base"),
        F.collect_list(entry).alias("all"),
    )
    found = rows.select("rid", "key").join(per_row, "rid", "left")
    return found.select(
        "key",
        *[F.coalesce(f"n_{kinds[n].name}", F.lit(0)).alias(f"n_{kinds[n].name}") for n in base],
        F.sha2(F.coalesce(joined(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined(F.col("all")), F.lit("")).alias("spans"),
    )


def outside(spans: DataFrame, base: list[int]) -> DataFrame:
    """`spans` without those of other kinds that overlap a base span. Spans of other kinds may overlap
    each other: one address can be an endpoint and hold a secret."""
    before = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("rid").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    is_base = F.col("kind").isin(base)
    marked = spans.withColumns({
        "_reach": F.max(F.when(is_base, F.col("end"))).over(before),
        "_next": F.min(F.when(is_base, F.col("start"))).over(after),
    })
    free = (F.coalesce("_reach", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    return marked.where(is_base | free).drop("_reach", "_next")
