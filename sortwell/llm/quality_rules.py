"""Quality rules with thresholds that adapt to each language and source.

Base rules are fixed. Beyond them, four rates of a text (symbols per word, share of repeated lines,
share of words in repeated windows, characters per word) are compared with thresholds from quantile
sketches. A sketch is a table of counts over logarithmic bins, so quantiles are right to 2 % and
two sketches merge by adding counts; a value of 0 has a bin of its own. Sketches exist per language
and source and are merged into sketches per language and of everything; a text is judged by the
first of them that has at least `min_rows` texts. All thresholds are quantiles of that sketch: the upper
quartile plus `spread` times the interquartile range (for characters per word also the lower one less
that). Where the quartiles are equal, as most texts have no symbols or repeats at all, the range says
nothing, and the threshold is the larger of the quantile `TAIL` and the median of the values above 0: a
text is rejected only if it is among the group's last twentieth and worse than half of the texts that
have any. No constant takes part. Counts combine before their shuffle, so a source with a third of
all rows is as good as any other. The table of thresholds is broadcast if it has at most
`MAX_BROADCAST_ROWS` rows and joined with salted keys otherwise.

All of it is DataFrame functions on arrays inside the row; texts are never shuffled. Windows of
eight words are compared by 64-bit hashes.

Defined results: a null or empty text has no words and fails the base rule; null languages and
sources are groups of their own; repeated rows count as often as they come. Only doc_id, text, lang
and source are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sortwell.llm.common import let, settled, whole_text
from sortwell.session import MAX_BROADCAST_ROWS

WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Relative error of the sketches.
ACCURACY = 0.02
MIN_ROWS = 100
SPREAD = 4.0
TAIL = 0.95
TWO_SIDED = ("chars_per_word",)
SALTS = 32


def pairs_of(values: Column, step: int) -> Column:
    """Hashes of values `step` apart: entry i covers what entries i and i + step covered."""
    n = F.size(values)
    return F.when(n > step, F.zip_with(
        F.slice(values, 1, n - step), F.slice(values, step + 1, n - step), lambda a, b: F.xxhash64(a, b)
    )).otherwise(F.array().cast("array<bigint>"))


def repeated_words(words: Column) -> Column:
    """Words that lie in 8-word windows found twice or more."""

    def covered(windows: Column) -> Column:
        spots = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def in_twins(spots: Column) -> Column:
            n = F.size(spots)
            twins = F.zip_with(
                F.slice(spots, 1, n - 1), F.slice(spots, 2, n - 1),
                lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
            )
            return F.array_sort(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull()))))

        def length(starts: Column) -> Column:
            steps = F.zip_with(starts, F.slice(starts, 2, F.size(starts)), lambda a, b: F.coalesce(
                F.least(b - a, F.lit(WINDOW_WORDS)), F.lit(WINDOW_WORDS)))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

        return let(let(spots, in_twins), length)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(let(let(let(hashes, lambda h: pairs_of(h, 1)), lambda h: pairs_of(h, 2)), lambda h: pairs_of(h, 4)),
               lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(covered(h)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every text."""
    text = whole_text()
    split = docs.select(
        "doc_id", "lang", "source", text.alias("text"),
        F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    found = split.select(
        "doc_id", "lang", "source",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def rates() -> dict[str, Column]:
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    return {
        "symbol_rate": F.col("n_symbols") / words,
        "dup_line_rate": F.col("n_dup_lines") / lines,
        "repeat_rate": F.col("n_repeat_words") / words,
        "chars_per_word": F.col("word_chars") / words,
    }


GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
ZERO_BIN = -100_000


def bin_of(value: Column) -> Column:
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GROWTH))).otherwise(ZERO_BIN).cast("int")


def value_of(number: Column) -> Column:
    return F.when(number == ZERO_BIN, 0.0).otherwise(2 * F.pow(F.lit(GROWTH), number) / (GROWTH + 1))


def sketches(measured: DataFrame) -> DataFrame:
    """level, lang, source, rate, bin, n: quantile sketches as counts per bin. Level 0 is per
    language and source, 1 per language, 2 of everything."""
    each = measured.select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(name).alias("rate"), bin_of(value).alias("bin")) for name, value in rates().items()
    ])).alias("x")).select("lang", "source", "x.rate", "x.bin")
    finest = each.groupBy("lang", "source", "rate", "bin").agg(F.count("*").alias("n"))
    # Sketches merge by adding up their counts.
    merged = finest.select(F.explode(F.array(*[
        F.struct(
            F.lit(level).alias("level"),
            (F.col("lang") if level < 2 else F.lit(None).cast("string")).alias("lang"),
            (F.col("source") if level < 1 else F.lit(None).cast("string")).alias("source"),
        ) for level in range(3)
    ])).alias("g"), "rate", "bin", "n").select("g.*", "rate", "bin", "n")
    return merged.groupBy("level", "lang", "source", "rate", "bin").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame) -> DataFrame:
    """level, lang, source, rate, n and quantiles from the counts: q1, q3, the ends low_tail and
    high_tail, and the median of the values above 0 (null if there are none)."""
    group = ["level", "lang", "source", "rate"]
    upto = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*group)
    ranked = sketch.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(whole))
    zeros = F.max(F.when(F.col("bin") == ZERO_BIN, F.col("n")).otherwise(0)).over(whole)
    ranked = ranked.withColumn("zeros", zeros)
    value, above = value_of(F.col("bin")), F.col("total") - F.col("zeros")
    quantile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), value))
    middle = (F.col("bin") != ZERO_BIN) & (F.col("upto") - F.col("zeros") >= 0.5 * above)
    return ranked.groupBy(*group).agg(
        F.max("total").alias("n"), quantile(0.25).alias("q1"), quantile(0.75).alias("q3"),
        quantile(1 - TAIL).alias("low_tail"), quantile(TAIL).alias("high_tail"),
        F.min(F.when(middle, value)).alias("middle"),
    )


def thresholds(measured: DataFrame, min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """lang, source, low and high of every rate: one row for each language and source that occur."""
    found = quartiles(sketches(measured))
    reach = F.col("q3") - F.col("q1")
    two_sided = F.col("rate").isin(*TWO_SIDED)
    high = F.when(reach > 0, F.col("q3") + spread * reach).otherwise(F.greatest("high_tail", "middle"))
    low = F.when(reach > 0, F.col("q1") - spread * reach).otherwise(F.col("low_tail"))
    limits = found.select(
        "level", "lang", "source", "rate", "n",
        F.when(two_sided, low).otherwise(F.lit(float("-inf"))).alias("low"), high.alias("high"),
    )
    limits = limits.groupBy("level", "lang", "source").agg(
        F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rate", F.struct("low", "high")))).alias("limits")
    )
    limits = settled(limits)
    fine = limits.where("level = 0").select("lang", "source", "n", F.col("limits").alias("own"))
    by_lang = limits.where("level = 1").select(
        F.col("lang").alias("lang_1"), F.col("n").alias("n_1"), F.col("limits").alias("of_lang"))
    joined = fine.join(by_lang, F.col("lang").eqNullSafe(F.col("lang_1")), "left")
    overall = limits.where("level = 2").first()  # one row
    of_all = F.create_map(*[
        x for rate, limit in sorted(overall.limits.items())
        for x in (F.lit(rate), F.struct(F.lit(limit.low).alias("low"), F.lit(limit.high).alias("high")))
    ]) if overall else F.lit(None)
    return joined.select("lang", "source", F.when(F.col("n") >= min_rows, F.col("own")).when(
        F.col("n_1") >= min_rows, F.col("of_lang")).otherwise(of_all).alias("limits"))


def quality_rules(docs: DataFrame, min_rows: int = MIN_ROWS, spread: float = SPREAD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    measured = settled(measures(docs))
    limits = settled(thresholds(measured, min_rows, spread))
    same = F.col("lang").eqNullSafe(F.col("lang_l")) & F.col("source").eqNullSafe(F.col("source_l"))
    limits = limits.withColumnsRenamed({"lang": "lang_l", "source": "source_l"})
    if limits.count() <= MAX_BROADCAST_ROWS:
        judged = measured.join(F.broadcast(limits), same, "left")
    else:
        salted = limits.withColumn("salt_l", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int")
        judged = measured.withColumn("salt", salt).join(salted, same & (F.col("salt") == F.col("salt_l")), "left")
    within = F.lit(True)
    for name, value in rates().items():
        limit = F.element_at("limits", F.lit(name))
        # As in the sketches: a value in the bin of a threshold is not beyond it.
        within = within & value_of(bin_of(value)).between(limit["low"], limit["high"])
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"),
    )
