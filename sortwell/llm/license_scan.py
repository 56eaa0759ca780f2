"""License scan: set-similarity join of text blocks with license templates.

A block is a run of words, a template a short notice; both are sets of words. Blocks for a template
are all runs of twice its length, whatever the line breaks, or the whole text where it is shorter; a
block matches when it holds at least `THRESHOLD` of the template's words. Words that are spread out
further are never put together. The runs of all templates lie whole in windows of three times the
longest template that start at every third of that, and these windows are what is joined.

All words of templates are ordered by the number of texts they
occur in, rarest first. By this order a block and a template that match share a word among their
first ones (prefix filter), the block has enough template words at all (length filter), and the
places of a shared word leave enough words on both sides (positional filter). What passes is counted
exactly, run by run. Only blocks with enough template words and one of some template's first words leave their
row.

Templates are a parameter with a bounded vocabulary (`MAX_WORDS`, checked), so their order and the
template side are broadcast. Base phrases are searched in the text as runs of words.

Defined results: null counts as empty; without words there is nothing to find; repeated rows are
searched one by one. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import let, settled, whole_text

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATED = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
THRESHOLD = 0.85
MAX_WORDS = 5_000

# Phrases of the base search and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "dedicated to the public domain under creative commons zero"),
    ("gpl", "licensed under the gnu general public license version"),
    ("gpl", "this program is free software you can redistribute it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("proprietary", "all rights reserved no part may be reproduced without prior written permission"),
]


def words_of(text: str) -> list[str]:
    return sorted(set(SEPARATED.findall(text.lower())))


def length(text: str) -> int:
    return len(SEPARATED.findall(text))


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_places(phrase: str) -> Column:
    """Count, first and last word number of a phrase in `norm`, nulls where it does not occur."""
    n = len(phrase.split())

    def places(pieces: Column) -> Column:
        return F.when(F.size(pieces) > 1, F.struct(
            (F.size(pieces) - 1).cast("bigint").alias("n"),
            spaces(F.element_at(pieces, 1)).cast("bigint").alias("first"),
            (F.col("n_words") - (spaces(F.element_at(pieces, -1)) - 1) - n).cast("bigint").alias("last"),
        ))

    return F.when(F.col("norm").contains(f" {phrase} "), let(F.split("norm", f" {phrase}(?= )", -1), places))


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by the number of texts a word occurs in, rarest first."""
    found = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), F.split(F.lower(whole_text()), SEPARATORS))
    # One count per template word: bounded by the vocabulary.
    counts = {r.word: r.n for r in docs.select(F.explode(found).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")).toLocalIterator()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def first_words(words: list[str], rank: dict[str, int], threshold: float) -> list[str]:
    """A template's words of which every match has one."""
    return sorted(words, key=rank.get)[: len(words) - needed(len(words), threshold) + 1]


def blocks_of(words: Column, known: Column, width: int) -> Column:
    """words (those of `known`, in its order) and run (all words) of every window of `width` words."""
    step = width // 3
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - width + step), F.lit(step))

    def block(run: Column) -> Column:
        return F.struct(F.array_intersect(known, run).alias("words"), run.alias("run"))

    return F.transform(starts, lambda at: let(F.slice(words, at, F.lit(width)), block))


def scanned(docs: DataFrame, order: list[str], firsts: list[str], least: int, width: int, key: str = "doc_id") -> DataFrame:
    """rid, key, n_words, base places and the blocks' template words: settled, without texts."""
    lowered = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("key"), F.lower(whole_text()).alias("low"))
    norm = F.trim(F.regexp_replace("low", SEPARATORS, " "))
    split = lowered.select("rid", "key", F.concat(F.lit(" "), norm, F.lit(" ")).alias("norm"))
    split = split.withColumn("n_words", F.when(F.col("norm") == "  ", 0).otherwise(spaces(F.col("norm")) - 1).cast("bigint"))
    known, needs = F.array(*[F.lit(w) for w in order]), F.array(*[F.lit(w) for w in firsts])
    blocks = F.filter(
        let(F.split(F.trim("norm"), " "), lambda words: blocks_of(words, known, width)),
        lambda block: (F.size(block["words"]) >= least) & F.arrays_overlap(block["words"], needs),
    )
    return settled(split.select(
        "rid", "key", "n_words", F.array(*[phrase_places(p) for p in PHRASES]).alias("base"), blocks.alias("blocks")
    ))


def matched(rows: DataFrame, templates: list[tuple[str, str]], threshold: float, rank: dict[str, int]) -> DataFrame:
    """rid, label, containment of the best template of each label, for all blocks that match."""
    spark = rows.sparkSession
    sets = [(label, words_of(text), 2 * length(text)) for label, text in templates]
    least = min(needed(len(words), threshold) for _, words, _ in sets)
    # Words of a block come rarest first.
    blocks = rows.where(F.size("blocks") > 0).select("rid", F.inline("blocks"))
    prefixes = []
    for number, (label, words, span) in enumerate(sets):
        ranked = sorted(words, key=rank.get)
        alpha = needed(len(ranked), threshold)
        for place, word in enumerate(first_words(words, rank, threshold)):
            prefixes.append((word, number, label, place, alpha, span, ranked))
    side = spark.createDataFrame(
        prefixes, "word string, template int, label string, place int, alpha int, span int, template_words array<string>"
    )
    size = F.size("words")
    prefix = blocks.select("rid", "words", "run", F.posexplode(F.slice("words", F.lit(1), size - (least - 1))).alias("at", "word"))
    pairs = prefix.join(F.broadcast(side), "word")
    total = F.size("template_words")
    possible = F.least("at", "place") + 1 + F.least(size - F.col("at") - 1, total - F.col("place") - 1)
    pairs = pairs.where((size >= F.col("alpha")) & (possible >= F.col("alpha")))
    overlap = F.size(F.array_intersect("words", "template_words"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("run") - F.col("span") + 1))
    closest = F.array_max(F.transform(starts, lambda at: F.size(F.array_intersect(F.slice("run", at, F.col("span")), "template_words"))))
    pairs = pairs.where(overlap >= F.col("alpha"))
    found = pairs.withColumn("overlap", closest).where(F.col("overlap") >= F.col("alpha"))
    return found.groupBy("rid", "label").agg(F.max(F.col("overlap") / total).alias("containment"))


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    sets = [words_of(text) for _, text in templates]
    vocabulary = sorted({w for words in sets for w in words})
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"templates hold more than {MAX_WORDS} words")
    docs = docs.select("doc_id", "text")
    order = word_order(docs, vocabulary)
    rank = {w: i for i, w in enumerate(order)}
    firsts = sorted({w for words in sets for w in first_words(words, rank, threshold)})
    width = 3 * max(length(text) for _, text in templates)
    rows = scanned(docs, order, firsts, min(needed(len(w), threshold) for w in sets), width)
    labels = matched(rows, templates, threshold, rank).groupBy("rid").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("containment")
    )
    base = [F.element_at("base", i + 1) for i in range(len(PHRASES))]
    counted = rows.select("rid", "key", "n_words", "base").join(labels, "rid", "left").select(
        F.col("key").alias("doc_id"), "n_words", "found", "containment",
        sum((F.coalesce(b["n"], F.lit(0).cast("bigint")) for b in base), F.lit(0).cast("bigint")).alias("n_base"),
        F.least(*[b["first"] for b in base]).alias("first_word"),
        F.greatest(*[b["last"] for b in base]).alias("last_word"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*[
            F.when(b.isNotNull(), F.lit(label)) for b, label in zip(base, PHRASES.values())
        ])))).alias("own"),
    )
    every = F.array_sort(F.array_union("own", F.coalesce("found", F.array().cast("array<string>"))))
    return counted.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("own", ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
    )
