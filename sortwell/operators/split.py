"""Reproducible stratified splits and their checks."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sortwell.functions.draws import stable_order
from sortwell.operators.groups import attach_to_members
from sortwell.session import lookup_side, settled, small_table

SPLITS = ("train", "validation", "test")
_BUCKET_DIGITS = 4  # 65,536 buckets per class


def exact_ratios(ratios: tuple) -> tuple[Fraction, Fraction, Fraction]:
    """Ratios as exact fractions; they must sum to 1 within 1e-9. Percents are accepted too."""
    if len(ratios) != 3 or any(r < 0 for r in ratios):
        raise ValueError("three ratios, none negative, are needed")
    parts = [Fraction(str(r)) for r in ratios]
    if all(isinstance(r, int) for r in ratios) and sum(parts) == 100:
        parts = [p / 100 for p in parts]
    if abs(sum(parts) - 1) > Fraction(1, 10**9):
        raise ValueError(f"shares of the splits add up to {float(sum(parts))}, not 1")
    return tuple(parts)


def _quotas(classes: DataFrame, label: str, count: str, share: Fraction, out: str) -> DataFrame:
    """Largest-remainder quotas: ceil(share * total) places dealt to classes by their counts.

    All in whole numbers, DECIMAL where a product of counts may leave BIGINT. `classes` has one row
    per class, so its unpartitioned windows see class rows only.
    """
    up, by = share.numerator, share.denominator
    total = f"CAST(sum({count}) OVER () AS DECIMAL(18, 0)) AS _total"
    places = f"CAST((_total * {up} + {by - 1}) div {by} AS DECIMAL(18, 0)) AS _places"
    due = f"CAST({count} AS DECIMAL(18, 0)) * _places AS _due"
    floor = "coalesce(_due div nullif(_total, 0), 0) AS _floor"
    rest = "coalesce(_due % nullif(_total, 0), 0) AS _rest"
    turn = f"row_number() OVER (ORDER BY _rest DESC, {label} ASC NULLS FIRST)"
    left = "_places - sum(_floor) OVER ()"
    return (
        classes.selectExpr("*", total)
        .selectExpr("*", places)
        .selectExpr("*", due)
        .selectExpr("*", floor, rest)
        .selectExpr(*classes.columns, f"_floor + CASE WHEN {turn} <= {left} THEN 1 ELSE 0 END AS {out}")
    )


def split_cuts(
    df: DataFrame, *, key: str, label: str, ratios: tuple = (70, 15, 15), seed: int = 42
) -> DataFrame:
    """Per class, the last (hash, key) that falls into test and into the holdout (test and
    validation together).

    Rows are ordered inside a class by hash. A histogram over hash prefixes, combined before its
    shuffle, tells in which bucket each quota ends; only rows of those buckets are ranked. No class
    is ever sorted or moved as a whole.
    """
    train, validation, test = exact_ratios(ratios)
    holdout = 1 - train
    test_share = test / (validation + test) if validation + test else Fraction(0)
    order = stable_order(key, seed)
    rows = df.select(
        F.col(label).alias("_label"), order.alias("_hash"), F.col(key).alias("_key")
    ).withColumn("_bucket", F.substring("_hash", 1, _BUCKET_DIGITS))
    histogram = rows.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    classes = histogram.groupBy("_label").agg(F.sum("_n").alias("_class_n"))
    classes = _quotas(classes, "_label", "_class_n", holdout, "_holdout")
    classes = _quotas(classes, "_label", "_holdout", test_share, "_test")

    ends = classes.select(
        F.col("_label").alias("_class"),
        F.inline(
            F.array(
                F.struct(F.lit("test").alias("_cut"), F.col("_test").alias("_rank")),
                F.struct(F.lit("holdout").alias("_cut"), F.col("_holdout").alias("_rank")),
            )
        ),
    ).where(F.col("_rank") > 0)
    upto = F.sum("_n").over(Window.partitionBy("_label").orderBy("_bucket"))
    cut_buckets = (
        histogram.withColumn("_before", upto - F.col("_n"))
        .join(ends, F.col("_label").eqNullSafe(F.col("_class")))
        .where((F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_before") + F.col("_n")))
        .select("_class", F.col("_bucket").alias("_cut_bucket"), "_cut", (F.col("_rank") - F.col("_before")).alias("_nth"))
    )
    cut_buckets = lookup_side(cut_buckets)  # two rows per class
    inside = rows.join(
        cut_buckets,
        F.col("_label").eqNullSafe(F.col("_class")) & (F.col("_bucket") == F.col("_cut_bucket")),
    )
    place = F.row_number().over(
        Window.partitionBy("_cut", "_label", "_bucket").orderBy("_hash", "_key")
    )
    last = inside.withColumn("_place", place).where(F.col("_place") == F.col("_nth"))
    at = F.struct("_hash", "_key")
    return last.groupBy(F.col("_label").alias("_class")).agg(
        F.max(F.when(F.col("_cut") == "test", at)).alias("_last_test"),
        F.max(F.when(F.col("_cut") == "holdout", at)).alias("_last_holdout"),
    )


def stratified_split(
    df: DataFrame, *, key: str, label: str, ratios: tuple = (70, 15, 15), seed: int = 42
) -> DataFrame:
    """Add `split`: exact split sizes, class shares by largest remainder, no row moved.

    The holdout has ceil((validation + test) * n) rows and the test set its ceil share of that.
    Keys must be unique; a repeated key always stays in one split.
    """
    cuts = lookup_side(split_cuts(df, key=key, label=label, ratios=ratios, seed=seed))
    at = F.struct(stable_order(key, seed).alias("_hash"), F.col(key).alias("_key"))
    name = (
        F.when(at <= F.col("_last_test"), "test")
        .when(at <= F.col("_last_holdout"), "validation")
        .otherwise("train")
    )
    return df.join(cuts, F.col(label).eqNullSafe(F.col("_class")), "left").select(
        *df.columns, name.alias("split")
    )


def _weighed_groups(df: DataFrame, key: str, label: str, group: str) -> DataFrame:
    """_group, _label (of most of its rows, the smallest of equally frequent ones) and _weight (rows).

    A row whose group is null is a group of its own, named by its key.
    """
    name = F.coalesce(F.concat(F.lit("g:"), F.col(group).cast("string")), F.concat(F.lit("k:"), F.col(key).cast("string")))
    per_label = df.groupBy(name.alias("_group"), F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    most = F.min(F.struct((-F.col("_n")).alias("_less"), "_label"))
    return per_label.groupBy("_group").agg(most.getField("_label").alias("_label"), F.sum("_n").alias("_weight"))


def group_cuts(groups: DataFrame, *, ratios: tuple = (70, 15, 15), seed: int = 42) -> DataFrame:
    """Per class _cap, the last place that falls into test and into the holdout, and the quotas.

    `groups` has _group, _label and _weight. A class's groups are in order of their hashes; those that
    weigh more than `_cap`, the smaller quota of test and validation, come after all others. A group
    belongs to the part in which its first row falls, so the rows of the test set and those of the
    holdout are at least their quotas, and less than one group more. As in `split_cuts`, a histogram
    of weights over hash prefixes shows where a quota ends, and only groups there are ranked.
    """
    train, validation, test = exact_ratios(ratios)
    holdout = 1 - train
    test_share = test / (validation + test) if validation + test else Fraction(0)
    classes = groups.groupBy("_label").agg(F.sum("_weight").alias("_class_n"))
    classes = _quotas(classes, "_label", "_class_n", holdout, "_holdout")
    classes = _quotas(classes, "_label", "_holdout", test_share, "_test")
    parts = [F.when(x > 0, x) for x in (F.col("_test"), F.col("_holdout") - F.col("_test"))]
    quotas = lookup_side(classes.select(
        F.col("_label").alias("_class"), "_test", "_holdout", F.coalesce(F.least(*parts), F.lit(0)).alias("_cap")
    ))
    same = F.col("_label").eqNullSafe(F.col("_class"))
    placed = groups.join(quotas, same).select(
        "_class", "_weight", "_test", "_holdout", "_cap", (F.col("_weight") > F.col("_cap")).alias("_heavy"),
        stable_order("_group", seed).alias("_hash"), "_group",
    ).withColumn("_bucket", F.substring("_hash", 1, _BUCKET_DIGITS))
    buckets = placed.groupBy("_class", "_heavy", "_bucket").agg(F.sum("_weight").alias("_w"), F.first("_test").alias("_test"), F.first("_holdout").alias("_holdout"))
    before = F.sum("_w").over(Window.partitionBy("_class").orderBy("_heavy", "_bucket")) - F.col("_w")
    ends = F.inline(F.array(*[F.struct(F.lit(c).alias("_cut"), F.col(f"_{c}").alias("_quota")) for c in ("test", "holdout")]))
    # The bucket with the last group that starts below a quota: at most two per class.
    cut_buckets = lookup_side(
        buckets.withColumn("_before", before).select("_class", "_heavy", "_bucket", "_w", "_before", ends)
        .where((F.col("_before") < F.col("_quota")) & (F.col("_quota") <= F.col("_before") + F.col("_w")))
        .select(F.col("_class").alias("_c"), F.col("_heavy").alias("_h"), F.col("_bucket").alias("_b"), "_cut", (F.col("_quota") - F.col("_before")).alias("_room"))
    )
    inside = placed.join(
        cut_buckets, F.col("_class").eqNullSafe(F.col("_c")) & (F.col("_heavy") == F.col("_h")) & (F.col("_bucket") == F.col("_b"))
    )
    upto = Window.partitionBy("_cut", "_class", "_heavy", "_bucket").orderBy("_hash", "_group")
    start = F.sum("_weight").over(upto) - F.col("_weight")
    at = F.struct("_heavy", "_hash", "_group")
    last = inside.withColumn("_start", start).where(F.col("_start") < F.col("_room")).groupBy("_class").agg(
        F.max(F.when(F.col("_cut") == "test", at)).alias("_last_test"),
        F.max(F.when(F.col("_cut") == "holdout", at)).alias("_last_holdout"),
    )
    return quotas.join(last.withColumnRenamed("_class", "_c"), F.col("_class").eqNullSafe(F.col("_c")), "left").drop("_c")


def stratified_group_split(
    df: DataFrame, *, key: str, label: str, group: str, ratios: tuple = (70, 15, 15), seed: int = 42,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Add `split` so that no group (a cluster of near duplicates, say) is cut; see `group_cuts`.

    Each class, by the label that most rows of a group have, has its exact quotas of the test set and of
    the holdout (test and validation), as in `stratified_split`. Its rows in the test set exceed the
    quota by less than the weight of its last group there, which is at most `_cap` unless only heavier
    groups are left; the same holds for the holdout. With groups of one row the quotas are met exactly.
    Rows without a group are groups of their own.
    """
    groups = settled(_weighed_groups(df, key, label, group))
    cuts = lookup_side(group_cuts(groups, ratios=ratios, seed=seed))
    at = F.struct((F.col("_weight") > F.col("_cap")).alias("_heavy"), stable_order("_group", seed).alias("_hash"), "_group")
    name = (
        F.when(at <= F.col("_last_test"), "test")
        .when(at <= F.col("_last_holdout"), "validation")
        .otherwise("train")
    )
    chosen = groups.join(cuts, F.col("_label").eqNullSafe(F.col("_class"))).select("_group", "_weight", name.alias("split"))
    own = F.coalesce(F.concat(F.lit("g:"), F.col(group).cast("string")), F.concat(F.lit("k:"), F.col(key).cast("string")))
    rows = df.withColumn("_group", own)
    return attach_to_members(rows, chosen, "_group", spread_by=key, size_col="_weight", hot_rows=hot_rows).select(
        *df.columns, "split"
    )


def split_overlap(df: DataFrame, *, key: str, split: str = "split", names: tuple[str, ...] = SPLITS) -> DataFrame:
    """Distinct keys shared by each pair of splits: zeros included for `names`, and any other pair
    that occurs. A null split counts as a split called "(none)".

    One aggregation by key to the set of its splits; hot keys combine before the shuffle.
    """
    rank = F.coalesce(F.array_position(F.array(*[F.lit(n) for n in names]), F.col("_split")), F.lit(0))
    place = F.when(rank == 0, len(names) + 1).otherwise(rank)
    per_key = (
        df.select(F.col(key).alias("_key"), F.coalesce(F.col(split).cast("string"), F.lit("(none)")).alias("_split"))
        .groupBy("_key")
        .agg(F.array_sort(F.collect_set(F.struct(place.alias("place"), F.col("_split").alias("name")))).alias("_in"))
        .where(F.size("_in") > 1)
    )
    pairs = F.flatten(F.transform("_in", lambda a, i: F.transform(
        F.slice("_in", i + 2, F.size("_in")),
        lambda b: F.struct(a["name"].alias("split_a"), b["name"].alias("split_b"), F.lit(1).cast("bigint").alias("n")),
    )))
    found = per_key.where(F.col("_key").isNotNull()).select(F.inline(pairs))
    known = [(a, b, 0) for i, a in enumerate(names) for b in names[i + 1 :]]
    zeros = small_table(df.sparkSession, known, "split_a string, split_b string, n bigint")
    return found.unionByName(zeros).groupBy("split_a", "split_b").agg(F.sum("n").alias("n_shared"))


def split_coverage(df: DataFrame, *, key: str) -> DataFrame:
    """Rows, distinct keys, and whether every row is a key of its own."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(key).alias("n_keys")
    ).withColumn("complete", F.col("n_rows") == F.col("n_keys"))


def check_splits(df: DataFrame, *, key: str, split: str = "split", names: tuple[str, ...] = SPLITS) -> None:
    """Fail when a row's split is none of `names`, or a key sits in two splits or occurs twice."""
    known = F.coalesce(F.col(split).isin(*names), F.lit(False))
    unknown = df.where(~known).select(split).distinct().limit(10).collect()
    if unknown:
        raise ValueError(f"unexpected split names: {[r[0] for r in unknown]}")
    shared = split_overlap(df, key=key, split=split).where("n_shared > 0").collect()
    if shared:
        raise ValueError(f"keys shared across splits: {[tuple(r) for r in shared]}")
    if not split_coverage(df, key=key).first()["complete"]:
        raise ValueError("some keys occur more than once")


def split_distribution(df: DataFrame, *, label: str, split: str = "split", names: tuple[str, ...] = SPLITS) -> DataFrame:
    """Share of each class in each split and overall; 0 where a class is missing."""
    counts = df.groupBy(label).agg(
        *[F.count_if(F.col(split) == name).alias(name) for name in names],
        F.count(F.lit(1)).alias("overall"),
    )
    columns = [*names, "overall"]
    totals = counts.agg(F.struct(*[F.sum(c).alias(c) for c in columns]).alias("t"))
    total = totals.scalar()
    share = lambda c: F.when(total[c] > 0, F.col(c) / total[c]).otherwise(0.0)
    return counts.select(label, *[share(c).alias(f"{c}_share") for c in columns])


def class_coverage(
    df: DataFrame, *, label: str, vocab: list, split: str = "split", names: tuple[str, ...] = SPLITS
) -> DataFrame:
    """Rows per split and class, with `covered` = at least one row and `listed` = the split and the
    class are among `names` and `vocab`.

    Zero-filled for listed ones; whatever else occurs, nulls too, has rows of its own, so `n` adds
    up to all rows.
    """
    schema = T.StructType(
        [T.StructField("split", T.StringType()), T.StructField("label", df.schema[label].dataType)]
    )
    grid = small_table(df.sparkSession, [(s, v) for s in names for v in vocab], schema)
    counts = df.groupBy(F.col(split).alias("split"), F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    both = counts.withColumn("listed", F.lit(False)).unionByName(
        grid.withColumns({"n": F.lit(0).cast("bigint"), "listed": F.lit(True)})
    )
    found = both.groupBy("split", "label").agg(F.sum("n").alias("n"), F.max("listed").alias("listed"))
    return found.select("split", "label", "n", (F.col("n") > 0).alias("covered"), "listed")


def check_coverage(
    df: DataFrame, *, label: str, vocab: list, expected_rows: int, split: str = "split",
    names: tuple[str, ...] = SPLITS,
) -> None:
    """Fail on a listed class without rows, an unlisted split or class, or a wrong total."""
    cells = class_coverage(df, label=label, vocab=vocab, split=split, names=names)
    at = F.struct("split", "label")
    found = cells.agg(
        F.slice(F.collect_list(F.when(~F.col("covered"), at)), 1, 10).alias("empty"),
        F.slice(F.collect_list(F.when(~F.col("listed"), at)), 1, 10).alias("unlisted"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    ).first()
    if found.empty:
        raise ValueError(f"classes without rows: {[tuple(r) for r in found.empty]}")
    if found.unlisted:
        raise ValueError(f"splits or classes outside the lists: {[tuple(r) for r in found.unlisted]}")
    if found.total != expected_rows:
        raise ValueError(f"{found.total} rows where {expected_rows} were expected")
