import collections
import hashlib
import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from sortwell.operators import split
from sortwell.session import small_table


def plain_split(data, ratios, seed):
    """Largest remainders and hash order, in plain Python. Ratios in whole percents."""

    def quotas(counts, places):
        total = sum(counts.values())
        base = {c: n * places // total for c, n in counts.items()}
        turn = sorted(counts, key=lambda c: (-(counts[c] * places % total), c))
        for c in turn[: places - sum(base.values())]:
            base[c] += 1
        return base

    _, val, test = ratios
    counts = collections.Counter(label for _, label in data)
    n = len(data)
    holdout = -(-n * (val + test) // 100)
    hold = quotas(counts, holdout)
    tests = quotas(hold, -(-holdout * test // (val + test)))
    result, seen = {}, collections.Counter()
    order = lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0])
    for key, label in sorted(data, key=order):
        seen[label] += 1
        rank = seen[label]
        result[key] = "test" if rank <= tests[label] else "validation" if rank <= hold[label] else "train"
    return result


def make(n, classes, seed=0):
    rng = random.Random(seed)
    return [(f"k{i:05d}", rng.choices(classes, weights=range(1, len(classes) + 1))[0]) for i in range(n)]


@pytest.mark.parametrize(
    "data,ratios",
    [
        (make(1013, ["a", "b", "c", "d"]), (70, 15, 15)),
        (make(21, ["a", "b"]) + [("z1", "one"), ("y1", "two"), ("y2", "two")], (70, 15, 15)),
        (make(500, ["a"]), (80, 15, 5)),
        (make(3, ["a", "b"]), (60, 20, 20)),
    ],
)
def test_split_equals_plain_computation(spark, data, ratios):
    df = small_table(spark, data, "key string, label string")
    got = split.stratified_split(df, key="key", label="label", ratios=ratios)
    assert {r.key: r.split for r in got.collect()} == plain_split(data, ratios, 42)


def test_sizes_of_the_published_split(spark):
    df = spark.range(21397).select("id", (F.col("id") % 5).alias("label"))
    got = split.stratified_split(df, key="id", label="label").groupBy("split").count()
    assert rows(got) == [("test", 3210), ("train", 14977), ("validation", 3210)]


def test_same_split_on_any_partitioning_and_other_with_other_seed(spark):
    df = small_table(spark, make(300, ["a", "b"]), "key string, label string")
    run = lambda d, seed=42: rows(split.stratified_split(d, key="key", label="label", seed=seed))
    assert run(df.coalesce(1)) == run(df.repartition(16))
    assert run(df) != run(df, 43)


def test_ratios_as_fractions_and_bad_ratios(spark):
    df = small_table(spark, make(200, ["a", "b"]), "key string, label string")
    a = split.stratified_split(df, key="key", label="label", ratios=(0.70, 0.15, 0.15))
    b = split.stratified_split(df, key="key", label="label", ratios=(70, 15, 15))
    assert rows(a) == rows(b)
    for bad in [(70, 15, 14), (0.7, 0.2, 0.2), (1.2, -0.1, -0.1), (1.0,)]:
        with pytest.raises(ValueError):
            split.exact_ratios(bad)


def test_null_label_is_a_class(spark):
    df = small_table(spark, [(f"k{i}", None if i % 2 else "a") for i in range(40)], "key string, label string")
    got = split.stratified_split(df, key="key", label="label").groupBy("label", "split").count()
    assert got.where("split = 'train'").agg(F.sum("count")).first()[0] == 28
    assert got.where("label is null").agg(F.sum("count")).first()[0] == 20


def test_rows_are_not_shuffled(spark):
    df = small_table(spark, make(300, ["a", "b"]), "key string, label string")
    plan = plan_of(split.stratified_split(df, key="key", label="label"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_many_classes_take_the_shuffle_path(spark, monkeypatch):
    import sortwell.session as session

    data = make(400, [f"c{i}" for i in range(20)])
    small = lambda df, max_rows=3: session.lookup_side(df, max_rows)
    monkeypatch.setattr(split, "lookup_side", small)
    df = small_table(spark, data, "key string, label string")
    got = split.stratified_split(df, key="key", label="label")
    assert {r.key: r.split for r in got.collect()} == plain_split(data, (70, 15, 15), 42)


def splits_table(spark):
    data = [
        ("a", "train", "x"), ("b", "train", "x"), ("c", "validation", "y"), ("d", "test", "x"),
        ("a", "test", "x"), ("b", "test", "y"), ("a", "train", "x"),
    ]
    return small_table(spark, data, "key string, split string, label string")


def test_overlap_lists_all_pairs_with_zeros(spark):
    got = rows(split.split_overlap(splits_table(spark), key="key"))
    assert got == [("train", "test", 2), ("train", "validation", 0), ("validation", "test", 0)]


def test_coverage_and_check(spark):
    df = splits_table(spark)
    assert tuple(split.split_coverage(df, key="key").first()) == (7, 4, False)
    with pytest.raises(ValueError):
        split.check_splits(df, key="key")
    split.check_splits(df.where("key in ('c', 'd')"), key="key")
    with pytest.raises(ValueError):
        split.check_splits(df.where("key = 'a' and split = 'train'"), key="key")
    other = small_table(spark, [("a", "train"), ("b", "holdout"), ("c", None)], "key string, split string")
    with pytest.raises(ValueError, match="unexpected split names"):
        split.check_splits(other, key="key")


def test_overlap_shows_other_split_names(spark):
    data = [("a", "train"), ("a", "holdout"), ("a", "dev"), ("b", "dev"), ("b", None), (None, "train"), (None, "dev")]
    got = rows(split.split_overlap(small_table(spark, data, "key string, split string"), key="key"))
    assert got == [
        ("(none)", "dev", 1), ("dev", "holdout", 1), ("train", "dev", 1), ("train", "holdout", 1), ("train", "test", 0),
        ("train", "validation", 0), ("validation", "test", 0),
    ]


def test_distribution_fills_zeros_and_has_true_overall(spark):
    got = {r.label: r for r in split.split_distribution(splits_table(spark), label="label").collect()}
    assert got["y"]["train_share"] == 0.0 and got["y"]["validation_share"] == 1.0
    assert got["x"]["overall_share"] == pytest.approx(5 / 7)


def test_class_coverage(spark):
    got = rows(split.class_coverage(splits_table(spark), label="label", vocab=["x", "z"]))
    assert ("test", "z", 0, False, True) in got and ("train", "x", 3, True, True) in got and len(got) == 8
    assert ("test", "y", 1, True, False) in got and sum(r[2] for r in got) == 7


def test_check_coverage(spark):
    data = [(s, c) for s in split.SPLITS for c in ("x", "y")]
    check = lambda more, n: split.check_coverage(
        small_table(spark, data + more, "split string, label string"), label="label", vocab=["x", "y"], expected_rows=n
    )
    check([], 6)
    check([("train", "x")], 7)
    for more, n, text in (([], 7, "expected"), ([("train", "w")], 7, "outside"), ([("dev", "x")], 7, "outside"),
                          ([("train", None)], 7, "outside")):
        with pytest.raises(ValueError, match=text):
            check(more, n)
    with pytest.raises(ValueError, match="without rows"):
        split.check_coverage(small_table(spark, data[1:], "split string, label string"), label="label", vocab=["x", "y"], expected_rows=5)
