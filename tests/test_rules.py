import math

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from sortwell.functions import vectors
from sortwell.operators import metrics, rules
from sortwell.session import small_table


def verdicts(df, *checks):
    return [r.passed for r in rules.validation_report(df, list(checks)).orderBy("seq").collect()]


@pytest.fixture
def people(spark):
    return small_table(spark, [("a", 0), ("b", 4), (None, 5), ("a", -1)], "name string, label int")


def test_single_column_rules(people):
    assert verdicts(
        people, rules.not_null("name"), rules.not_null("label"), rules.row_count(4), rules.row_count(5),
        rules.label_range("label", 5), rules.label_range("name", 5) if False else rules.label_range("label", 6),
    ) == [False, True, True, False, False, False]
    observed = rules.check(people, rules.label_range("label", 5)).first()
    assert (observed.expected, observed.observed) == ("0", "2")


def test_vocabulary_rules(people):
    known = rules.vocabulary("name", ["a", "b"])
    assert verdicts(
        people, known, rules.vocabulary("name", ["a", "b"], ignore_nulls=True),
        rules.vocabulary("name", ["a", "b", "c"], ignore_nulls=True),
        rules.vocabulary("name", ["a", "b", "c"], mode="subset", ignore_nulls=True),
        rules.single_value("name", "a", ignore_nulls=True),
    ) == [False, True, False, True, False]
    assert rules.check(people.where("name = 'a'"), rules.single_value("name", "a")).first().passed


def test_vector_rules(spark):
    nan, inf = float("nan"), float("inf")
    df = small_table(spark, [([1.0, 2.0],), ([1.0],), ([nan, 0.0],), ([inf, 0.0],), (None,)], "v array<float>")
    got = {r.rule: r.observed for r in rules.validation_report(df, [rules.vector_shape("v", (2, 1)), rules.finite("v")]).collect()}
    assert got == {"vector_shape:v": "2", "finite:v": "3"}
    assert verdicts(df, rules.column_type(df, "v", "float"), rules.column_type(df, "v", "double")) == [True, False]


def test_all_rules_share_one_scan(people):
    report = rules.validation_report(
        people, [rules.not_null("name"), rules.row_count(4), rules.vocabulary("name", ["a"]), rules.label_range("label", 2)]
    )
    assert plan_of(report).count("LocalTableScan") == 1 and plan_of(report).count("Exchange") == 1


def test_required_columns_and_enforce(people):
    assert verdicts(people, rules.required_columns(people, ["name"]), rules.required_columns(people, ["name", "crop"])) == [True, False]
    with pytest.raises(ValueError, match="not_null:name"):
        rules.enforce(rules.check(people, rules.not_null("name")))
    rules.enforce(rules.check(people, rules.row_count(4)))


def test_empty_table_fails_where_values_must_occur(people):
    empty = people.where("false")
    assert verdicts(empty, rules.not_null("name"), rules.row_count(0), rules.single_value("name", "a")) == [True, True, False]


def test_keys_alignment_bijection(spark):
    left = small_table(spark, [("a",), ("b",), ("a",)], "k string")
    right = small_table(spark, [("a",), ("c",)], "k string")
    assert rules.unique_key(left, "k").first().observed == "1"
    assert rules.unique_key(right, "k").first().passed
    assert rules.alignment(left, right, key="k").first().observed == "2"
    assert rules.alignment(left, left, key="k").first().passed
    good = small_table(spark, [("a", 0), ("b", 1), ("a", 0)], "n string, i int")
    bad = small_table(spark, [("a", 0), ("b", 0)], "n string, i int")
    assert rules.bijection(good, name="n", index="i", size=2).first().passed
    got = rules.bijection(bad, name="n", index="i", size=2).first()
    assert not got.passed and got.observed == "2 names, 1 indices, 1 ambiguous"


def test_required_fields(spark):
    df = small_table(spark, [('{"a": 1, "b": 2}',), ('{"a": null}',), ("{}",)], "record string")
    assert rows(rules.required_fields(df, "record", ["a", "b"]).select("rule", "observed", "passed")) == [
        ("required_field:a", "1", False), ("required_field:b", "2", False),
    ]


def test_determinism_counts_repeats(spark):
    a = small_table(spark, [(1,), (1,), (2,)], "v int")
    b = small_table(spark, [(1,), (2,), (2,)], "v int")
    assert rules.determinism(a, a.repartition(5)).first().passed
    assert rules.determinism(a, b).first().observed == "2"
    assert rules.determinism(a, b, equal=False).first().passed


def test_vector_functions(spark):
    data = [(1, [1.0, 2.0, 4.0, 5.0, 7.0, 11.0]), (2, [3.0]), (3, [])]
    df = small_table(spark, data, "id int, v array<float>")
    got = {r.id: r.s for r in df.select("id", vectors.vector_stats("v").alias("s")).collect()}
    assert (got[1]["min"], got[1]["max"], got[1]["mean"]) == (1.0, 11.0, 5.0)
    assert got[1]["std"] == pytest.approx(math.sqrt(66 / 5))
    assert got[2]["std"] is None and got[3]["mean"] is None
    scaled = df.where("id = 1").select(vectors.channel_normalise("v", [1.0, 4.0, 7.0], [1.0, 2.0, 4.0]).alias("v")).first().v
    assert scaled == [0.0, 1.0, 0.0, 0.5, 0.0, 1.0]
    with pytest.raises(ValueError):
        vectors.channel_normalise("v", [1.0], [0.0])


def test_metrics(spark):
    data = [("a", "a")] * 3 + [("a", "b")] * 1 + [("b", "b")] * 2 + [("b", "a")] * 2
    df = small_table(spark, data, "t string, p string")
    vocab = ["a", "b", "c"]
    assert rows(metrics.confusion_matrix(df, truth="t", pred="p", vocab=vocab))[:3] == [("a", "a", 3), ("a", "b", 1), ("a", "c", 0)]
    assert metrics.accuracy(df, truth="t", pred="p").first()[0] == 5 / 8
    got = {r["class"]: r for r in metrics.precision_recall(df, truth="t", pred="p", vocab=vocab).collect()}
    assert (got["a"].precision, got["a"].recall) == (3 / 5, 3 / 4)
    assert (got["c"].precision, got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    f1 = [2 * 3 / (4 + 5), 2 * 2 / (4 + 3), 0.0]
    assert metrics.macro_f1(df, truth="t", pred="p", vocab=vocab).first()[0] == pytest.approx(sum(f1) / 3)
    assert df.select(F.lit(1)).count() == 8


def test_metrics_count_every_row(spark):
    data = [(0, 0), (0, None), (0, 7), (1, 1)]
    df = small_table(spark, data, "t int, p int")
    got = {r["class"]: r for r in metrics.precision_recall(df, truth="t", pred="p", vocab=[0, 1]).collect()}
    assert set(got) == {0, 1}
    assert (got[0].support, got[0].recall, got[0].precision) == (3, 1 / 3, 1.0)
    assert metrics.accuracy(df, truth="t", pred="p").first()[0] == 0.5
    cells = rows(metrics.confusion_matrix(df, truth="t", pred="p", vocab=[0, 1]))
    assert cells == [(0, 0, 1), (0, 1, 0), (0, 7, 1), (0, None, 1), (1, 0, 0), (1, 1, 1)]
    null_truth = small_table(spark, [(None, 0), (0, 0)], "t int, p int")
    found = metrics.precision_recall(null_truth, truth="t", pred="p", vocab=[0]).first()
    assert (found.support, found.precision) == (1, 0.5)
    assert metrics.accuracy(null_truth, truth="t", pred="p").first()[0] == 0.5


def test_array_shape_sees_the_order_of_dimensions(spark):
    df = small_table(spark, [([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]],)], "v array<array<double>>")
    assert rules.check(df, rules.array_shape("v", (3, 2))).first().passed
    assert not rules.check(df, rules.array_shape("v", (2, 3))).first().passed
    ragged = small_table(spark, [([[1.0], [2.0, 3.0]],), (None,)], "v array<array<double>>")
    assert rules.check(ragged, rules.array_shape("v", (2, 1))).first().observed == "2"
