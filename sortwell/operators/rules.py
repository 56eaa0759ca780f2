"""Data contract rules. Each yields one row: rule, expected, observed, passed.

A rule is one aggregate expression over the table, so any number of rules costs one scan.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sortwell.functions.vectors import is_finite
from sortwell.operators.fingerprint import differing_rows
from sortwell.operators.reconcile import presence

RESULT = ["rule", "expected", "observed", "passed"]


@dataclass(frozen=True)
class Rule:
    """`observed` is an aggregate over the table. The same value comes from `parts`, aggregates that merge
    by `merge` ("sum" or "max") over shards, and `finish`."""

    name: str
    expected: str
    observed: Column
    passed: Callable[[Column], Column]
    parts: tuple[Column, ...] = ()
    merge: tuple[str, ...] = ()
    finish: Callable[[list[Column]], Column] | None = None


def _added(name: str, expected: str, count: Column, passed: Callable[[Column], Column]) -> Rule:
    """A rule on a count, which adds up over shards."""
    return Rule(name, expected, count, passed, (count,), ("sum",), lambda parts: parts[0])


def _zero(name: str, failing: Column) -> Rule:
    """No row may meet the failing condition."""
    return _added(name, "0", F.count_if(failing), lambda seen: seen == 0)


def not_null(col: str) -> Rule:
    return _zero(f"not_null:{col}", F.col(col).isNull())


def row_count(n: int) -> Rule:
    return _added("row_count", str(n), F.count(F.lit(1)), lambda seen: seen == n)


def vocabulary(col: str, values: list, *, mode: str = "equal", ignore_nulls: bool = False) -> Rule:
    """Values stay inside the vocabulary and, in `equal` mode, every entry occurs."""
    if mode not in ("equal", "subset"):
        raise ValueError("mode must be equal or subset")
    known = F.coalesce(F.col(col).isin(*values), F.lit(False))
    outside = F.col(col).isNotNull() & ~known if ignore_nulls else ~known
    found = [F.coalesce(F.max((F.col(col) == F.lit(v)).cast("int")), F.lit(0)) for v in values] if mode == "equal" else []
    n_outside = F.count_if(~F.col(col).isNull() & ~known if ignore_nulls else ~known)
    expected = "0 rows outside, 0 values absent"

    def told(parts: list[Column]) -> Column:
        absent = functools.reduce(operator.add, [1 - f for f in parts[1:]], F.lit(0))
        return F.concat(parts[0].cast("string"), F.lit(" rows outside, "), absent.cast("string"), F.lit(" values absent"))

    parts = (n_outside, *found)
    return Rule(
        f"vocabulary:{col}", expected, told(list(parts)), lambda seen: seen == F.lit(expected),
        parts, ("sum", *["max"] * len(found)), told,
    )


def single_value(col: str, value: object, *, ignore_nulls: bool = False) -> Rule:
    rule = vocabulary(col, [value], ignore_nulls=ignore_nulls)
    return replace(rule, name=f"single_value:{col}")


def label_range(col: str, n_classes: int) -> Rule:
    inside = F.coalesce(F.col(col).between(0, n_classes - 1), F.lit(False))
    return _zero(f"label_range:{col}", ~inside)


def array_shape(col: str, shape: tuple[int, ...]) -> Rule:
    """Nested arrays have these lengths, level by level, so (3, 224, 224) isn't (224, 3, 224)."""

    def fits(value: Column, lengths: tuple[int, ...]) -> Column:
        here = F.coalesce(F.size(value) == lengths[0], F.lit(False))
        if len(lengths) == 1:
            return here
        return here & F.coalesce(F.forall(value, lambda part: fits(part, lengths[1:])), F.lit(False))

    return _zero(f"array_shape:{col}:{'x'.join(map(str, shape))}", ~fits(F.col(col), shape))


def vector_shape(col: str, shape: tuple[int, ...]) -> Rule:
    """Length of a flat vector that holds `shape` with the first dimension outermost. The order of
    the dimensions can't be seen in it; `array_shape` checks nested arrays."""
    size = functools.reduce(operator.mul, shape, 1)
    return _zero(f"vector_shape:{col}", ~F.coalesce(F.size(col) == size, F.lit(False)))


def finite(col: str) -> Rule:
    return _zero(f"finite:{col}", ~F.coalesce(is_finite(col), F.lit(False)))


def all_true(col: str) -> Rule:
    return _zero(f"all_true:{col}", ~F.coalesce(F.col(col), F.lit(False)))


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def _of_schema(name: str, expected: str, observed: str, passed: bool) -> Rule:
    """A rule decided by the schema alone."""
    return Rule(name, expected, F.max(F.lit(observed)), lambda seen: F.lit(passed), finish=lambda parts: F.lit(observed))


def required_columns(df: DataFrame, columns: list[str]) -> Rule:
    missing = missing_columns(df, columns)
    return _of_schema("required_columns", "none missing", ",".join(missing) or "none missing", not missing)


def column_type(df: DataFrame, col: str, dtype: str) -> Rule:
    """Element type for arrays, else the column type, as a DDL name."""
    kind = df.schema[col].dataType
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    found = kind.simpleString()
    return _of_schema(f"column_type:{col}", dtype, found, found == dtype)


def validation_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Results of all rules in order (`seq` from 1), from one aggregation."""
    if not rules:
        raise ValueError("at least one rule is needed")
    seen = df.agg(*[r.observed.alias(f"o{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("seq"),
            F.lit(r.name).alias("rule"),
            F.lit(r.expected).alias("expected"),
            F.col(f"o{i}").cast("string").alias("observed"),
            F.coalesce(r.passed(F.col(f"o{i}")), F.lit(False)).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return seen.select(F.inline(F.array(*rows)))


def check(df: DataFrame, rule: Rule) -> DataFrame:
    return validation_report(df, [rule]).drop("seq")


def enforce(report: DataFrame) -> None:
    """Raise with the rules that failed, if any."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r['rule']}: expected {r['expected']}, observed {r['observed']}" for r in failed]
        raise ValueError("; ".join(lines))


def unique_key(df: DataFrame, key: str) -> DataFrame:
    """Number of keys that occur more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return check(per_key, _zero(f"unique_key:{key}", F.col("_n") > 1))


def alignment(left: DataFrame, right: DataFrame, *, key: str) -> DataFrame:
    """Every key has content and a label: keys found on one side only."""
    sides = presence(left, right, key, ("l", "r"))
    return check(sides, _zero(f"alignment:{key}", F.col("l") != F.col("r")))


def bijection(vocab: DataFrame, *, name: str, index: str, size: int) -> DataFrame:
    """Names and indices correspond one to one and there are `size` of them.

    `vocab` may be any table that holds the two columns; equal rows count once.
    """
    pairs = vocab.select(name, index).distinct()
    names = pairs.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    indices = pairs.groupBy(index).agg(F.count(F.lit(1)).alias("_n"))
    both = names.select(F.lit(1).alias("a"), "_n").unionByName(indices.select(F.lit(0).alias("a"), "_n"))
    text = F.concat(
        F.coalesce(F.sum("a"), F.lit(0)).cast("string"), F.lit(" names, "),
        F.coalesce(F.sum(1 - F.col("a")), F.lit(0)).cast("string"), F.lit(" indices, "),
        F.count_if(F.col("_n") > 1).cast("string"), F.lit(" ambiguous"),
    )
    expected = f"{size} names, {size} indices, 0 ambiguous"
    return check(both, Rule(f"bijection:{name}", expected, text, lambda seen: seen == F.lit(expected)))


def required_fields(df: DataFrame, record: str, fields: list[str]) -> DataFrame:
    """Registry records, JSON objects in column `record`, hold every required field.

    One row per field with the number of records that lack it.
    """
    names = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    rules = [_zero(f"required_field:{f}", ~F.array_contains(names, f)) for f in fields]
    return validation_report(df, rules).drop("seq")


def field_types(df: DataFrame, record: str, types: dict[str, str]) -> DataFrame:
    """Fields of VARIANT records have these types, as `schema_of_variant` names them (BIGINT, STRING,
    ARRAY<STRING>, OBJECT<...>), at any depth (`a.b`).

    One row per field with the number of records that lack it, or hold null or another type.
    """
    rules = []
    for name, kind in types.items():
        found = F.schema_of_variant(F.try_variant_get(record, f"$.{name}", "variant"))
        rules.append(_zero(f"field_type:{name}:{kind}", ~F.coalesce(found == kind, F.lit(False))))
    return validation_report(df, rules).drop("seq")


def determinism(first: DataFrame, second: DataFrame, *, name: str = "determinism", equal: bool = True) -> DataFrame:
    """Two runs of a job hold the same rows (`equal`), or differ.

    Equal runs are told by their fingerprints, without a shuffle of rows; see `differing_rows`.
    """
    rest = differing_rows(first, second)
    n = F.coalesce(F.sum(F.abs("n_more")), F.lit(0))
    expected, passed = ("0", lambda seen: seen == 0) if equal else ("more than 0", lambda seen: seen > 0)
    return check(rest, Rule(name, expected, n, passed))


def determinism_diff(first: DataFrame, second: DataFrame, *, key: str) -> DataFrame:
    """Keys whose rows differ between two runs: the key, n_first and n_second (rows that only the first or
    only the second run has)."""
    rest = differing_rows(first, second)
    return rest.groupBy(key).agg(
        F.sum(F.greatest("n_more", F.lit(0).cast("bigint"))).alias("n_first"),
        F.sum(F.greatest(-F.col("n_more"), F.lit(0).cast("bigint"))).alias("n_second"),
    )


def rule_states(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The partial states of all rules over one shard of a table, in one row `states`: an array of numbers
    per rule. States of shards merge by addition or maximum, so a shard is scanned once in its life."""
    rows = [F.array(*[p.cast("bigint") for p in r.parts], F.lit(0).cast("bigint")) for r in rules]
    return df.agg(F.array(*rows).alias("states"))


def merged_report(states: DataFrame, rules: list[Rule]) -> DataFrame:
    """`validation_report` of the whole table from the stored states of its shards (rows of `states`).

    The rules have to be those the states were made with, in the same order.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    cells = {"sum": F.sum, "max": F.max}
    number = lambda i, j: F.get(F.get("states", F.lit(i)), F.lit(j))
    merged = states.agg(*[
        F.coalesce(cells[r.merge[j]](number(i, j)), F.lit(0).cast("bigint")).alias(f"s{i}_{j}")
        for i, r in enumerate(rules) for j in range(len(r.parts))
    ], F.count(F.lit(1)).alias("_shards"))
    rows = []
    for i, r in enumerate(rules):
        seen = r.finish([F.col(f"s{i}_{j}") for j in range(len(r.parts))])
        rows.append(F.struct(
            F.lit(i + 1).alias("seq"), F.lit(r.name).alias("rule"), F.lit(r.expected).alias("expected"),
            seen.cast("string").alias("observed"), F.coalesce(r.passed(seen), F.lit(False)).alias("passed"),
        ))
    return merged.select(F.inline(F.array(*rows)))
