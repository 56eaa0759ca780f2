"""Splits that cut no group, against the same rule row by row."""

import collections
import hashlib
import random

import pytest
from conftest import plan_of

import __spark_entry__ as entry
from sortwell.operators import neardup, split
from sortwell.plans.queries import hashed
from sortwell.session import small_table


def quotas(counts, places):
    total = sum(counts.values())
    base = {c: n * places // total for c, n in counts.items()}
    for c in sorted(counts, key=lambda c: (-(counts[c] * places % total), c))[: places - sum(base.values())]:
        base[c] += 1
    return base


def by_hand(data, validation, test, seed=42):
    """{group: split} and, per class, (quota, rows, weight of the last group) of test and of the holdout."""
    labels = collections.defaultdict(collections.Counter)
    for key, label, group in data:
        labels[f"k:{key}" if group is None else f"g:{group}"][label] += 1
    weight = {g: sum(c.values()) for g, c in labels.items()}
    of = {g: min(c, key=lambda x: (-c[x], x)) for g, c in labels.items()}
    counts = collections.Counter()
    for g, w in weight.items():
        counts[of[g]] += w
    holdout = -(-sum(counts.values()) * (validation + test) // 100)
    hold = quotas(counts, holdout)
    tests = quotas(hold, -(-holdout * test // (validation + test)))
    out, bounds = {}, {}
    for c in counts:
        cap = min((x for x in (tests[c], hold[c] - tests[c]) if x > 0), default=0)
        order = sorted((weight[g] > cap, hashlib.md5(f"{seed}:{g}".encode()).hexdigest(), g) for g in weight if of[g] == c)
        start, last = 0, {}
        for _, _, g in order:
            out[g] = "test" if start < tests[c] else "validation" if start < hold[c] else "train"
            start += weight[g]
            last[out[g]] = (start, weight[g])
        rows, w = last.get("test", (0, 0))
        bounds[c] = [(tests[c], rows, w)]
        rows, w = last.get("validation", (rows, w))
        bounds[c].append((hold[c], rows, w))
    return out, bounds


def make(seed, n, hot=0):
    rng = random.Random(seed)
    data = [(i, rng.choices("abc", weights=(6, 3, 1))[0], None if rng.random() < 0.3 else rng.randrange(n // 4)) for i in range(n)]
    return data + [(n + i, rng.choice("ab"), 10**6) for i in range(hot)]


@pytest.mark.parametrize("data,ratios,hot_rows", [
    (make(1, 900), (70, 15, 15), 10**6), (make(2, 600, hot=300), (60, 25, 15), 5), (make(3, 12), (70, 15, 15), 10**6),
    ([(i, "x", None) for i in range(101)], (80, 10, 10), 10**6), ([(i, "x", 1) for i in range(40)], (70, 15, 15), 10**6),
])
def test_split_equals_plain_computation(spark, data, ratios, hot_rows):
    df = small_table(spark, data, "key bigint, label string, grp bigint")
    found = split.stratified_group_split(df, key="key", label="label", group="grp", ratios=ratios, hot_rows=hot_rows)
    want, bounds = by_hand(data, *ratios[1:])
    got = {r["key"]: r["split"] for r in found.collect()}
    assert got == {k: want[f"k:{k}" if g is None else f"g:{g}"] for k, _, g in data}
    for quota, rows, last in (b for both in bounds.values() for b in both):
        assert quota <= rows < quota + max(1, last)


def test_split_of_documents_has_no_leak(spark, sf):
    found = entry.queries()["stratified_group_split"](spark, sf)
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    leaks = neardup.near_dup_leakage(hashed(spark, sf), found.select("doc_id", "split"), key="doc_id", hash_col="fp")
    assert leaks.count() == 0
    assert {r[0] for r in found.select("split").distinct().collect()} == {"train", "validation", "test"}
