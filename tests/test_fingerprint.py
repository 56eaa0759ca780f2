"""Fingerprints, stored key filters and reports merged from shards."""

import collections
import random
import re

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from sortwell.operators import fingerprint, keyfilter, rules
from sortwell.plans.queries import QUERIES
from sortwell.session import small_table

SCHEMA = "k bigint, s string, x double, v array<int>"


def some_rows(n, seed=1):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    return [(pick(None, i, i % 7), pick(None, "", "a", "b"), pick(None, 0.5, -1.0), pick(None, [], [1, None], [None, 1])) for i in range(n)]


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_differing_rows_equal_a_count_of_all_rows(spark, buckets):
    a = some_rows(300)
    b = a[::-1][:-7] + some_rows(5, seed=9) + a[:3]
    left, right = collections.Counter(map(str, a)), collections.Counter(map(str, b))
    found = fingerprint.differing_rows(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA).repartition(3), buckets=buckets)
    got = {str(tuple(r)[:-1]): r.n_more for r in found.collect()}
    want = {k: left[k] - right[k] for k in left | right if left[k] != right[k]}
    assert want and got == want


def test_places_of_nulls_tell_rows_apart(spark):
    pairs = [((None, "a", None, None), (None, None, None, None)), ((1, None, None, [1, None]), (1, None, None, [None, 1])),
             ((1, "", None, []), (1, None, None, [])), ((1, None, None, None), (1, None, None, []))]
    for a, b in pairs:
        one, other = (fingerprint.table_fingerprint(spark.createDataFrame([r], SCHEMA)).first() for r in (a, b))
        assert one.n_rows == other.n_rows == 1 and one.fingerprint != other.fingerprint


def test_equal_runs_shuffle_no_rows(spark):
    df = spark.createDataFrame(some_rows(200), SCHEMA)
    same = fingerprint.differing_rows(df, df.repartition(7))
    assert same.count() == 0 and "Exchange" not in plan_of(same)
    assert fingerprint.table_fingerprint(df).first() == fingerprint.table_fingerprint(df.repartition(9)).first()
    empty = fingerprint.table_fingerprint(df.where("k < 0")).first()
    assert empty.n_rows == 0 and empty.fingerprint


def test_determinism_diff_names_the_keys(spark):
    a = small_table(spark, [(1, "x"), (2, "x"), (2, "x"), (3, None)], "k int, v string")
    b = small_table(spark, [(1, "x"), (2, "x"), (3, "y"), (4, "z")], "k int, v string")
    assert rows(rules.determinism_diff(a, b, key="k")) == [(2, 1, 0), (3, 1, 1), (4, 0, 1)]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 18])
def test_key_filter_loses_no_key(spark, bits):
    held = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    parts = [keyfilter.key_filter(held.where(F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(3)) == i), "key", bits) for i in range(3)]
    filters = keyfilter.merged_filter(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    asked = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(1).alias("_bit0"))
    passed = {r.key for r in keyfilter.maybe_known(asked, filters, "key", bits).collect()}
    known = {f"k{i}" for i in range(0, 3000, 3)}
    assert known <= passed and len(passed - known) < 2000 * (0.06 if bits == 1 << 15 else 0.02)
    plan = plan_of(keyfilter.maybe_known(asked, filters, "key", bits))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_overlap_of_new_keys_is_exact(spark):
    stored = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train"), (None, "test"), ("c", None)], "key string, split string")
    new = spark.createDataFrame([("a",), ("a",), ("c",), ("z",), (None,)], "key string")
    bits = keyfilter.bits_for(5)
    filters = keyfilter.key_filter(stored, "key", bits)
    found = keyfilter.overlap_of_new_keys(new, stored, filters, key="key", split="split", bits=bits)
    assert rows(found) == [("(none)", 1), ("test", 1), ("train", 1)]


def test_merged_report_equals_the_whole(spark):
    df = small_table(spark, [(i, "ab"[i % 2] if i % 5 else None, i % 4) for i in range(50)], "k int, s string, n int")
    all_rules = [
        rules.required_columns(df, ["k", "s"]), rules.column_type(df, "n", "int"), rules.not_null("s"), rules.row_count(50),
        rules.vocabulary("s", ["a", "b", "c"]), rules.vocabulary("s", ["a", "b"], ignore_nulls=True),
        rules.vocabulary("n", [0, 1], mode="subset"), rules.single_value("n", 3), rules.label_range("n", 4),
    ]
    shards = [df.where(F.pmod("k", F.lit(4)) == i) for i in range(4)] + [df.where("k < 0")]
    states = None
    for shard in shards:
        own = rules.rule_states(shard, all_rules)
        states = own if states is None else states.unionByName(own)
    assert rows(rules.merged_report(states, all_rules)) == rows(rules.validation_report(df, all_rules))
    with pytest.raises(ValueError):
        rules.merged_report(states, [])


def test_second_partitioning_grows_with_the_table(spark, tmp_path):
    """Line items of one part, too, are dealt to as many partitions as the scan has, not to five."""
    schema = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").schema
    columns = [F.lit(7).cast(f.dataType).alias(f.name) if f.name == "l_partkey" else
               F.col("id").cast(f.dataType).alias(f.name) if f.name == "l_orderkey" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(3000).repartition(40).select(*columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        scan = spark.read.parquet(str(tmp_path / "lineitem.parquet")).rdd.getNumPartitions()
        found = QUERIES["bucket_fingerprints"](spark, str(tmp_path))
        numbers = {int(n) for n in re.findall(r", (\d+)\), REPARTITION_BY_NUM", plan_of(found))}
        assert numbers == {scan} and scan > 8
        assert found.first() == (3000, 3000, True)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
