from types import SimpleNamespace

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from sortwell import session


def test_settled_needs_a_shared_folder_on_a_cluster():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host")
    stub = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context, conf={}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.settled(stub)


def test_settled_uses_the_configured_folder():
    used = []
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host", setCheckpointDir=used.append)
    conf = {"spark.checkpoint.dir": "/shared"}
    stub = SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context, conf=conf), checkpoint=lambda: "done")
    assert session.settled(stub) == "done" and used == ["/shared"]


def test_settled_cuts_the_plan(spark):
    df = session.settled(spark.range(10).groupBy((F.col("id") % 2).alias("p")).count())
    assert "Exchange" not in plan_of(df) and rows(df) == [(0, 5), (1, 5)]


def test_bounded_copy(spark):
    df = spark.range(10)
    assert session.bounded_copy(df, 9) is None
    assert rows(session.bounded_copy(df, 10)) == [(i,) for i in range(10)]
    other = spark.range(20)
    assert "BroadcastHashJoin" in plan_of(other.join(session.lookup_side(df, 10), "id"))
    assert "Broadcast" not in plan_of(other.hint("merge").join(session.lookup_side(df, 9), "id"))


def test_bound_of_a_long_table_reads_few_partitions(spark):
    read = spark.sparkContext.accumulator(0)

    def count(stream):
        read.add(1)
        yield from stream

    df = spark.range(0, 100_000, 1, 200)
    counted = df.mapInArrow(count, df.schema)
    assert session.bounded_copy(counted, 900) is None
    assert read.value < 50


def test_small_table_types_and_empty(spark):
    df = session.small_table(spark, [("a", 1, [1.5])], "s string, i bigint, v array<float>")
    assert [t for _, t in df.dtypes] == ["string", "bigint", "array<float>"]
    assert session.small_table(spark, [], "s string").count() == 0
    assert "LocalTableScan" in plan_of(df)


def test_one_row(spark):
    a = spark.range(3).agg(F.count("id").alias("n"))
    b = spark.range(5).agg(F.sum("id").alias("total"))
    assert tuple(session.one_row(a, b).first()) == (3, 10)
