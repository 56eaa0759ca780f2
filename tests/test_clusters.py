"""Clusters against a union of all pairs, one by one."""

import itertools
import random

import pytest
from conftest import plan_of, rows
from test_neardup import crowded_hashes, distance, flipped, sample_hashes

from sortwell.functions.hashing import signed64
from sortwell.operators import clusters
from sortwell.session import small_table


def joined_by_hand(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def clusters_by_hand(data, d=5):
    close = [(a[0], b[0]) for a, b in itertools.combinations(data, 2) if distance(a[1], b[1]) <= d]
    links = dict.fromkeys((k for k, _ in data), 0)
    for a, b in close:
        links[a] += 1
        links[b] += 1
    of = joined_by_hand([k for k, _ in data], close)
    size = {c: list(of.values()).count(c) for c in set(of.values())}
    return sorted((k, of[k], size[of[k]], links[k]) for k, _ in data)


def chain(n, seed=4):
    """Hashes each three bits from the one before, and hardly any other close pair."""
    rng = random.Random(seed)
    value, out = rng.getrandbits(64), []
    for _ in range(n):
        out.append(value)
        value = flipped(value, 3, rng)
    rng.shuffle(out)
    return [(f"c{i:04d}", signed64(v)) for i, v in enumerate(out)]


def ball(n=300, seed=6):
    """Hashes of which any two are close."""
    base = random.Random(seed).getrandbits(64)
    bits = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i, j in itertools.combinations(range(64), 2))]
    return [(f"b{i:04d}", signed64(base ^ x)) for i, x in enumerate(bits[:n])]


CASES = {"sample": sample_hashes(), "crowded": crowded_hashes(), "chain": chain(60), "ball": ball()}


@pytest.mark.parametrize(
    "name,bands,bucket_rows",
    [("sample", "auto", 10_000), ("crowded", "8", 20), ("chain", "triples", 10_000), ("chain", "t+1", 3), ("ball", "auto", 10_000)],
)
def test_clusters_equal_brute_force(spark, name, bands, bucket_rows):
    df = small_table(spark, CASES[name], "key string, hash bigint")
    found = clusters.near_dup_clusters(df, key="key", hash_col="hash", bands=bands, bucket_rows=bucket_rows, hot_rows=50)
    assert found.columns == ["key", "cluster", "cluster_size", "n_links"]
    assert rows(found) == clusters_by_hand(CASES[name])


def test_distance_zero(spark):
    df = small_table(spark, sample_hashes(), "key string, hash bigint")
    found = clusters.near_dup_clusters(df, key="key", hash_col="hash", max_distance=0)
    assert rows(found) == clusters_by_hand(sample_hashes(), 0)


def test_keys_without_hash_are_left_out(spark):
    df = small_table(spark, [("a", 1), ("b", None), ("c", 1)], "key string, hash bigint")
    assert rows(clusters.near_dup_clusters(df, key="key", hash_col="hash")) == [("a", "a", 2, 1), ("c", "a", 2, 1)]
    assert rows(clusters.near_dup_clusters(df.where("key = 'b'"), key="key", hash_col="hash")) == []


def test_pairs_are_aggregated_where_they_are_found(spark):
    """Between the join of the hashes and the next shuffle stands a partial aggregation."""
    nodes = small_table(spark, [(h, 1, h) for _, h in ball(40)], "hash bigint, n_keys bigint, label bigint")
    plan = plan_of(clusters._links(nodes, 5, "auto", 10_000))
    before_join = plan[: plan.index("SortMergeJoin")]
    assert before_join.count("Exchange hashpartitioning(hash") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    last = before_join.rindex("Exchange hashpartitioning(hash")
    assert "partial_sum" in before_join[last:] and "partial_min" in before_join[last:]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(300))
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.choice([60, 150, 400]))]
    edges += [(0, i) for i in range(100, 200)] + [(i, i + 1) for i in range(200, 299)] + [(5, 5), (1, 0), (0, 1)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    seen = {n for a, b in edges if a != b for n in (a, b)}
    want = joined_by_hand(sorted(seen), [e for e in edges if e[0] != e[1]])
    assert dict(map(tuple, clusters.components(df).collect())) == want
    assert clusters.components(df.where("a < 0")).count() == 0
