"""Exact dedup and the n-gram Jaccard join against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from odd import jaccard_components, no_documents, odd_documents, odd_rows

from sortwell.llm import exactdedup, jaccard_join
from sortwell.llm.common import documents, rows_with
from sortwell.operators.clusters import components


def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    out = []
    for i, text in rows:
        norm = re.sub("[\x20\x09-\x0d]+", " ", text or "")
        ids = [x for x in groups[norm] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[norm]), keep == i, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("bucket_bytes", [200, 1 << 25])
def test_exact_groups(spark, bucket_bytes):
    found = exactdedup.exact_groups(odd_documents(spark), bucket_bytes=bucket_bytes)
    assert sorted(map(tuple, found.collect()), key=str) == exact_by_hand([r[:2] for r in odd_rows()])


def test_exact_groups_of_whole_table(spark, sf):
    docs = documents(spark, sf, "doc_id", "text")
    want = exact_by_hand([tuple(r) for r in docs.collect()])
    assert sorted(map(tuple, exactdedup.exact_groups(docs).collect()), key=str) == want


def test_every_owner_has_one_range_of_keys(spark):
    """300 buckets of texts: a file of the index holds one bucket, and ranges don't overlap."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    text = exactdedup.normalised()
    keys = docs.select("doc_id", F.xxhash64(text).alias("h"), F.unhex(F.sha2(text, 256)).alias("sha"), F.octet_length(text).alias("size"))
    index, total = exactdedup.build_index(docs, keys, "doc_id", 200, 12)
    top = F.shiftrightunsigned("h", 1)
    files = index.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count_distinct("bucket").alias("buckets"), F.min(top).alias("low"), F.max(top).alias("high")).orderBy("low").collect()
    assert total == 3000 and len(files) > 200 and {r.buckets for r in files} == {1}
    assert all(a.high < b.low for a, b in zip(files, files[1:]))


def test_rows_of_an_often_repeated_id_stay_complete(spark):
    rows = [(i, f"text {i}") for i in range(3000)] + [(7, "text 7")] * 500 + [(None, "no id")] * 400 + [(8, "gone")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    kept = spark.createDataFrame([(7,), (7,), (None,), (20,), (5000,)], "kept_id bigint")
    found = sorted((tuple(r) for r in rows_with(docs, kept, "doc_id").collect()), key=str)
    assert found == sorted([r for r in rows if r[0] in (7, None, 20)], key=str)


def test_exact_empty(spark):
    assert exactdedup.exact_groups(no_documents(spark)).count() == 0
    kept = exactdedup.without_copies(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert kept.where("doc_id = 3").count() == 0 and kept.where("doc_id = 1").count() == 1


def test_directory_splits_only_overfull_buckets():
    sizes = np.array([50, 1, 1, 1, 1, 1, 1, 1])
    first, depth = exactdedup.directory(sizes, 10)
    assert first.tolist() == [0, 1, 2, 4] and depth.tolist() == [3, 3, 2, 1]
    assert exactdedup.directory(np.zeros(8, dtype=np.int64), 10)[0].tolist() == [0]


def test_colliding_keys_are_chained():
    rows = [(0, 7, "a", 5, 1, b"A"), (0, 7, "b", 4, 2, b"B"), (0, 7, "a", 3, 1, b"A"), (1, 9, "a", 1, 1, b"A")]
    assert list(exactdedup.chained(rows)) == [(0, 7, b"A", 3, 2), (0, 7, b"B", 4, 2), (1, 9, b"A", 1, 1)]
    held = list(exactdedup.collapsed([(7, "a", 5), (7, "b", None), (7, "a", 2)], 1 << 20))
    assert held == [(7, "a", 2, 2), (7, "b", None, 1)]
    assert len(list(exactdedup.collapsed([(7, "a", 5), (7, "a", 2)], 1))) == 2


def near_copies(n, seed, words=120, changes=6):
    """Copies of one text with a few words changed each, others that share a passage, and noise."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    origin = [rnd.choice(vocabulary) for _ in range(words)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    texts = []
    for i in range(n):
        kind = rnd.random()
        if kind < 0.6:
            text = list(origin)
            for _ in range(rnd.randint(0, changes)):
                text[rnd.randrange(words)] = rnd.choice(vocabulary)
            texts.append(text)
        elif kind < 0.8:
            texts.append([rnd.choice(vocabulary) for _ in range(30)] + passage)
        else:
            texts.append([rnd.choice(vocabulary) for _ in range(rnd.randint(0, 50))])
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("blocks", [(2000, 1_500_000, 64), (12, 1_500_000, 64), (12, 1_500_000, 3), (2000, 900, 1)])
def test_jaccard_components(spark, blocks):
    texts = near_copies(220, 5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    found = jaccard_join.jaccard_components(docs, block_nodes=blocks[0], block_entries=blocks[1],
                                              list_nodes=blocks[2], counter_bits=10)
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in found.collect()}
    component, sizes = jaccard_components(texts)
    assert got == {i: (component[i], sizes[i]) for i in range(len(texts))}


def test_jaccard_odd_rows_and_empty_table(spark):
    rows = odd_rows()
    found = jaccard_join.jaccard_components(odd_documents(spark))
    component, sizes = jaccard_components([r[1] for r in rows])
    ids = defaultdict(list)
    for c, r in zip(component, rows):
        if r[0] is not None:
            ids[c].append(r[0])
    want = sorted(((r[0], n, min(ids[c]) if ids[c] else None) for r, n, c in zip(rows, sizes, component)), key=str)
    assert sorted((tuple(r)[:3] for r in found.collect()), key=str) == want
    assert jaccard_join.jaccard_components(no_documents(spark)).count() == 0
    kept = jaccard_join.one_of_each(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns and kept.where("doc_id in (3, 11, 13)").count() == 0


def test_common_shingles_stand_out_of_full_counters(spark):
    """1,000 texts of 97 shingles for 256 counters; a passage of 60 texts still has the highest levels."""
    passage = " ".join(f"p{i}" for i in range(10))
    texts = [" ".join(f"w{i}x{k}" for k in range(90)) + (" " + passage if i < 60 else "") for i in range(1000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    levels = jaccard_join.counters(docs, 8)
    shared = next(jaccard_join.shingle_sets([passage])) >> np.uint64(56)
    assert levels[shared].min() > np.median(levels)


def test_few_shingles_in_long_lists_tie_no_nodes(spark):
    """The prefixes of a text of 200 shingles and of one of 170, the smallest it can link to, share six."""
    def lists(shared):
        rows = [(node, 200, h) for node in range(10) for h in range(shared)]
        rows += [(node, 200, 1000 + 10 * node + k) for node in range(10) for k in range(3)]
        postings = spark.createDataFrame(rows, "node bigint, n bigint, h bigint").coalesce(1)
        pairs, found = jaccard_join.candidates(postings, 85, 3)
        return pairs.count(), {r.node for r in found.where("h < 1000").collect()}

    assert lists(2) == (0, set())
    assert lists(6) == (0, set(range(10)))


def test_chain_of_links_is_one_component(spark):
    """Neighbours link, ends do not."""
    words = [f"t{i}" for i in range(160)]
    texts = [" ".join(words[k : k + 100]) for k in range(0, 60, 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for nodes, lists in ((4, 64), (4, 1), (2000, 64)):
        found = jaccard_join.jaccard_components(docs, block_nodes=nodes, list_nodes=lists)
        assert {r.component_id for r in found.collect()} == {0}


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000, 1000 + i) for i in range(1, 50)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {x: find(x) for x in got} and set(got) == {x for e in edges if e[0] != e[1] for x in e}
