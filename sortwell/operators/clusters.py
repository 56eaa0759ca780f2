"""Clusters: connected components of links, and of near duplicates without a list of their pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.operators.groups import HOT_SHARE, attach_to_members, joined_by_size
from sortwell.operators.neardup import Blocks, collapse_hashes, near_hash_pairs
from sortwell.session import settled

KEY_COUNT = "decimal(38,0)"
# Rows of a pair of nodes in one partition.
PAIRS_PER_PARTITION = 250_000


def _with_least(rows: DataFrame, most: int) -> DataFrame:
    """`rows` (u, v; settled or a union of settled ones, `most` of them at most) with m, the smallest v of
    each u. Nodes with more than a thousandth of `most` rows, fewer than a thousand nodes, are fetched and
    broadcast; the others are joined."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    hot = least.where(F.col("n") > most // HOT_SHARE).select("u", "m").collect()
    if not hot:
        return rows.join(least.select("u", "m"), "u")
    table = F.broadcast(rows.sparkSession.createDataFrame([tuple(r) for r in hot], least.select("u", "m").schema))
    rest = rows.join(table.select("u"), "u", "left_anti")
    return rows.join(table, "u").unionByName(rest.join(least.select("u", "m"), "u"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for every node of an undirected edge list.

    Rounds of large and small stars (Kiveris et al. 2014), a logarithmic number of them: the neighbours
    of a node are pointed at the smallest one. Minima are aggregated, which combines before the
    shuffle, and neighbours stay rows; a node with more than a thousandth of all rows gets its minimum
    to them by a broadcast, so no task receives a hot node. A round's result cuts its lineage.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")
    pairs, before = settled(pairs.distinct()), None
    cores = edges.sparkSession.sparkContext.defaultParallelism

    def few(rows: DataFrame) -> DataFrame:
        """As many partitions as the pairs need: a round writes and reads each of them several times."""
        return rows.coalesce(max(cores, now[0] // PAIRS_PER_PARTITION))

    def checksum() -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast(KEY_COUNT))).first())

    now = checksum()
    pairs = few(pairs)
    # A round that leaves the same pairs has come to the end.
    while now != before:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * now[0]).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = settled(few(large.distinct()))
        ends = [F.struct(F.col(x).alias("u"), F.col("m").alias("v")) for x in "vu"]
        small = _with_least(large, 2 * now[0]).select(F.inline(F.array(*ends))).where("u != v")
        pairs, before = settled(few(small.distinct())), now
        now = checksum()
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _links(nodes: DataFrame, max_distance: int, bands: str | Blocks, bucket_rows: int) -> DataFrame:
    """hash, n_links (keys of close hashes), other (smallest label of a close hash with another label).

    `nodes` has hash, n_keys and label. Pairs go from the join into the aggregation, which combines
    before its shuffle; they are never written out.
    """
    pairs = near_hash_pairs(nodes, max_distance=max_distance, bands=bands, bucket_rows=bucket_rows)
    unlike = F.col("label_a") != F.col("label_b")
    ends = [
        F.struct(F.col(f"hash_{x}").alias("hash"), F.col(f"n_keys_{y}").alias("n"), F.when(unlike, F.col(f"label_{y}")).alias("label"))
        for x, y in ("ab", "ba")
    ]
    return pairs.select(F.inline(F.array(*ends))).groupBy("hash").agg(
        F.sum(F.col("n").cast(KEY_COUNT)).cast(KEY_COUNT).alias("n_links"), F.min("label").alias("other")
    )


def hash_clusters(
    groups: DataFrame, *, max_distance: int = 5, bands: str | Blocks = "auto", bucket_rows: int = 10_000
) -> DataFrame:
    """hash, n_links, label for every hash that has another one within the distance; settled.

    `groups` has one row per distinct hash and its n_keys. Labels are joined as in Borůvka's minimum
    spanning tree: every set of hashes is linked with the smallest set it touches, so each round at
    least halves the number of sets that touch another. A round repeats the join of hashes, from the
    second on only for hashes with a link, and keeps one row per hash: m hashes that are all close to
    each other cost m rows, not m * (m - 1) / 2.
    """
    options = {"max_distance": max_distance, "bands": bands, "bucket_rows": bucket_rows}
    nodes = groups.select("hash", "n_keys", F.col("hash").alias("label"))
    links = settled(_links(settled(nodes), **options))
    merged = components(links.select(F.col("hash").alias("a"), F.col("other").alias("b")))
    linked = settled(
        links.join(merged.toDF("hash", "label"), "hash").join(groups.select("hash", "n_keys"), "hash")
        .select("hash", "n_keys", "n_links", "label")
    )
    while True:
        again = _links(linked.select("hash", "n_keys", "label"), **options).where(F.col("other").isNotNull())
        touching = settled(
            again.join(linked.select("hash", "label"), "hash").groupBy("label").agg(F.min("other").alias("other"))
        )
        if touching.isEmpty():
            return linked.select("hash", "n_links", "label")
        merged = components(touching.select(F.col("label").alias("a"), F.col("other").alias("b")))
        sizes = linked.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
        renamed = settled(
            sizes.join(merged.toDF("label", "next"), "label", "left").select("label", "n", F.coalesce("next", "label").alias("next"))
        )
        joined = joined_by_size(linked, renamed, "label", size="n", total=linked.count())
        linked = settled(joined.select("hash", "n_keys", "n_links", F.col("next").alias("label")))


def near_dup_clusters(
    hashes: DataFrame, *, key: str, hash_col: str, max_distance: int = 5, bands: str | Blocks = "auto",
    bucket_rows: int = 10_000, hot_rows: int = 1_000_000,
) -> DataFrame:
    """One row per key with a hash: key, cluster (smallest key that chains of near duplicates reach,
    itself included), cluster_size (its keys) and n_links (other keys within the distance).

    Complete, and linear in the rows whatever the number of pairs. Keys without a hash are left out.
    """
    rows = settled(hashes.select(F.col(key).alias("_key"), F.col(hash_col).alias("hash")))
    groups = settled(collapse_hashes(rows, key="_key", hash_col="hash"))
    found = hash_clusters(
        groups.select("hash", "n_keys"), max_distance=max_distance, bands=bands, bucket_rows=bucket_rows
    )
    labelled = settled(
        groups.join(found, "hash", "left").select(
            "hash", "first_key", "n_keys", F.coalesce("label", "hash").alias("label"),
            (F.coalesce("n_links", F.lit(0)) + F.col("n_keys") - 1).cast("bigint").alias("n_links"),
        )
    )
    clusters = settled(
        labelled.groupBy("label").agg(
            F.min("first_key").alias("cluster"), F.sum("n_keys").alias("cluster_size"), F.count(F.lit(1)).alias("n_hashes")
        )
    )
    of_hash = joined_by_size(labelled, clusters, "label", size="n_hashes", total=groups.count()).select(
        "hash", "n_keys", "cluster", "cluster_size", "n_links"
    )
    found = attach_to_members(rows, of_hash, "hash", spread_by="_key", size_col="n_keys", hot_rows=hot_rows)
    return found.select(F.col("_key").alias(key), "cluster", "cluster_size", "n_links")
