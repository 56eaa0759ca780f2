"""Near duplicates: 64-bit hashes within a Hamming distance, found by exact blocking.

Keys with equal hashes form one group, represented by its smallest key; the result holds one row per
further member (distance 0) and one row per pair of groups whose hashes are close. Two keys are near
duplicates exactly when they are in one group or their groups are paired, so nothing is lost, and a
hash held by a third of all rows does not turn into n^2 rows. Pairs of different hashes are listed
one by one: m hashes that are all close to each other still give up to m * (m - 1) / 2 rows.
`clusters.near_dup_clusters` has one row per key instead.

Blocking: cut the 64 bits into `blocks` parts. Two hashes at distance d differ in at most d parts,
so at least `blocks - d` parts agree, and every choice of that many parts is one join key. More
blocks mean more and longer keys. Recall is complete for any number of blocks above d.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sortwell.functions.hashing import bit_bands, hamming64, signed64
from sortwell.operators.groups import attach_to_members
from sortwell.session import lookup_side, one_row, settled, small_table, widened

# Hashes of a just crowded bucket that its sample holds on average.
SAMPLED_PER_BUCKET = 50
# Cost of comparing a pair, in shuffled rows.
PAIR_COST = 0.1
# Blocks that make one of the longer keys of a crowded bucket.
LONGER_MATCHED = 3
# Hashes that one task gives a key for each of 255 sets of bands.
COUNTED_PER_TASK = 8192
PAIR_COUNT = "decimal(38,0)"  # n * (n - 1) / 2 leaves BIGINT from about 4e9 rows on


@dataclass(frozen=True)
class Blocks:
    """How hash bits are cut into blocks, and how many blocks make one join key."""

    blocks: int
    matched: int

    def block_masks(self, bits: list[int] | None = None) -> list[int]:
        """Bit mask of each block: contiguous over all 64 bits, or interleaved over `bits`."""
        if bits is None:
            edges = [64 * i // self.blocks for i in range(self.blocks + 1)]
            return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
        return [sum(1 << b for b in bits[i :: self.blocks]) for i in range(self.blocks)]

    def keys(self, bits: list[int] | None = None) -> list[tuple[int, int]]:
        """(set of blocks as a bit set, bit mask of their union) for every join key."""
        masks = self.block_masks(bits)
        return [
            (sum(1 << b for b in chosen), sum(masks[b] for b in chosen))
            for chosen in itertools.combinations(range(self.blocks), self.matched)
        ]


def choose_blocks(n_hashes: int, max_distance: int) -> Blocks:
    """The cheapest scheme for this many distinct hashes.

    Cost is keys shuffled plus pairs compared, a pair counting as a tenth of a shuffled row.
    """

    def cost(blocks: int) -> float:
        matched = blocks - max_distance
        keys = math.comb(blocks, matched)
        bucket = n_hashes / 2 ** (64 * matched / blocks)
        return keys * (1 + bucket / 2 * PAIR_COST)

    best = min(range(max_distance + 1, min(max_distance + 8, 64)), key=cost)
    return Blocks(best, best - max_distance)


def block_scheme(bands: str | Blocks, n_hashes: int, max_distance: int) -> Blocks:
    """`bands`: "auto", "8" (single 8-bit bands), "t+1" (fewest, widest single bands),
    "triples" (as many of 8 bands as must agree), or an explicit scheme."""
    if isinstance(bands, Blocks):
        scheme = bands
    elif bands == "auto":
        scheme = choose_blocks(n_hashes, max_distance)
    else:
        named = {
            "8": Blocks(8, 1),
            "t+1": Blocks(max_distance + 1, 1),
            "triples": Blocks(8, 8 - max_distance),
        }
        if bands not in named:
            raise ValueError(f"bands must be auto, {', '.join(named)} or a Blocks value")
        scheme = named[bands]
    if not 1 <= scheme.matched <= scheme.blocks - max_distance:
        raise ValueError("this scheme would miss pairs at the given distance")
    return scheme


def _constant_rows(rows: list[tuple[int, int]], names: tuple[str, str]) -> Column:
    """Array of (INT, BIGINT) structs as one parsed expression; there may be hundreds of them."""
    items = (f"named_struct('{names[0]}', {i}, '{names[1]}', {signed64(v)}L)" for i, v in rows)
    return F.expr(f"array({', '.join(items)})")


def _keyed(hashes: DataFrame, scheme: Blocks) -> DataFrame:
    keys = _constant_rows(scheme.keys(), ("block_set", "mask"))
    return hashes.select("*", F.inline(keys)).select(
        "block_set", F.col("hash").bitwiseAND(F.col("mask")).alias("bucket"), *hashes.columns
    )


def _found_here(x: Column, block_set: Column, masks: list[int] | list[Column]) -> Column:
    """True only for the first of the keys on which a pair agrees, so each pair appears once.

    That is the key for which every block before its last one either belongs to it or differs.
    """
    cond = F.lit(True)
    for j, mask in enumerate(masks):
        later = F.shiftright(block_set, j)
        skipped = (later != 0) & (later.bitwiseAND(F.lit(1)) == 0)
        bits = F.lit(signed64(mask)).cast("bigint") if isinstance(mask, int) else mask
        differs = x.bitwiseAND(bits) != 0
        cond = cond & (~skipped | differs)
    return cond


def _pair(carried: list[str]) -> list[Column]:
    """hash_a < hash_b, their distance, and the carried columns of both, from joined sides a and b."""
    ordered = F.col("a.hash") < F.col("b.hash")
    other = {"a": "b", "b": "a"}
    return [
        F.least("a.hash", "b.hash").alias("hash_a"),
        F.greatest("a.hash", "b.hash").alias("hash_b"),
        hamming64("a.hash", "b.hash").alias("hash_distance"),
        *[F.when(ordered, F.col(f"{s}.{c}")).otherwise(F.col(f"{other[s]}.{c}")).alias(f"{c}_{s}") for c in carried for s in "ab"],
    ]


def _join_buckets(
    keyed: DataFrame, on: list[str], max_distance: int, masks: list[int], carried: list[str]
) -> DataFrame:
    # Both sides are the very same plan, so the keys are shuffled once and read twice. A merge join
    # walks a bucket row after row; looking a bucket up in a hash table took five times as long.
    a, b = keyed.alias("a"), keyed.alias("b").hint("merge")
    same_bucket = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    x = F.col("a.hash").bitwiseXOR(F.col("b.hash"))
    close = (
        (F.col("a.hash") < F.col("b.hash"))
        & (F.bit_count(x) <= max_distance)
        & _found_here(x, F.col("a.block_set"), masks)
    )
    return a.join(b, [*same_bucket, close]).select(*_pair(carried))


def _join_in_cells(
    keyed: DataFrame, on: list[str], max_distance: int, masks: list[int], bucket_rows: int,
    carried: list[str] = [], inner_masks: list[Column] | None = None, sizes: DataFrame | None = None,
) -> DataFrame:
    """The same join, with overfull buckets dealt to many tasks; with `sizes` (`on` and n), of the buckets
    listed there only.

    Rows of such a bucket are numbered into parts by their hash. Part i meets part j >= i in cell
    (i, j), so every pair of rows meets once and a cell holds about two parts. With `inner_masks` the
    buckets have an `inner_set` as well, and a pair counts for the first of these only.
    """
    how = "left" if sizes is None else "inner"
    if sizes is None:
        sizes = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows)
    parts = settled(sizes.select(*on, F.ceil(F.col("n") / bucket_rows).alias("parts")))
    part = F.pmod(F.xxhash64("hash"), F.coalesce("parts", F.lit(1).cast("bigint")))
    dealt = keyed.join(lookup_side(parts), on, how).withColumn("part", part)
    last = F.coalesce("parts", F.lit(1).cast("bigint")) - 1
    a = dealt.withColumns({"i": F.col("part"), "j": F.explode(F.sequence("part", last))}).alias("a")
    b = dealt.withColumns(
        {"i": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("part"))), "j": F.col("part")}
    ).alias("b")
    same_cell = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in [*on, "i", "j"]]
    x = F.col("a.hash").bitwiseXOR(F.col("b.hash"))
    close = (
        ((F.col("a.part") < F.col("b.part")) | (F.col("a.hash") < F.col("b.hash")))
        & (F.bit_count(x) <= max_distance)
        & _found_here(x, F.col("a.block_set"), masks)
    )
    if inner_masks:
        close = close & _found_here(x, F.col("a.inner_set"), inner_masks)
    return a.join(b.hint("merge"), [*same_cell, close]).select(*_pair(carried))


def _join_hot_buckets(
    hot: DataFrame, scheme: Blocks, max_distance: int, masks: list[int], bucket_rows: int, carried: list[str]
) -> DataFrame:
    """Pairs inside overfull buckets.

    Members of a bucket agree on its bits, so all differences lie in the other bits. Those are cut
    into interleaved blocks, and the same argument gives longer keys. What is still crowded after
    that is compared in cells. A pair that agrees on several of the longer keys counts for the first.
    """
    inner = Blocks(max_distance + LONGER_MATCHED, LONGER_MATCHED)
    rows, inner_masks = [], []
    for number, (block_set, mask) in enumerate(scheme.keys()):
        rest = [b for b in range(64) if not mask >> b & 1]
        inner_masks.append([signed64(m) for m in inner.block_masks(rest)])
        rows += [
            (block_set, number, inner_set, signed64(mask | m)) for inner_set, m in inner.keys(rest)
        ]
    longer = small_table(
        hot.sparkSession, rows, "block_set int, outer_key int, inner_set int, longer_mask bigint"
    )
    keyed = hot.join(F.broadcast(longer), "block_set").select(
        "block_set",
        "outer_key",
        "inner_set",
        F.col("hash").bitwiseAND(F.col("longer_mask")).alias("bucket"),
        "hash",
        *carried,
    )
    # The masks of a bucket's blocks, found by the number of its key.
    table = ", ".join(f"array({', '.join(f'{m}L' if m > -(1 << 63) else 'long(-9223372036854775808)' for m in row)})" for row in inner_masks)
    of_bucket = F.get(F.expr(f"array({table})"), F.col("a.outer_key"))
    on = ["bucket", "inner_set", "block_set"]
    return _join_in_cells(
        keyed, on, max_distance, masks, bucket_rows, carried, [F.get(of_bucket, F.lit(j)) for j in range(inner.blocks)]
    )


def near_hash_pairs(
    hashes: DataFrame, *, max_distance: int = 5, bands: str | Blocks = "auto",
    bucket_rows: int = 10_000,
) -> DataFrame:
    """Pairs of distinct hashes within the distance: hash_a < hash_b, hash_distance.

    `hashes` has one BIGINT column `hash` without repeats, already settled; each of its other columns
    comes along twice, as `<name>_a` and `<name>_b`. Buckets above `bucket_rows` are refined; no pair
    is skipped or found twice, so pairs can be aggregated as they come out of the join.
    """
    n = hashes.count()
    scheme = block_scheme(bands, n, max_distance)
    carried = [c for c in hashes.columns if c != "hash"]
    if max_distance == 0:
        types = dict(hashes.dtypes)
        own = "".join(f", {c}_{s} {types[c]}" for c in carried for s in "ab")
        return small_table(hashes.sparkSession, [], f"hash_a bigint, hash_b bigint, hash_distance int{own}")
    masks = scheme.block_masks()
    # The bucket comes first: sorting compares the first column fast, and few rows tie there.
    on = ["bucket", "block_set"]
    keyed = _keyed(widened(hashes, "hash"), scheme)
    # Crowded buckets show in a fixed sample of the hashes, which is small enough to be counted by
    # bucket. A bucket that it misses is still joined in full, only less evenly.
    rate = max(1, bucket_rows // SAMPLED_PER_BUCKET)
    sample = hashes.select("hash").where(F.pmod(F.xxhash64("hash"), F.lit(rate)) == 0)
    crowded = settled(
        _keyed(sample, scheme).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") * rate > bucket_rows).select(*on, (F.col("n") * rate).alias("n"))
    )
    if crowded.isEmpty():
        return _join_buckets(keyed, on, max_distance, masks, carried)
    light = keyed.join(lookup_side(crowded.select(*on)), on, "left_anti")
    found = _join_buckets(light, on, max_distance, masks, carried)
    # Where cells at once cost a row less than its longer keys would, they are taken.
    dear = F.col("n") / bucket_rows + 1 + F.col("n") / 2 * PAIR_COST > math.comb(max_distance + LONGER_MATCHED, LONGER_MATCHED)
    cheap, hot = settled(crowded.where(~dear)), settled(crowded.where(dear).select(*on))
    if not cheap.isEmpty():
        found = found.unionByName(_join_in_cells(keyed, on, max_distance, masks, bucket_rows, carried, sizes=cheap))
    if not hot.isEmpty():
        hot = keyed.join(lookup_side(hot), on, "left_semi")
        found = found.unionByName(_join_hot_buckets(hot, scheme, max_distance, masks, bucket_rows, carried))
    return found


def collapse_hashes(hashes: DataFrame, *, key: str, hash_col: str) -> DataFrame:
    """One row per distinct hash: hash, its smallest key, its number of keys.

    Rows without a hash count zero and drop out after the aggregation; a filter before it would
    make Spark work out a computed hash twice.
    """
    groups = hashes.groupBy(F.col(hash_col).alias("hash")).agg(
        F.min(key).alias("first_key"), F.count(hash_col).alias("n_keys")
    )
    return groups.where(F.col("n_keys") > 0)


def near_duplicates(
    hashes: DataFrame, *, key: str, hash_col: str, max_distance: int = 5,
    bands: str | Blocks = "auto", bucket_rows: int = 10_000, hot_rows: int = 1_000_000,
) -> DataFrame:
    """Near-duplicate relations key_a < key_b with their distance (see the module text).

    Rows with a null hash (unreadable content) are left out.
    """
    rows = settled(hashes.select(F.col(key).alias("_key"), F.col(hash_col).alias("hash")))
    groups = settled(collapse_hashes(rows, key="_key", hash_col="hash"))
    stars = attach_to_members(
        rows, groups.where(F.col("n_keys") > 1), "hash", spread_by="_key", size_col="n_keys",
        hot_rows=hot_rows,
    )
    in_group = stars.where(F.col("_key") != F.col("first_key")).select(
        F.col("first_key").alias("key_a"), F.col("_key").alias("key_b"), F.lit(0).alias("hash_distance")
    )
    pairs = near_hash_pairs(
        groups.select("hash"), max_distance=max_distance, bands=bands, bucket_rows=bucket_rows
    )
    first = groups.select("hash", "first_key")
    across = (
        pairs.join(first.toDF("hash_a", "_a"), "hash_a")
        .join(first.toDF("hash_b", "_b"), "hash_b")
        .select(
            F.least("_a", "_b").alias("key_a"), F.greatest("_a", "_b").alias("key_b"), "hash_distance"
        )
    )
    return in_group.unionByName(across)


def sort_pairs(pairs: DataFrame) -> DataFrame:
    """By distance, then by keys so that ties have an order."""
    return pairs.orderBy("hash_distance", "key_a", "key_b")


def band_buckets(hashes: DataFrame, *, key: str, hash_col: str, n: int = 8) -> DataFrame:
    """The blocking table: for each (band, chunk) the number of keys and of candidate pairs.

    Candidate pairs are counted, not listed: their number grows with the square of the rows, and
    only those within the distance are of use, which `near_duplicates` finds directly.
    """
    groups = collapse_hashes(hashes, key=key, hash_col=hash_col)
    size = F.sum("n_keys").cast(PAIR_COUNT)
    return (
        groups.select("n_keys", F.posexplode(bit_bands("hash", n)).alias("band", "chunk"))
        .groupBy("band", "chunk")
        .agg(F.sum("n_keys").alias("n_keys"), _pairs(size).alias("n_pairs"))
    )


def _pairs(size: Column) -> Column:
    """size * (size - 1) / 2, exact, as DECIMAL(38,0)."""
    n = size.cast("decimal(18,0)")
    return ((n * (n - F.lit(1).cast("decimal(1,0)"))) / F.lit(2).cast("decimal(1,0)")).cast(PAIR_COUNT)


def candidate_pair_count(groups: DataFrame, n: int = 8) -> DataFrame:
    """Number of distinct key pairs that agree on at least one of `n` bands.

    By inclusion and exclusion over the band subsets: one aggregation over 2^n - 1 keys per hash,
    without listing a single pair. `groups` is the settled result of `collapse_hashes`.
    """
    masks = Blocks(n, 1).block_masks()
    subsets = [
        (1 if size % 2 else -1, sum(chosen))
        for size in range(1, n + 1)
        for chosen in itertools.combinations(masks, size)
    ]
    keys = _constant_rows(subsets, ("sign", "mask"))
    # Nearly every bucket of a task has one row, so its table for adding up grows with its hashes.
    cores = groups.sparkSession.sparkContext.defaultParallelism
    buckets = (
        groups.repartition(max(cores, math.ceil(groups.count() / COUNTED_PER_TASK)), "hash")
        .select("hash", "n_keys", F.inline(keys))
        .groupBy("sign", "mask", F.col("hash").bitwiseAND(F.col("mask")).alias("bucket"))
        .agg(F.sum("n_keys").alias("n"))
        .where(F.col("n") > 1)
    )
    signed = F.when(F.col("sign") > 0, _pairs(F.col("n"))).otherwise(-_pairs(F.col("n")))
    return buckets.agg(
        F.coalesce(F.sum(signed), F.lit(0)).cast(PAIR_COUNT).alias("n_candidates")
    )


def near_dup_summary(
    hashes: DataFrame, *, key: str, hash_col: str, max_distance: int = 5, bands: str | Blocks = "auto",
    candidates: bool = False,
) -> DataFrame:
    """One row: keys hashed and not hashed, groups of equal hashes, near pairs, and on demand the
    candidate pairs under 8 bands, a diagnostic that takes 255 keys per hash.

    Pair counts are those of all key pairs, worked out from group sizes.
    """
    every = settled(hashes.groupBy(F.col(hash_col).alias("hash")).agg(F.count(F.lit(1)).alias("n_keys")))
    groups = every.where(F.col("hash").isNotNull())
    unhashed = every.where(F.col("hash").isNull()).agg(F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_unhashed"))
    sizes = groups.select("hash", "n_keys")
    product = (
        F.col("n_a").cast("decimal(18,0)") * F.col("n_b").cast("decimal(18,0)")
    ).cast(PAIR_COUNT)
    across = (
        near_hash_pairs(groups.select("hash"), max_distance=max_distance, bands=bands)
        .join(sizes.toDF("hash_a", "n_a"), "hash_a")
        .join(sizes.toDF("hash_b", "n_b"), "hash_b")
        .agg(F.coalesce(F.sum(product), F.lit(0)).cast(PAIR_COUNT).alias("pairs_across"))
    )
    within = groups.agg(
        F.coalesce(F.sum("n_keys"), F.lit(0)).alias("n_hashed"),
        F.count_if(F.col("n_keys") > 1).alias("n_exact_groups"),
        F.coalesce(F.sum(_pairs(F.col("n_keys"))), F.lit(0)).cast(PAIR_COUNT).alias("pairs_within"),
    )
    parts = [within, unhashed, across, *([candidate_pair_count(groups)] if candidates else [])]
    return one_row(*parts).select(
        "n_hashed",
        "n_unhashed",
        "n_exact_groups",
        *(["n_candidates"] if candidates else []),
        (F.col("pairs_within") + F.col("pairs_across")).cast(PAIR_COUNT).alias("n_near_pairs"),
    )


def near_dup_leakage(
    hashes: DataFrame, splits: DataFrame, *, key: str, hash_col: str, split: str = "split",
    max_distance: int = 5, bands: str | Blocks = "auto",
) -> DataFrame:
    """Near duplicates that straddle two splits.

    One row per pair of (hash, split) groups in different splits, split_a < split_b, each with its
    smallest key and its number of keys; n_a * n_b key pairs leak. `splits` has one row per key.
    """
    nodes = settled(
        hashes.select(key, F.col(hash_col).alias("hash"))
        .join(splits.select(key, F.col(split).alias("split")), key)
        .groupBy("hash", "split")
        .agg(F.min(key).alias("key"), F.count("hash").alias("n"))
        .where(F.col("n") > 0)
    )
    a = nodes.toDF("hash_a", "split_a", "key_a", "n_a")
    b = nodes.toDF("hash_b", "split_b", "key_b", "n_b")
    out = ["split_a", "key_a", "n_a", "split_b", "key_b", "n_b", "hash_distance"]
    # A hash has at most one node per split, so this self join stays linear.
    same = a.join(
        b, (F.col("hash_a") == F.col("hash_b")) & (F.col("split_a") < F.col("split_b"))
    ).withColumn("hash_distance", F.lit(0))
    pairs = near_hash_pairs(settled(nodes.select("hash").distinct()), max_distance=max_distance, bands=bands)
    # Both orders of a pair from one evaluation of the join.
    orders = [
        F.struct(F.col(x).alias("hash_a"), F.col(y).alias("hash_b"), "hash_distance")
        for x, y in (("hash_a", "hash_b"), ("hash_b", "hash_a"))
    ]
    both_ways = pairs.select(F.inline(F.array(*orders)))
    close = both_ways.join(a, "hash_a").join(b, "hash_b").where(F.col("split_a") < F.col("split_b"))
    return same.select(*out).unionByName(close.select(*out))
