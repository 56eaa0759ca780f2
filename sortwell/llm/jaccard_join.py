"""N-gram Jaccard join: near duplicates by a blocked sparse product of documents and n-grams.

A text's set holds its distinct shingles of four words (all its words as one, if fewer). Two texts
link when 100 * shared >= PERCENT * all. The result is the connected components of all links.

1. Texts with equal sets form one class; a class has one node from here on.
2. Size bounds give a prefix. In any common order of shingles, the first n - ceil(0.85 n) + m of
   two linked texts share at least m. The order puts shingles of rarely used counters first, so that
   passages many texts share come last; counters are a table of fixed size, filled by all texts. Once
   texts outnumber them, a rare shingle's counter holds many others too, so levels are fine: common
   shingles still stand out from these.
3. First product, over prefixes: nodes are dealt by shingle, overlap counts of pairs are added up,
   and pairs of unlike sizes or with fewer than m shared shingles are discarded. Only lists of at
   most `LIST_NODES` nodes give pairs. What a pair may share in long lists is allowed for in its bound.
   Only a node with as many shingles in long lists as a link takes can have one without any pair; the
   nodes of a long list of which this holds are tied to their first one instead.
4. Components of these ties bound where links can be. Each is split into blocks of bounded size, and
   a block is one product of its rows with all its n-gram columns: overlaps are counted row by row,
   rows whose sizes rule out a link are left out, and a link inside a piece already joined isn't
   written.
5. Components of several blocks go on: two or three nodes of each piece found so far are compared in
   blocks of their own. Then nodes of different pieces that are still tied are compared completely,
   in cells of two blocks each. So nothing is lost, and a large group of copies costs one pass over
   its blocks and little more.

Shingles are 64-bit hashes, compared within one pair of texts. Defined results: null or empty text
has an empty set and is its own component; rows without an id don't count for the smallest id, and
a component of such rows only has a null id; repeated rows are in the same class. Only doc_id and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import MERGED_TASKS, lean, looked_up, rows_with, settled
from sortwell.operators.clusters import components

WORDS = 4
PERCENT = 85
# Shingles beyond the first that linked texts must share in their prefixes, in percent of the set.
EXTRA = 3
LIST_NODES = 64
COUNTER_BITS = 22
# Levels of a counter for each doubling of its count.
LEVELS = 256
SLICE = 1 << 15
BLOCK_NODES = 2_000
BLOCK_ENTRIES = 1_500_000
# Bytes of text hashed at once, or one text.
PIECE = 1 << 20

U = np.uint64
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of `data`, which begins and ends with white space or nothing."""
    blank = IS_SPACE[data]
    edge = np.diff(np.concatenate(([True], blank, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + U(1)) * powers(BASE, max(1, len(data)))[: len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * powers(INVERSE, max(1, len(data)))[starts]
    return starts, mix(value + (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    encoded = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes: only A-Z change
    first = 0
    while first < len(encoded):
        last, size = first + 1, len(encoded[first])
        while last < len(encoded) and size + len(encoded[last]) <= PIECE:
            size += len(encoded[last])
            last += 1
        lengths = np.fromiter((len(x) + 1 for x in encoded[first:last]), dtype=np.int64, count=last - first)
        data = np.frombuffer(b"\n".join(encoded[first:last]) + b"\n", dtype=np.uint8)
        starts, words = word_hashes(data)
        bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
        value = mix(words + U(1))
        for k in range(1, WORDS):
            value = mix(value[:-1] ^ (words[k:] * U(2 * k + 1)))
        for i in range(last - first):
            a, b = bounds[i], bounds[i + 1]
            if b - a >= WORDS:
                yield np.unique(value[a : b - WORDS + 1])
            elif b > a:
                whole = U(b - a)
                for w in words[a:b]:
                    whole = mix(np.array([whole ^ w], dtype=np.uint64))[0]
                yield np.array([whole], dtype=np.uint64)
            else:
                yield np.zeros(0, dtype=np.uint64)
        first = last


def shared_in_prefix(n):
    return 1 + EXTRA * n // 100


def least_by_long_lists(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles in long lists that a text of `n` needs for a link by long lists alone: what the smallest
    text that it can link to shares in its prefix."""
    return shared_in_prefix((percent * n + 99) // 100)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return min(n, n - (percent * n + 99) // 100 + shared_in_prefix(n))


def counters(docs: DataFrame, bits: int = COUNTER_BITS) -> np.ndarray:
    """How many texts use each counter, as a level, of which a doubling of the count has `LEVELS`."""
    size = min(SLICE, 1 << bits)

    def packed(total):
        """In as few bytes a counter as its largest count takes."""
        return total.astype(np.min_scalar_type(int(total.max()))).tobytes()

    def unpacked(data):
        return np.frombuffer(data, dtype=f"u{len(data) // size}")

    def count(stream):
        total = np.zeros(1 << bits, dtype=np.uint32)
        for batch in stream:
            for found in shingle_sets(batch.column(0).to_pylist()):
                total[found >> U(64 - bits)] += np.uint32(1)
        slices = [(k, packed(x)) for k, x in enumerate(total.reshape(-1, size))]
        part = TaskContext.get().partitionId() // MERGED_TASKS
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in slices], pa.int32()), pa.array([part] * len(slices), pa.int32()),
             pa.array([x for _, x in slices], pa.binary())],
            names=["slice", "part", "counts"],
        )

    def add(key, table):
        total = np.zeros(size, dtype=np.uint64)
        for x in table.column("counts"):
            total += unpacked(x.as_buffer().to_pybytes())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([0], pa.int32()),
                         "counts": pa.array([packed(total)], pa.binary())})

    # Tasks' counts are added up in two steps, so a group holds a bounded number of them.
    schema = "slice int, part int, counts binary"
    counted = docs.select("text").mapInArrow(lean(count), schema)
    summed = counted.groupBy("slice", "part").applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    levels = np.zeros(1 << bits, dtype=np.uint16)
    for row in summed.toLocalIterator():  # 2**bits counts in all
        levels[row.slice * size : (row.slice + 1) * size] = LEVELS * np.log2(unpacked(row.counts) + 1.0)
    return levels


def shingled(docs: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """k (hash of id and text), id, n, s1, s2 (signature of the set), prefix: settled."""
    known = docs.sparkSession.sparkContext.broadcast(levels)
    bits = len(levels).bit_length() - 1
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(stream):
        for batch in stream:
            sizes, one, two, offsets, prefixes = [], [], [], [0], []
            for found in shingle_sets(batch.column(2).to_pylist()):
                sizes.append(len(found))
                one.append(mix(found + U(0x1234567)).sum(dtype=np.uint64))
                two.append(mix(found ^ BASE).sum(dtype=np.uint64))
                size = prefix_size(len(found), percent) if len(found) else 0
                order = np.argsort(known.value[found >> U(64 - bits)], kind="stable")[:size]
                prefixes.append(found[order])
                offsets.append(offsets[-1] + size)
            longs = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
            values = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), longs(one), longs(two),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), longs(values))],
                names=["k", "id", "n", "s1", "s2", "prefix"],
            )

    keyed = docs.select(node_key().alias("k"), F.col("doc_id").alias("id"), "text")
    return settled(keyed.mapInArrow(lean(run), f"k bigint, id {id_type}, n bigint, s1 bigint, s2 bigint, prefix array<bigint>"))


def node_key():
    return F.xxhash64("doc_id", "text")


def pairs_in_lists(h: np.ndarray, node: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Rows (smaller node, larger node, lists shared, least to share) for lists sorted by h and n."""
    found = []
    for d in range(1, len(h)):
        at = np.flatnonzero(h[d:] == h[:-d])
        if not len(at):
            break
        at = at[100 * n[at] >= percent * n[at + d]]
        x, y = node[at], node[at + d]
        found.append(np.stack([np.minimum(x, y), np.maximum(x, y), shared_in_prefix(n[at])], axis=1))
    if not found:
        return np.zeros((0, 4), dtype=np.int64)
    pairs, counts = np.unique(np.concatenate(found), axis=0, return_counts=True)
    return np.column_stack([pairs[:, :2], counts, pairs[:, 2]])


def candidates(postings: DataFrame, percent: int, list_nodes: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that may be linked by short lists, and the long lists as (h, node).

    Lists are dealt by ranges of (shingle, size, node), so a very long one fills several partitions.
    The first and last list of a partition count as long, as they may go on next door. Nodes that can't
    have a link by long lists alone are left out of these.
    """

    def run(stream):
        long_h, carry, started = None, None, False

        def long_rows(h, node, n):
            own_least = least_by_long_lists(n, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(node), pa.nulls(len(h), pa.int64()), pa.nulls(len(h), pa.int64()), pa.array(own_least)],
                names=["h", "a", "b", "shared", "least"],
            )

        for batch in stream:
            h, node, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(h):
                continue
            if not started:
                long_h, started = h[0], True
            if carry is not None:
                h, node, n = (np.concatenate(x) for x in zip(carry, (h, node, n)))
                carry = None
            if long_h is not None:
                k = np.searchsorted(h, long_h, side="right")
                yield long_rows(h[:k], node[:k], n[:k])
                h, node, n = h[k:], node[k:], n[k:]
                if not len(h):
                    continue
                long_h = None
            k = np.searchsorted(h, h[-1])
            if len(h) - k > list_nodes:
                long_h = h[-1]
                yield long_rows(h[k:], node[k:], n[k:])
            else:
                carry = (h[k:], node[k:], n[k:])
            h, node, n = h[:k], node[:k], n[:k]
            if not len(h):
                continue
            heads = np.flatnonzero(np.diff(h, prepend=h[0] - 1))
            sizes = np.diff(np.append(heads, len(h)))
            is_long = np.repeat(sizes > list_nodes, sizes)
            if is_long.any():
                yield long_rows(h[is_long], node[is_long], n[is_long])
            short = np.repeat((sizes > 1) & (sizes <= list_nodes), sizes)
            pairs = pairs_in_lists(h[short], node[short], n[short], percent)
            if len(pairs):
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(pairs), pa.int64()), *[pa.array(pairs[:, i].copy()) for i in range(4)]],
                    names=["h", "a", "b", "shared", "least"],
                )
        if carry is not None:
            yield long_rows(*carry)

    dealt = postings.select("h", "node", "n").repartitionByRange("h", "n", "node").sortWithinPartitions("h", "n", "node")
    found = settled(dealt.mapInArrow(lean(run), "h bigint, a bigint, b bigint, shared bigint, least bigint"))
    lists = found.where("h is not null").select("h", F.col("a").alias("node"), "least")
    in_long = settled(lists.groupBy("node").agg(F.count("*").alias("count"), F.max("least").alias("least")))
    lists = settled(lists.select("h", "node").join(in_long.where(F.col("count") >= F.col("least")).select("node"), "node"))
    in_long = in_long.select("node", "count")
    pairs = found.where("h is null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("least").alias("least"))
    pairs = pairs.join(in_long.toDF("a", "long_a"), "a", "left").join(in_long.toDF("b", "long_b"), "b", "left")
    allowed = F.coalesce(F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0))), F.lit(0))
    return settled(pairs.where(F.col("shared") + allowed >= F.col("least")).select("a", "b")), lists


def ties(lists: DataFrame, *more: str) -> DataFrame:
    """a, b: every node of a long list and the smallest one of the list."""
    first = lists.groupBy("h").agg(F.min("node").alias("a"), F.count("*").alias("size"), *[F.expr(x) for x in more])
    nodes = lists.select("h", F.col("node").alias("b"))
    return looked_up(nodes, settled(first), ["h"], "size", lists.count()).where("a <> b")


def block_links(sets: list[np.ndarray], nodes: list[int], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that join the rows of a block: a forest over the pieces given by `labels`."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    parent = list(range(len(order)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict[int, int] = {}
    for at, i in enumerate(order):
        parent[at] = seen.setdefault(labels[i], at)
    rows = np.repeat(np.arange(len(order)), sizes)
    _, columns, counts = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    shared = counts[columns] > 1
    rows, columns = rows[shared], columns[shared]
    by_column = np.argsort(columns, kind="stable")
    column_rows = rows[by_column]
    starts = np.cumsum(counts) - counts
    if (counts == 1).any():
        kept = np.where(counts > 1, counts, 0)
        starts = np.cumsum(kept) - kept
    rank = np.empty(len(columns), dtype=np.int64)  # earlier rows in the same column
    rank[by_column] = np.arange(len(columns)) - starts[columns[by_column]]
    bounds = np.searchsorted(rows, np.arange(len(order) + 1))
    links = []
    for i in range(1, len(order)):
        least = np.searchsorted(sizes, -(-percent * sizes[i] // 100))  # smaller rows can't link
        if least >= i:
            continue
        own = slice(bounds[i], bounds[i + 1])
        spans = rank[own]
        total = int(spans.sum())
        if not total:
            continue
        at = np.repeat(starts[columns[own]] - (np.cumsum(spans) - spans), spans) + np.arange(total)
        overlap = np.bincount(column_rows[at], minlength=i)[least:i]
        hits = np.flatnonzero(100 * overlap >= percent * (sizes[i] + sizes[least:i] - overlap)) + least
        for j in hits:
            x, y = find(i), find(int(j))
            if x != y:
                parent[x] = y
                links.append((nodes[order[i]], nodes[order[int(j)]]))
    return links


def verified(texts: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """a, b: links between the nodes of each block. `members` has block, node, label."""
    placed = members.join(texts, "node").select("block", "node", "label", "text")

    def run(stream):
        current, rows, links = None, {}, []

        def done():
            sets = list(shingle_sets([text for _, text in rows.values()]))
            return block_links(sets, list(rows), [label for label, _ in rows.values()], percent) if len(rows) > 1 else []

        def batch_of(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"]
            )

        for batch in stream:
            for block, node, label, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if block != current:
                    links += done()
                    current, rows = block, {}
                    if len(links) > 10_000:
                        yield batch_of(links)
                        links = []
                rows[node] = (label, text)
        links += done()
        yield batch_of(links)

    dealt = placed.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(lean(run), "a bigint, b bigint")


def in_blocks(parts: DataFrame, nodes: int, entries: int) -> DataFrame:
    """Adds block and blocks (of its component) to rows of component, node, n."""
    parts = settled(parts)
    sizes = parts.groupBy("component").agg(F.count("*").alias("size"), F.sum("n").alias("entries"))
    count = F.ceil(F.greatest(F.col("size") / nodes, F.col("entries") / entries)).cast("int")
    sizes = settled(sizes.select("component", "size", count.alias("blocks")))
    sized = looked_up(parts, sizes, ["component"], "size", parts.count()).drop("size")
    sub = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(0).cast("int")
    return sized.withColumn("sub", sub).withColumn("block", F.xxhash64("component", "sub"))


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`nodes` with the label of the piece that `links` put them in."""
    pieces = components(links).withColumnRenamed("component", "piece")
    return nodes.join(pieces, "node", "left").withColumn("label", F.coalesce("piece", "node")).drop("piece")


def all_links(docs: DataFrame, classes: DataFrame, percent: int, block_nodes: int, block_entries: int,
              list_nodes: int) -> DataFrame:
    """a, b: enough links between classes to give the components of all links."""
    postings = classes.select("node", "n", F.explode("prefix").alias("h"))
    pairs, lists = candidates(postings, percent, list_nodes)
    sizes = classes.select("node", "n")
    parts = components(pairs.unionByName(ties(lists).select("a", "b"))).join(sizes, "node")
    placed = settled(in_blocks(parts, block_nodes, block_entries))
    texts = settled(placed.select("node").join(docs.select(node_key().alias("node"), "text"), "node"))
    links = settled(verified(texts, placed.select("block", "node", F.col("node").alias("label")), percent))
    large = placed.where("blocks > 1").select("component", "node", "n")
    if large.isEmpty():
        return links
    # A few nodes of each piece, over the whole component.
    pieces = settled(labelled(large, links))
    few = pieces.groupBy("component", "label").agg(F.array_distinct(F.array(
        F.min_by("node", F.struct("n", "node")), F.max_by("node", F.struct("n", "node")), F.min("node")
    )).alias("few")).select("component", "label", F.explode("few").alias("node"))
    few = in_blocks(few.join(sizes, "node"), block_nodes, block_entries)
    links = settled(links.unionByName(verified(texts, few.select("block", "node", "label"), percent)))
    # Nodes of different pieces that are still tied are compared completely.
    pieces = settled(labelled(large, links))
    label = pieces.select("node", "label")
    apart = pairs.join(label.toDF("a", "label_a"), "a").join(label.toDF("b", "label_b"), "b").where("label_a <> label_b")
    mixed = ties(lists.join(label, "node").select("h", "node", "label"), "min(label) AS low", "max(label) AS high").where("low <> high")
    open_ = settled(apart.select("a", "b").unionByName(mixed.select("a", "b")))
    if open_.isEmpty():
        return links
    rest = components(open_).join(pieces.select("node", "n", "label"), "node")
    rest = in_blocks(rest, block_nodes // 2, block_entries // 2)
    cells = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.where((F.col("blocks") == 1) | (F.col("sub") != F.col("other")))
    cell = F.xxhash64("component", F.least("sub", "other"), F.greatest("sub", "other"))
    return links.unionByName(verified(texts, cells.select(cell.alias("block"), "node", "label"), percent))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, block_nodes: int = BLOCK_NODES,
                       block_entries: int = BLOCK_ENTRIES, list_nodes: int = LIST_NODES,
                       counter_bits: int = COUNTER_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id, class_size (rows with the same set)."""
    docs = docs.select("doc_id", "text")
    sets = shingled(docs, counters(docs, counter_bits), percent)
    key = ["s1", "s2", "n"]
    classes = settled(sets.where("n > 0").groupBy(*key).agg(
        F.min("k").alias("node"), F.min("id").alias("low"), F.count("*").alias("members"), F.first("prefix").alias("prefix")
    ))
    links = all_links(docs, classes, percent, block_nodes, block_entries, list_nodes)
    found = components(links)
    light = classes.select(*key, "node", "low", "members")
    joined = light.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    joined = settled(joined)
    lowest = joined.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("classes"))
    groups = looked_up(joined, settled(lowest), ["component"], "classes", joined.count()).select(*key, "component_id", "members")
    rows = sets.select("id", *key)
    filled = looked_up(rows.where("n > 0"), settled(groups), key, "members", rows.count())
    empty = rows.where("n = 0").withColumn("component_id", F.col("id")).withColumn("members", F.lit(1).cast("bigint"))
    return filled.unionByName(empty).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", F.col("members").alias("class_size")
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay when each component keeps its smallest id."""
    kept = jaccard_components(docs).where(F.col("component_id").eqNullSafe(F.col("doc_id")))
    return rows_with(docs, kept.select(F.col("doc_id").alias("kept_id")), "doc_id")
