"""Near duplicates by SimHash: 64-bit fingerprints, linked by radius searches in BK-trees, then connected.

Two fingerprints that differ in at most ``radius`` of 64 bits agree on at least ``blocks - radius`` of
``blocks`` bit blocks. Every choice of that many blocks is one table of shards: fingerprints with equal
bits there. All links therefore lie inside shards, and none is lost. A shard is turned into a BK-tree
(children keyed by their Hamming distance to the parent) in the one task that also gets the shard's
queries; a broadcast of all trees to all tasks would grow with the data. A shard with more than
``shard_rows`` fingerprints is cut into slices and each pair of slices is a task: the tree of one slice
goes to the tasks of all others.

Inside a shard only a spanning forest of the links is emitted, never all pairs. A subtree whose nodes are
all in the component of the query already is not entered again, so a dense group of copies costs
about one path per fingerprint.

Defined results: a text without words has fingerprint zero and links like any other; a null id is ignored
when the smallest id is taken (a component of null ids only has a null id); repeated rows keep one
result row each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import rows_of, saved, small_join

SEED, SHINGLE, RADIUS, SHARD_ROWS = 42, 4, 4, 4096
PIECE = 1 << 16


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text: bit i is set if it is set in over half of its shingles' XXH64 values."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z are changed
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)],
        dtype="<u8",
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), PIECE):
        part = hashes[at : at + PIECE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str, text: str, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fp): the signed 64-bit form of each row's fingerprint."""
    kind = df.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t, size, seed) for (t,) in rows_of(batch, "_text")], dtype="<u8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view("<i8"))], names=[key, "fp"])

    rows = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, fp bigint")


def _blocks_for(distinct: int, radius: int, shard_rows: int) -> int:
    """The fewest bit blocks for which a shard of evenly spread fingerprints has at most ``shard_rows`` / 8."""
    blocks = radius + 1
    while blocks < radius + 4 and distinct > (shard_rows // 8) << ((blocks - radius) * (64 // blocks)):
        blocks += 1
    return blocks


def _shards(blocks: int, radius: int) -> Column:
    """Array of (table, bits): one shard for each choice of ``blocks - radius`` of the bit blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    shards = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (cuts[b + 1] - cuts[b])) - 1) << cuts[b] for b in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        shards.append(F.struct(F.lit(number).alias("table"), F.col("fp").bitwiseAND(F.lit(mask)).alias("bits")))
    return F.array(*shards)


class Forest:
    """BK-tree over the fingerprints of a shard, with the component of each of its nodes."""

    def __init__(self, radius: int):
        self.radius, self.values, self.children, self.parent, self.whole = radius, [], [], [], []

    def find(self, node: int) -> int:
        parent = self.parent
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def link(self, value: int, node: int) -> None:
        """Join ``node`` (already numbered) with every node of the tree within the radius of ``value``."""
        if not self.values:
            return
        radius, values, children, find = self.radius, self.values, self.children, self.find
        stack, linked = [0], False
        while stack:
            at = stack.pop()
            if linked and self.whole[at] and find(at) == find(node):
                continue
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                a, b = find(at), find(node)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                linked = True
            for edge, child in children[at].items():
                if -radius <= edge - distance <= radius:
                    stack.append(child)

    def insert(self, value: int) -> None:
        """Hang a value below the tree; its number is the next one of ``values``."""
        node, at = len(self.values), 0
        self.values.append(value)
        self.children.append({})
        self.whole.append(True)
        if not node:
            return
        own = self.find(node)
        while True:
            if self.whole[at] and self.find(at) != own:
                self.whole[at] = False
            edge = (self.values[at] ^ value).bit_count()
            below = self.children[at].get(edge)
            if below is None:
                self.children[at][edge] = node
                return
            at = below


def shard_links(trees: list[int], queries: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links (fingerprint, fingerprint) that connect what lies within ``radius``: inside ``trees``, or between the two lists."""
    forest = Forest(radius)
    for number, value in enumerate(trees):
        forest.parent.append(number)
        if queries is None:
            forest.link(value, number)
        forest.insert(value)
    values = list(trees)
    for value in queries or []:
        number = len(values)
        values.append(value)
        forest.parent.append(number)
        forest.link(value, number)
    return [(v, values[root]) for n, v in enumerate(values) if (root := forest.find(n)) != n]


def _link_groups(radius: int):
    """Task body: rows arrive sorted by (group, side); each group is a tree (side 0) and its queries (side 1)."""

    def flush(group, trees, queries) -> list[tuple[int, int]]:
        if len(trees) + len(queries) < 2:
            return []
        return shard_links(trees, None if group[2] == group[3] else queries, radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trees, queries = None, [], []
        for batch in batches:
            found = []
            unsigned = batch.column(5).to_numpy().view("u8").tolist()
            keys = zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            for key, side, value in zip(keys, batch.column(4).to_pylist(), unsigned, strict=True):
                if key != group:
                    found += flush(group, trees, queries)
                    group, trees, queries = key, [], []
                (queries if side else trees).append(value)
            yield _links(found)
        yield _links(flush(group, trees, queries) if group else [])

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, dtype="u8").reshape(-1, 2).view("i8")
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])


def near_links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of the saved table ``distinct`` (column fp)."""
    blocks = _blocks_for(distinct.count(), radius, shard_rows)
    rows = distinct.select("fp", F.explode(_shards(blocks, radius)).alias("s")).select("s.table", "s.bits", "fp")
    sizes = rows.groupBy("table", "bits").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    sizes = saved(sizes.select("table", "bits", F.ceil(F.col("n") / shard_rows).alias("slices")), "shards")
    cut = F.col("slices") > 1
    slice_of = F.when(cut, F.pmod(F.xxhash64("fp"), F.col("slices"))).otherwise(F.lit(0))
    meets = F.when(cut, F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    grouped = (
        small_join(rows, sizes, ["table", "bits"])
        .withColumn("own", slice_of)
        .withColumn("other", F.explode(meets))
        .select(
            "table",
            "bits",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "fp",
        )
    )
    group = ["table", "bits", "i", "j"]
    placed = grouped.repartition(*group).sortWithinPartitions(*group, "side", "fp")
    return saved(placed.mapInArrow(_link_groups(radius), "a bigint, b bigint").distinct(), "links")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that occurs in the saved ``links`` (a, b): the smallest node it reaches.

    Alternating large-star and small-star rounds; each is saved. Stops when a round changes nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b"))
    edges = saved(edges.distinct(), "edges")
    state = F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))
    known = edges.agg(*state).first()
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        edges = saved(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
        now = edges.agg(*state).first()
        if now == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        known = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, size: int = SHINGLE, seed: int = SEED
) -> DataFrame:
    """One row (key, fp, component) per input row: its fingerprint and the smallest key of its component."""
    marked = saved(fingerprints(df, key, text, size, seed), "fingerprints")
    distinct = saved(marked.groupBy("fp").agg(F.min(key).alias("least")), "distinct")
    roots = saved(components(near_links(distinct.select("fp"), radius)), "roots")
    owned = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = owned.groupBy("root").agg(F.min("least").alias("component"))
    classes = saved(owned.join(smallest, "root").select("fp", "component"), "classes")
    return marked.join(classes, "fp").select(key, "fp", "component")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose key is the smallest of their component, as ``keep_smallest`` says."""
    return keep_smallest(df, near_duplicates(df, key, text, **options), key, text)


def keep_smallest(df: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``df`` whose key is the smallest of their component in ``classes`` (key, component); all columns are kept.

    Of rows that repeat a surviving key one stays, the one with the smallest text. Rows without a key
    cannot be named and stay.
    """
    classes = saved(classes, "classes")
    kept = classes.filter(F.col(key) == F.col("component")).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    kept = saved(kept, "kept")
    # The surviving keys grow with the table, so both sides are dealt by key at every size; nothing is sorted.
    stay = df.join(kept.select("_key").hint("shuffle_hash"), df[key] == F.col("_key"), "left_semi")
    if not kept.filter(F.col("_n") > 1).isEmpty():
        rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(text).asc_nulls_last()))
        names = df.columns
        stay = stay.withColumn("_rank_of_key", rank).filter(F.col("_rank_of_key") == 1).select(*names)
    if classes.filter(F.col(key).isNull()).isEmpty():
        return stay
    return stay.unionByName(df.filter(F.col(key).isNull()))
