"""Near duplicates by similarity: documents whose sets of word shingles have a Jaccard similarity of at least ``share``.

First the SimHash fingerprints of the shingles are linked by radius searches in BK-trees (``simhash``), and each link is checked with
the whole sets. A similarity of 0.8 may be more bits apart than trees can search, so an exact search follows for what they do not reach.
No pair is lost there. Two sets of sizes a and b with similarity t or more share one of their first ``a - ceil(t a) + 1`` and
``b - ceil(t b) + 1`` shingles in any common order (prefix filter). The order puts shingles that are frequent in a
bounded sample last, so lines that many documents repeat hardly propose candidates; the sample decides nothing else.
Documents with equal sets are one node. A shingle first proposes links to the smallest node that has it only, and of the nodes
proposed to it each node takes the one it has most shingles in common with. A proposal is first
held against the two prefixes: up to the smaller of their last shingles both sets are known, and beyond it they have no more in
common than the rest of the smaller one. What cannot reach the similarity goes; this loses none, and few whole sets are needed.
The others are checked with the whole sets. Each node carries how many of its shingles fall into each of some slots, odd or even, as
bits. Two sets differ in at least as many shingles as such bits differ, so what differs in too many is no pair.

Then the pairs of different components that are still unchecked are proposed, and checked in the same way. The nodes of one shingle meet
in a task, which holds their bits against each other and returns the few pairs that may be similar; a shingle of very many nodes is cut
into slices, and each pair of slices is a task. Where more pairs than twice the nodes of a shingle may be similar, each node
first takes the one whose bits are nearest. That joins most of such a group, and pairs inside a component need no check. These
shingles come again with the new components, until none is left or a round joins little; the last round proposes all.

Defined results: texts without words have equal (empty) sets; a text of fewer words than a shingle is one shingle; a null id
is ignored when the smallest id is taken; repeated rows keep one result row each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import rows_of, saved, small_join
from riskframe.llm.decontam import window_hashes
from riskframe.llm.simhash import components, fingerprint, keep_smallest, near_links
from riskframe.operators.sizing import skewed_join

SHINGLE, TENTHS = 5, 8  # similarity in tenths: whole numbers keep the bound exact
SAMPLE, OFTEN, MOST_OFTEN = 5_000, 3, 100_000
SEEN = 100_000
#: Nodes of a shingle that one task compares, pairs a node that all are proposed, numbers of the longest parities (16 kbit).
SLICE, MANY, MOST_WORDS = 1024, 2, 256
#: Rows of one whole number (16 bytes in a hash table) that may be broadcast: 64 MB.
NUMBERS = 4_000_000


class _Codes(dict):
    """Hash of each word; kept per worker, at most ``SEEN``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= SEEN:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


_CODES = _Codes()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of all shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z are changed
    if not words:
        return np.zeros(0, np.int64)
    return np.unique(window_hashes(np.array([_CODES[w] for w in words], dtype=np.uint64), min(size, len(words))))


def _prefix(values: np.ndarray, often: np.ndarray, counts: np.ndarray, tenths: int) -> np.ndarray:
    """The first shingles in the common order: by frequency in the sample, then by hash."""
    length = len(values) - -(-tenths * len(values) // 10) + 1
    if not len(values):
        return values
    if len(often):
        at = np.searchsorted(often, values).clip(max=len(often) - 1)
        values = values[np.argsort(np.where(often[at] == values, counts[at], 0), kind="stable")]
    return values[:length]


def _frequent(df: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur in several documents of a sample, sorted, with their counts; at most ``MOST_OFTEN``."""
    every = max(1, math.ceil(df.count() / SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, size) for (t,) in rows_of(batch, "_text")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *found]))], names=["token"])

    rows = df.select(F.col(text).cast("string").alias("_text")).filter(F.pmod(F.xxhash64("_text"), F.lit(every)) == 0)
    counted = rows.mapInArrow(run, "token bigint").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counted.filter(F.col("n") >= OFTEN).orderBy(F.desc("n"), "token").limit(MOST_OFTEN).collect()
    top = sorted((r["token"], r["n"]) for r in top)
    return np.array([t for t, _ in top], dtype=np.int64), np.array([n for _, n in top], dtype=np.int64)


def _node(values: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(values.tobytes())).view(np.int64))


def _parities(values: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each slot is odd, 64 slots a number. As many slots as shingles at least, up to ``MOST_WORDS``
    numbers, a power of two of numbers: more are folded into fewer by XOR of their halves."""
    words = min(MOST_WORDS, 1 << max(0, (len(values) - 1) // 64).bit_length())
    slots = np.bincount(values & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(slots.astype(np.uint8), bitorder="little").view("<i8")


def _unlike(a: str, b: str) -> Column:
    """The least number of shingles in which the sets with these parities differ; 0 where one has more than twice the numbers."""

    def folded(bits: Column) -> Column:
        half = (F.size(bits) / 2).cast("int")
        return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))

    def apart(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, d: t + d)

    x, y = F.col(a), F.col(b)
    unequal = F.when(F.size(x) == 2 * F.size(y), apart(folded(x), y)).when(F.size(y) == 2 * F.size(x), apart(x, folded(y)))
    return F.when(F.size(x) == F.size(y), apart(x, y)).otherwise(F.coalesce(unequal, F.lit(0)))


def _marked(df: DataFrame, key: str, text: str, size: int, tenths: int, sent: Broadcast) -> DataFrame:
    """(key, mark, node, n, fp, bits, tokens) of each row: the hash of its text, the hash and size of its set, its fingerprint, parities
    and first shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                sets = [shingles(t, size) for (t,) in rows_of(batch, "_text")]
                columns = [
                    batch.column(0),
                    batch.column(1),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(np.array([fingerprint(t, size) for (t,) in rows_of(batch, "_text")], "<u8").view("<i8")),
                    pa.array([_parities(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([_prefix(s, *sent.value, tenths) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "mark", "node", "n", "fp", "bits", "tokens"])
        finally:
            _CODES.clear()

    kind = df.schema[key].dataType.simpleString()
    body = F.col(text).cast("string")
    rows = df.select(F.col(key), F.xxhash64(body).alias("mark"), body.alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, mark bigint, node bigint, n int, fp bigint, bits array<bigint>, tokens array<bigint>")


def _sets(df: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(node, tokens): the whole sets of the saved ``wanted`` (node, mark); only texts with one of these hashes are cut again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                sets = [shingles(t, size) for (t,) in rows_of(batch, "_text")]
                columns = [pa.array([_node(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "tokens"])
        finally:
            _CODES.clear()

    body = F.col(text).cast("string")
    rows = small_join(df.select(F.xxhash64(body).alias("mark"), body.alias("_text")), wanted.select("mark").distinct(), ["mark"], "left_semi")
    found = rows.select("_text").mapInArrow(run, "node bigint, tokens array<bigint>")
    return small_join(found, wanted.select("node"), ["node"], "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _both(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """The saved pairs (a, b) with the columns of both nodes; a node with very many pairs is spread."""
    for side in ("a", "b"):
        own = sets.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns])
        pairs = saved(skewed_join(pairs, own, [side]), "sides") if side == "a" else skewed_join(pairs, own, [side])
    return pairs


def _reaches(one: np.ndarray, n: int, other: np.ndarray, m: int, often: np.ndarray, counts: np.ndarray, tenths: int) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with these first shingles can be similar enough."""

    def ranks(values: np.ndarray) -> np.ndarray:
        if not len(often):
            return np.zeros(len(values), np.int64)
        at = np.searchsorted(often, values).clip(max=len(often) - 1)
        return np.where(often[at] == values, counts[at], 0)

    if not n or not m:
        return n == m
    first, second = ranks(one), ranks(other)
    last = min((first[-1], one[-1]), (second[-1], other[-1]))
    a = one[(first < last[0]) | ((first == last[0]) & (one <= last[1]))]
    b = other[(second < last[0]) | ((second == last[0]) & (other <= last[1]))]
    most = len(np.intersect1d(a, b, assume_unique=True)) + min(n - len(a), m - len(b))
    return (10 + tenths) * most >= tenths * (n + m)


def _alike(pairs: DataFrame, nodes: DataFrame, tenths: int) -> DataFrame:
    """The saved pairs (a, b) that their parities do not rule out. Similar sets of n and m shingles have (n + m) t / (1 + t) or more in
    common and differ in (n + m) (1 - t) / (1 + t) at most."""
    near_enough = (10 + tenths) * _unlike("bits_a", "bits_b") <= (10 - tenths) * (F.col("n_a") + F.col("n_b"))
    return saved(_both(pairs, nodes, "n", "bits").filter(near_enough).select("a", "b"), "alike")


def _nearest(who: np.ndarray, other: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each node in the pairs, seen from both sides, the nearest one."""
    who, other, apart = np.concatenate([who, other]), np.concatenate([other, who]), np.concatenate([apart, apart])
    order = np.lexsort((other, apart, who))
    who, other, apart = who[order], other[order], apart[order]
    first = np.concatenate([[True], who[1:] != who[:-1]])
    return who[first], other[first], apart[first]


def _compared(group: pa.RecordBatch, tenths: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of nodes of different components that their parities do not rule out, with the share of bits in which they differ. The rows
    come in order of n, so those of similar size and those with equally many numbers lie together."""
    node, n, root, side = (group.column(group.schema.get_field_index(c)).to_numpy() for c in ("node", "n", "root", "side"))
    bits, n, cut = group.column(group.schema.get_field_index("bits")), n.astype(np.int64), side.any()
    width, flat = pc.list_value_length(bits).to_numpy(), bits.flatten().to_numpy().view(np.uint64)
    ends, last = np.cumsum(width), np.searchsorted(n, 10 * n // tenths, "right")
    tables = {}
    for w in np.unique(width).tolist():
        low, high = np.searchsorted(width, [w, w + 1]).tolist()
        tables[w] = low, high, flat[ends[low] - w : ends[high - 1]].reshape(-1, w)
    folded = {w // 2: (low, high, rows[:, : w // 2] ^ rows[:, w // 2 :]) for w, (low, high, rows) in tables.items() if w > 1}
    ones, others, apart = [], [], []
    for w, (start, stop, own) in tables.items():
        for low, high, rows in [t[w] for t in (tables, folded) if w in t]:
            for i in range(start, stop):
                a, b = max(i + 1, low), min(int(last[i]), high)
                if a >= b:
                    continue
                differ = np.bitwise_count(rows[a - low : b - low] ^ own[i - start]).sum(axis=1, dtype=np.int64)
                both = n[i] + n[a:b]
                keep = ((10 + tenths) * differ <= (10 - tenths) * both) & (root[a:b] != root[i])
                keep = np.flatnonzero(keep & (side[a:b] != side[i]) if cut else keep)
                ones.append(np.full(len(keep), node[i]))
                others.append(node[a:b][keep])
                apart.append(differ[keep] / both[keep])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *ones]), np.concatenate([none, *others]), np.concatenate([none.astype(float), *apart])


def _proposals(placed: DataFrame, tenths: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) between the nodes of each token of ``placed`` (token, node, n, root, bits, slices), and the saved tokens (token) of
    which only the nearest ones were proposed; with ``every`` there are none of these."""
    key = ["token", "i", "j"]

    def found(group: pa.RecordBatch) -> pa.RecordBatch:
        one, other, apart = _compared(group, tenths)
        near, nulls = None if every or len(one) <= MANY * group.num_rows else apart, pa.nulls(1, pa.int64())
        if near is None:
            columns = [pa.array(one), pa.array(other), pa.nulls(len(one), pa.float64())]
        else:
            one, other, near = _nearest(one, other, apart)
            token = group.column(0)[:1]  # a row without b: the token comes again
            columns = [pa.concat_arrays([token, pa.array(one)]), pa.concat_arrays([nulls, pa.array(other)]), pa.array([None, *near.tolist()], pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "apart"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = batch if kept is None else pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            if not rows.num_rows:
                continue
            token, i, j = (rows.column(c).to_numpy() for c in range(3))
            cuts = np.flatnonzero((token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            cuts = [0, *cuts.tolist()]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                yield found(rows.slice(low, high - low))
            kept = rows.slice(cuts[-1])
        if kept is not None:
            yield found(kept)

    cut = F.col("slices") > 1
    own = F.when(cut, F.pmod(F.xxhash64("node"), F.col("slices"))).otherwise(F.lit(0).cast("long"))
    meets = F.when(cut, F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).otherwise(F.array(F.lit(0).cast("long")))
    rows = placed.withColumn("own", own).withColumn("other", F.explode(meets))
    ends = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side")
    rows = rows.select("token", *ends, "node", "n", "root", "bits").repartition(*key).sortWithinPartitions(*key, "n", "node")
    proposed = saved(rows.mapInArrow(run, "a bigint, b bigint, apart double"), "proposed")
    near = proposed.filter(F.col("apart").isNotNull()).groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
    pairs = proposed.filter(F.col("b").isNotNull() & F.col("apart").isNull()).select("a", "b").union(near)
    again = saved(proposed.filter(F.col("b").isNull()).select(F.col("a").alias("token")).distinct(), "again")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), again


def _possible(pairs: DataFrame, prefixes: DataFrame, tenths: int, sent: Broadcast) -> DataFrame:
    """The saved pairs that their first shingles do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("n_a", "n_b"))
            one, other = (batch.column(batch.schema.get_field_index(c)) for c in ("tokens_a", "tokens_b"))
            keep = [_reaches(one[i].values.to_numpy(), n[i], other[i].values.to_numpy(), m[i], *sent.value, tenths) for i in range(len(n))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    nodes = saved(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    own = small_join(prefixes, nodes, ["node"], "left_semi")  # else all first shingles would be dealt out
    both = _both(pairs, own, "n", "tokens").select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")
    return saved(both.mapInArrow(run, "a bigint, b bigint").distinct(), "possible")


def _checked(pairs: DataFrame, df: DataFrame, text: str, size: int, marks: DataFrame, tenths: int) -> DataFrame:
    """The saved pairs (a, b) whose whole sets are similar enough; only their sets are built."""
    nodes = saved(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    wanted = saved(small_join(marks, nodes, ["node"], "left_semi"), "wanted")
    sets = saved(_sets(df, text, size, wanted), "sets")
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    similar = (10 + tenths) * common >= tenths * (F.size("tokens_a") + F.size("tokens_b"))
    return _both(pairs, sets, "tokens").filter(similar).select("a", "b")


def _close(distinct: DataFrame) -> DataFrame:
    """Saved pairs (a, b) of the saved nodes with equal fingerprints, or with fingerprints that BK-trees link. Of the nodes with one
    fingerprint, all are paired with the smallest only."""
    heads = saved(distinct.groupBy("fp").agg(F.min("node").alias("head")), "heads")
    linked = near_links(heads.select("fp"))
    own, other = (heads.select(F.col("fp").alias(s), F.col("head").alias(f"head_{s}")) for s in ("a", "b"))
    between = small_join(small_join(linked, own, ["a"]), other, ["b"]).select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    equal = skewed_join(distinct.select("fp", "node"), heads, ["fp"]).select(F.col("head").alias("a"), F.col("node").alias("b"))
    pairs = between.union(equal).filter(F.col("a") != F.col("b"))
    return saved(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "close")


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, tenths: int = TENTHS
) -> DataFrame:
    """One row (key, node, component) per input row: its set's hash and the smallest key of its component."""
    sent = df.sparkSession.sparkContext.broadcast(_frequent(df, text, size))
    marked = saved(_marked(df, key, text, size, tenths, sent), "marked")
    own = F.min(key).alias("least"), F.min("mark").alias("mark"), F.min("fp").alias("fp"), F.first("n").alias("n"), F.first("bits").alias("bits")
    distinct = saved(marked.groupBy("node").agg(*own), "distinct")
    close = _close(distinct)
    near = saved(_checked(close, df, text, size, distinct.select("node", "mark"), tenths), "links")
    # One row per node, found by its key without moving the shingles; repeated rows of one key go with distinct() below.
    least = distinct.select("node", "least")
    prefixes = small_join(marked, least, ["node"]).filter(F.col(key).eqNullSafe(F.col("least"))).select("node", "n", "tokens")
    postings = prefixes.select(F.explode("tokens").alias("token"), "node", "n")
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1).select("token")
    shared = saved(shared, "shared")
    postings = saved(small_join(postings, shared, ["token"], rows=NUMBERS).distinct(), "postings")
    first = postings.groupBy("token").agg(F.min("node").alias("a"), F.min_by("n", "node").alias("m"))
    alike = 10 * F.least("n", "m") >= tenths * F.greatest("n", "m")
    pairs = skewed_join(postings, first, ["token"]).filter((F.col("a") < F.col("node")) & alike)
    pairs = pairs.groupBy("a", F.col("node").alias("b")).agg(F.count(F.lit(1)).alias("c")).join(close, ["a", "b"], "left_anti")
    pairs = saved(pairs.groupBy("b").agg(F.max_by("a", F.struct("c", "a")).alias("a")).select("a", "b"), "pairs")
    possible = _possible(_alike(pairs, distinct, tenths), prefixes, tenths, sent)
    marks = distinct.select("node", "mark")
    links = saved(near.union(_checked(possible, df, text, size, marks, tenths)), "links")
    roots, every = saved(components(links), "roots"), False
    while True:
        placed = small_join(postings, roots, ["node"], "left").withColumn("root", F.coalesce("root", "node"))
        ends = F.min("root").alias("_low"), F.max("root").alias("_high"), F.ceil(F.count(F.lit(1)) / SLICE).alias("slices")
        mixed = placed.groupBy("token").agg(*ends).filter(F.col("_low") != F.col("_high")).select("token", "slices")
        mixed = saved(mixed, "mixed")
        placed = small_join(placed, mixed.select("token"), ["token"], rows=NUMBERS).join(distinct.select("node", "bits"), "node")
        placed = small_join(placed, mixed.filter(F.col("slices") > 1), ["token"], "left")
        rest, again = _proposals(placed, tenths, every)
        rest = saved(rest.join(pairs, ["a", "b"], "left_anti"), "rest")
        more = saved(_checked(_possible(rest, prefixes, tenths, sent), df, text, size, marks, tenths), "more")
        links = saved(links.union(more), "links")
        roots = saved(components(links), "roots")
        if again.isEmpty():
            break
        # Where few of the nearest are similar, further rounds would join little.
        every = every or 4 * more.count() <= rest.count()
        pairs = saved(pairs.union(rest), "pairs")
        postings = saved(small_join(postings, again, ["token"], "left_semi", rows=NUMBERS), "postings")
    owned = small_join(distinct, roots, ["node"], "left").withColumn("root", F.coalesce("root", "node"))
    smallest = owned.groupBy("root").agg(F.min("least").alias("component"))
    classes = saved(owned.join(smallest, "root").select("node", "component"), "classes")
    return skewed_join(marked.select(key, "node"), classes, ["node"]).select(key, "node", "component")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` whose key is the smallest of their component, as ``simhash.keep_smallest`` says."""
    return keep_smallest(df, near_duplicates(df, key, text, **options), key, text)
