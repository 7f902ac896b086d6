"""Best-fit packing with a grouping genetic algorithm on islands.

Documents become token pieces (``length`` at most ``capacity``; only longer documents are cut). Pieces of
exactly ``capacity`` fill a sequence of their own. All other pieces are dealt by a seeded hash into blocks of
about ``block_rows``; each block is packed on ``islands`` islands, all working on the same pieces, each a row of
a table and evolved by whichever task holds it. An individual is a list of bins. Crossover injects the
best-filled half of the bins of one parent into the other, drops the other's bins that hold an injected piece
and puts their displaced pieces back by best fit, longest first. After each epoch every island sends its best
individual to the next island of its block (a join on the block). An island stops as soon as its best
individual has as few bins as the tokens alone demand, which no packing can beat.

The blocks' last, poorly filled bins are put together again: pieces of bins filled below ``REPACK`` are packed
once more in larger blocks, so that what each block leaves over is shared.

Defined results: a null or empty text is a piece of its end token alone; repeated rows are documents of their
own; null ids are allowed; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.bpe import encoder
from riskframe.llm.common import parts_for, rows_of, saved

CAPACITY, END = 4096, 1
BLOCK_ROWS, ISLANDS, EPOCHS, POPULATION, CHILDREN = 4096, 2, 2, 8, 10
#: Items that the children of an island pack in an epoch, and items of a bin (and free ones) that a swap tries.
WORK, TRIED = 60_000, 8
REPACK = 0.98


def pieces(df: DataFrame, key: str, text: str, vocabulary: str, capacity: int = CAPACITY, end: int = END, level: str = "word") -> DataFrame:
    """(key, piece, start, length, ids_crc32) of the token pieces of every text, each text with its end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary, level)
        for batch in batches:
            index, number, start, length, crc = [], [], [], [], []
            for row, found in enumerate(own.encode_all([body for (body,) in rows_of(batch, "_text")])):
                ids = np.append(found, np.uint32(end)).astype("<u4")
                for n, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    index.append(row)
                    number.append(n)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), pa.array(number, pa.int32()),
                 *[pa.array(v, pa.int64()) for v in (start, length, crc)]],
                names=[key, "piece", "start", "length", "ids_crc32"],
            )
        own.forget()

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: list[int], order: list[int], bins: list[list[int]], room: list[int], capacity: int) -> None:
    """Put the items of ``order`` into the fullest open bin that takes them, or a new one; changes ``bins`` and ``room``."""
    open_bins = sorted((r, b) for b, r in enumerate(room) if r)
    for item in order:
        size = sizes[item]
        at = bisect_left(open_bins, (size, -1))
        if at == len(open_bins):
            b, left = len(bins), capacity - size
            bins.append([item])
            room.append(left)
        else:
            left, b = open_bins.pop(at)
            left -= size
            bins[b].append(item)
            room[b] = left
        if left:
            insort(open_bins, (left, b))


def _without(free: list[tuple[int, int]], at: tuple[int, ...]) -> list[tuple[int, int]]:
    return [f for n, f in enumerate(free) if n not in at]


def _best_swap(own: list[int], space: int, free: list[tuple[int, int]], first: list[int]) -> tuple[int, tuple[int, ...], tuple[int, ...]]:
    """The exchange of one or two of a bin's items (sizes ``own``) for one or two free ones that fills the bin most: the gain, the
    places in ``own``, the places in ``free``. Free items are sorted by size; ``first`` are the places tried as the first of two."""
    best: tuple[int, tuple[int, ...], tuple[int, ...]] = (0, (), ())
    for out in [*((i,) for i in range(len(own))), *combinations(range(len(own)), 2)]:
        given = sum(own[i] for i in out)
        most = given + space
        at = bisect_right(free, (most, 1 << 62)) - 1
        if at >= 0 and free[at][0] - given > best[0]:
            best = (free[at][0] - given, out, (at,))
        for one in first:
            rest = most - free[one][0]
            at = bisect_right(free, (rest, 1 << 62)) - 1
            at -= at == one
            if at >= 0 and free[one][0] + free[at][0] - given > best[0]:
                best = (free[one][0] + free[at][0] - given, out, (one, at))
        if best[0] == space:
            break
    return best


def repair(sizes: list[int], bins: list[list[int]], displaced: list[int], capacity: int, rng: np.random.Generator) -> None:
    """Swap displaced items into the bins where they fill more than the items that leave, then best-fit what is displaced."""
    free = sorted((sizes[i], i) for i in displaced)
    for b in rng.permutation(len(bins)).tolist():
        space = capacity - sum(sizes[i] for i in bins[b])
        while space and free:
            some = bins[b] if len(bins[b]) <= TRIED else rng.choice(bins[b], TRIED, replace=False).tolist()
            first = sorted(rng.choice(len(free), min(len(free), TRIED), replace=False).tolist())
            gain, out, taken = _best_swap([sizes[i] for i in some], space, free, first)
            if not gain:
                break
            leaving = [some[i] for i in out]
            bins[b] = [i for i in bins[b] if i not in leaving] + [free[t][1] for t in taken]
            free = _without(free, taken)
            for i in leaving:
                insort(free, (sizes[i], i))
            space -= gain
    room = [capacity - sum(sizes[i] for i in b) for b in bins]
    best_fit(sizes, [i for _, i in sorted(free, key=lambda f: (-f[0], f[1]))], bins, room, capacity)


def crossover(sizes: list[int], giver: list[list[int]], taker: list[list[int]], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Inject some of the best-filled bins of ``giver`` into ``taker``, drop the bins that hold doubles, and repair with what they held."""
    filled = sorted(giver, key=lambda b: -sum(sizes[i] for i in b))
    best = filled[: max(1, len(filled) // 2)]
    bins = [list(best[n]) for n in rng.choice(len(best), max(1, len(best) // 4), replace=False).tolist()]
    inside = {i for b in bins for i in b}
    displaced = []
    for b in taker:
        if inside.isdisjoint(b):
            bins.append(list(b))
        else:
            displaced += [i for i in b if i not in inside]
    repair(sizes, bins, displaced, capacity, rng)
    return bins


def fitness(sizes: list[int], bins: list[list[int]], capacity: int) -> tuple[int, float]:
    """Fewer bins first; among equals the packing whose bins differ most in fill, which leaves one bin to dissolve."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _mutant(sizes: list[int], bins: list[list[int]], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Empty the worst-filled and some random bins, and repair with what they held."""
    order = sorted(range(len(bins)), key=lambda b: sum(sizes[i] for i in bins[b]))
    drop = {*order[: max(2, len(bins) // 20)], *rng.choice(len(bins), min(len(bins), max(2, len(bins) // 10)), replace=False).tolist()}
    kept = [list(b) for n, b in enumerate(bins) if n not in drop]
    repair(sizes, kept, [i for n in sorted(drop) for i in bins[n]], capacity, rng)
    return kept


def _shaken(sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """A best-fit packing in a shaken order of falling sizes."""
    shake = rng.random(len(sizes)) * 0.6 + 0.7
    bins: list[list[int]] = []
    best_fit(sizes, sorted(range(len(sizes)), key=lambda i: (-sizes[i] * shake[i], i)), bins, [], capacity)
    return bins


def evolve(sizes: list[int], guest: list[list[int]] | None, capacity: int, seed: int) -> list[list[int]]:
    """The best individual of one island after an epoch; ``guest`` is the elite that has migrated in.

    An island ends when it has as few bins as the sizes alone demand, or after about ``WORK`` items were packed by its children.
    """
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    first: list[list[int]] = []
    best_fit(sizes, sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)), first, [], capacity)
    rank = lambda bins: fitness(sizes, bins, capacity)
    people = sorted(((rank(p), n, p) for n, p in enumerate([first, *([guest] if guest else [])])), key=lambda x: x[:2])
    born = len(people)
    if people[0][0][0] <= least:
        return people[0][2]
    while len(people) < POPULATION:
        child = _shaken(sizes, capacity, rng)
        people.append((rank(child), born, child))
        born += 1
    people.sort(key=lambda x: x[:2])
    for _ in range(max(CHILDREN, WORK // max(len(sizes), 1))):
        if people[0][0][0] <= least:
            break
        a, b = (min(rng.choice(len(people), 2, replace=False).tolist()) for _ in range(2))  # the better of two, twice
        child = crossover(sizes, people[a][2], people[b][2], capacity, rng)
        if rng.random() < 0.3:
            child = _mutant(sizes, child, capacity, rng)
        value = rank(child)
        if all(value != p[0] for p in people):  # equal ones would crowd out the others
            people[-1] = (value, born, child)
            born += 1
            people.sort(key=lambda x: x[:2])
    return people[0][2]


def _pack(items: DataFrame, block_rows: int, capacity: int, seed: int) -> DataFrame:
    """(item, length, block, bin, offset) of saved items (item, length): the best packing of each block's islands."""
    blocks = parts_for(items.count(), block_rows)
    dealt = items.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(blocks)))
    listed = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "item"))).alias("rows"))  # bounded by block_rows
    problem = saved(listed.select("block", "rows", F.transform("rows", lambda r: r["length"].cast("int")).alias("sizes")), "blocks")
    island = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    state = problem.select("block", island, "sizes", F.lit(None).cast("array<int>").alias("guest"))
    for epoch in range(EPOCHS):
        own = seed * 1000 + epoch

        def run(batches: Iterator[pd.DataFrame], own: int = own) -> Iterator[pd.DataFrame]:
            for batch in batches:
                best, count = [], []
                for row in batch.itertuples():
                    sizes = [int(s) for s in row.sizes]
                    guest = None if row.guest is None else _from_numbers(row.guest)
                    found = evolve(sizes, guest, capacity, own + 7919 * row.block + 104729 * row.island)
                    best.append(_to_numbers(found, len(sizes)))
                    count.append(len(found))
                yield pd.DataFrame({"block": batch.block, "island": batch.island, "best": best, "bins": count})

        spread = state.repartition("block", "island")
        elites = saved(spread.mapInPandas(run, "block bigint, island int, best array<int>, bins int"), "elites")
        if epoch + 1 < EPOCHS:  # every elite moves on to the next island
            moved = elites.select("block", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.col("best").alias("guest"))
            state = problem.select("block", island, "sizes").join(moved, ["block", "island"])
    winner = elites.groupBy("block").agg(F.min_by("best", F.struct("bins", "island")).alias("best"))
    placed = problem.join(winner, "block").select("block", F.explode(F.arrays_zip("rows", "best")).alias("x"))
    return placed.select(F.col("x.rows.item").alias("item"), F.col("x.rows.length").alias("length"), "block", F.col("x.best").alias("bin"))


def _to_numbers(bins: list[list[int]], items: int) -> list[int]:
    out = [0] * items
    for b, inside in enumerate(bins):
        for i in inside:
            out[i] = b
    return out


def _from_numbers(numbers) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        bins.setdefault(int(b), []).append(i)
    return list(bins.values())


def pack(parts: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS, seed: int = 0) -> DataFrame:
    """The rows of the saved table ``parts`` (with a ``length``) with ``sequence_id`` and ``offset``."""
    columns = parts.columns
    numbered = saved(parts.withColumn("item", F.monotonically_increasing_id()), "items")
    full = numbered.filter(F.col("length") >= capacity)
    first = saved(_pack(numbered.filter(F.col("length") < capacity).select("item", "length"), block_rows, capacity, seed), "packed")
    fill = first.groupBy("block", "bin").agg(F.sum("length").alias("used"))
    loose = first.join(fill.filter(F.col("used") < REPACK * capacity), ["block", "bin"], "left_semi")
    again = saved(_pack(saved(loose.select("item", "length"), "loose"), block_rows * 4, capacity, seed + 1), "repacked")
    tight = first.join(fill.filter(F.col("used") >= REPACK * capacity), ["block", "bin"], "left_semi")
    every = (
        tight.select("item", F.struct(F.lit(0).alias("round"), F.col("block"), F.col("bin").cast("long").alias("bin")).alias("b"))
        .union(again.select("item", F.struct(F.lit(1), "block", F.col("bin").cast("long"))))
        .union(full.select("item", F.struct(F.lit(2), F.lit(0).cast("long"), "item")))
    )
    placed = numbered.join(every, "item")
    sequence = placed.groupBy("b").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("rows"))  # at most capacity
    sequence = saved(sequence.withColumn("sequence_id", F.monotonically_increasing_id()), "sequences")
    steps = F.expr("transform(rows, (r, i) -> struct(r.item AS item, aggregate(slice(rows, 1, i), 0L, (a, x) -> a + x.length) AS offset))")
    offsets = sequence.select("sequence_id", F.inline(steps))
    return numbered.join(offsets, "item").select(*columns, "sequence_id", "offset")


def pack_documents(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    return pack(saved(pieces(df, key, text, vocabulary), "pieces"), **options)
