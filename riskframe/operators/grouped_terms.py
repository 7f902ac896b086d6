"""Counts of the words, and pairs of neighbouring words, of whole entities: what a task does with the notes that were dealt to it."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

#: Words that are counted at once, and rows of counts that are passed on at once.
GROUP_WORDS, OUTPUT_ROWS = 1 << 20, 1 << 16

# The tasks get these functions with the job, so that they need not find this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class _Group:
    """The words of some whole entities, numbered: ``names[code]`` is a word, ``entity`` the place of its entity in ``keys``."""

    keys: pa.Array
    entity: np.ndarray
    code: np.ndarray
    names: pa.Array

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Group:
        starts, words = _starts(batch.column(0)), batch.column(1)
        first = np.zeros(len(batch), np.int64)
        first[starts[1:]] = 1
        entity = np.repeat(np.cumsum(first), np.diff(words.offsets.to_numpy()))
        coded = words.flatten().dictionary_encode()
        return cls(batch.column(0).take(pa.array(starts)), entity, coded.indices.to_numpy().astype(np.int64), coded.dictionary)

    def neighbours(self) -> np.ndarray:
        """The places of the words that another word of the entity follows."""
        return np.flatnonzero(self.entity[1:] == self.entity[:-1])

    def joined(self, pairs: np.ndarray) -> pa.Array:
        """The terms of pairs of words, numbered as ``code`` of the first times the number of names plus that of the second."""
        one, two = (self.names.take(pa.array(part)) for part in np.divmod(pairs, len(self.names)))
        return pc.binary_join_element_wise(one, two, " ")

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Entity and number of every pair of neighbours."""
        at = self.neighbours()
        return self.entity[at], self.code[at] * len(self.names) + self.code[at + 1]

    def known_terms(self, words: _Lookup) -> tuple[np.ndarray, np.ndarray]:
        """Entity and place in the vocabulary of every occurrence of a known term."""
        part = pc.fill_null(pc.index_in(self.names, words.parts), len(words.parts)).to_numpy().astype(np.int64)[self.code]
        single, at = words.single[part], self.neighbours()
        double = words.pairs(part[at], part[at + 1])
        return np.concatenate([self.entity[single >= 0], self.entity[at][double >= 0]]), np.concatenate([single[single >= 0], double[double >= 0]])


@dataclass
class _Lookup:
    """A vocabulary by the words of its terms: ``single`` is the place of a word's own term, ``ordered`` and ``places`` are those of pairs."""

    parts: pa.Array
    single: np.ndarray
    ordered: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, terms: Sequence[str]) -> _Lookup:
        cut = [t.split(" ") for t in terms]
        number = {w: i for i, w in enumerate(sorted({w for c in cut for w in c}))}
        single = np.full(len(number) + 1, -1, np.int64)  # the last is for words that no term has
        pairs = []
        for at, c in enumerate(cut):
            if len(c) == 1:
                single[number[c[0]]] = at
            elif len(c) == 2:
                pairs.append((number[c[0]] * (len(number) + 1) + number[c[1]], at))
        pairs.sort()
        return cls(pa.array(list(number), pa.string()), single, *(np.array([p[i] for p in pairs], np.int64) for i in (0, 1)))

    def pairs(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The places of the terms of two words each; -1 where there is none."""
        if not len(self.ordered):
            return np.full(len(one), -1, np.int64)
        wanted = one * len(self.single) + two
        at = np.minimum(np.searchsorted(self.ordered, wanted), len(self.ordered) - 1)
        return np.where(self.ordered[at] == wanted, self.places[at], -1)


def _starts(keys: pa.Array) -> np.ndarray:
    """The rows with which entities begin; those of an entity are neighbours."""
    number = keys.dictionary_encode("encode").indices.to_numpy()
    return np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1]) if len(keys) else np.zeros(0, np.int64)


def _tally(outer: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Outer and inner number of what occurs and how often, ordered by both."""
    size = int(inner.max()) + 1 if len(inner) else 1
    if len(outer) and (int(outer.max()) + 1) * size >= 1 << 63:  # too many for one number
        names, outer = np.unique(outer, return_inverse=True)
        found, more, count = _tally(outer, inner)
        return names[found], more, count
    found, count = np.unique(outer * size + inner, return_counts=True)
    return *np.divmod(found, size), count


def all_terms(group: _Group) -> list[pa.Array]:
    entities, terms, counts = [], [], []
    for (entity, number), named in (((group.entity, group.code), lambda n: group.names.take(pa.array(n))), (group.pairs(), group.joined)):
        number, entity, tf = _tally(number, entity)
        entities.append(entity), terms.append(named(number)), counts.append(tf)
    return [group.keys.take(pa.array(np.concatenate(entities))), pa.concat_arrays(terms), pa.array(np.concatenate(counts))]


def term_totals(group: _Group) -> list[pa.Array]:
    terms, dfs, totals = [], [], []
    for (entity, number), named in (((group.entity, group.code), lambda n: group.names.take(pa.array(n))), (group.pairs(), group.joined)):
        number, _, tf = _tally(number, entity)  # one entry per term and entity, ordered by the term
        first = np.flatnonzero(np.diff(number, prepend=-1))
        terms.append(named(number[first])), dfs.append(np.diff(first, append=len(number)))
        totals.append(np.add.reduceat(tf, first) if len(first) else tf)
    return [pa.concat_arrays(terms), pa.array(np.concatenate(dfs)), pa.array(np.concatenate(totals))]


def known_terms(vocabulary: Sequence[str]) -> Callable[[_Group], list[pa.Array]]:
    lookup, terms = _Lookup.of(vocabulary), pa.array(vocabulary, pa.string())

    def run(group: _Group) -> list[pa.Array]:
        entity, at, tf = _tally(*group.known_terms(lookup))
        return [group.keys.take(pa.array(entity)), terms.take(pa.array(at)), pa.array(tf)]

    return run


def known_pairs(vocabulary: Sequence[str], idf: Sequence[float]) -> Callable[[_Group], list[pa.Array]]:
    lookup, weights = _Lookup.of(vocabulary), np.array(idf, np.float64)

    def run(group: _Group) -> list[pa.Array]:
        entity, at, tf = _tally(*group.known_terms(lookup))
        starts = np.flatnonzero(np.diff(entity, prepend=-1))
        pairs = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(tf * weights[at])], names=["at", "w"])
        offsets = pa.array(np.append(starts, len(at)).astype(np.int32))
        return [group.keys.take(pa.array(entity[starts])), pa.ListArray.from_arrays(offsets, pairs)]

    return run


def run_counts(count: Callable[[_Group], list[pa.Array]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``count`` of groups of whole entities, for a task whose rows ``(key, words)`` are ordered by the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_entities(batches):
            columns = count(_Group.of(group))
            found = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
            for at in range(0, len(found), OUTPUT_ROWS):
                yield found.slice(at, OUTPUT_ROWS)

    return run


def _whole_entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``GROUP_WORDS`` words that cut no entity."""
    held, size, enough = [], 0, GROUP_WORDS
    for batch in batches:
        held.append(batch)
        size += len(batch.column(1).flatten())
        if size < enough:
            continue
        rows = _one(held)
        last = int(_starts(rows.column(0))[-1])
        if last:
            yield rows.slice(0, last)
        held = [rows.slice(last)]
        size = len(held[0].column(1).flatten())
        enough = max(GROUP_WORDS, 2 * size)  # an entity of many words is not put together again for every batch
    if held and sum(map(len, held)):
        yield _one(held)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
