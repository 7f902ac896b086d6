"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of what is not a letter or digit at their ends. A number with its unit becomes one
placeholder, and so do capitalised words inside a sentence that follow each other (names); what a placeholder replaced is its
slot value. Windows of ``size`` template words are hashed, and windows with names a second time with the names as plain
words; a benchmark item shorter than that is one window. Documents keep only windows whose hash occurs in the
benchmark, and these are hash-joined with the benchmark's. Joined windows of a (document, item) with one offset between the
two are a run. An inserted or dropped word and a name of another length shift the offset, so runs whose offsets differ by
at most ``SLIP`` words are added up. Their slots must be consistent: each benchmark value answers to one document value and the
other way round, so that renamed and re-numbered copies are found while other texts of the same template are not. Runs
contaminate when they cover as many words of the item as one run of ``share`` of its windows does. If slot values changed, a
template must also hold at least ``least_words`` plain words; verbatim runs need none. Items of fewer than ``least_words``
words are no evidence in any form; they are not searched, a warning gives their number, and ``short_items`` lists them.

Defined results: a null or empty text, a null item or an empty benchmark matches nothing; items or
documents that repeat count once per (document, item); a null document id is reported as null by ``matches``
and its document is kept by ``remove_contaminated``, which filters by id.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import BROADCAST_ROWS, rows_of, saved, small_join

SIZE, SHARE, LEAST_WORDS = 8, 0.6, 6
SLIP = 4
# fixed values: units that may follow a number
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs hour hours day days week weeks month months year years "
    "second seconds minute minutes meter meters metre metres kilometer kilometers mile miles gram grams kilogram kilograms liter "
    "liters litre litres pound pounds inch inches foot feet percent dollar dollars euro euros cent cents usd eur kw w v a hz kb mb gb".split()
)
PLAIN, NUMBER, NAME, UNIT = 0, 1, 2, 3
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?")
_CODES = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], dtype=np.uint64)
_MIX = np.uint64(0x100000001B3)
SEEN, GROUP_BYTES, FILTER_BITS = 200_000, 4 << 20, 20


class Words:
    """What is known of each word as written: its bare lower-case form, hash and kind; kept per worker, at most ``SEEN``."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.bare: list[str] = []
        self.codes, self.flags = np.zeros(0, np.uint64), np.zeros((0, 5), bool)

    def learn(self, words: list[str]) -> None:
        """Add words that are not known."""
        number, lows, codes, flags = self.number, self.bare, [], []
        for word in words:
            number[word] = len(lows)
            plain = word.isalnum()
            bare = word if plain else _EDGES.sub("", word)
            low = bare.lower()
            lows.append(low)
            codes.append(xxhash.xxh64_intdigest(low))
            flags.append((
                low != "",
                len(bare) > 1 and bare[0].isupper() and not bare[1:].isupper(),
                low[:1].isdecimal() and _NUMBER.fullmatch(low) is not None,
                low in UNITS,
                word != "" and not plain and word.rstrip("\"')]")[-1:] in ".!?:",
            ))
        if words:
            self.codes = np.concatenate([self.codes, np.array(codes, np.uint64)])
            self.flags = np.concatenate([self.flags, np.array(flags, bool)])


_WORDS = Words()


def word_numbers(texts: list[str | None]) -> list[np.ndarray]:
    """The word numbers of each text. Arrow cuts the texts; each distinct word of the group is looked up once.

    The numbers hold until the next call, which may begin a new memory.
    """
    if len(_WORDS.bare) > SEEN:
        _WORDS.__init__()
    cut = pc.utf8_split_whitespace(pa.array([t or "" for t in texts], pa.string()))
    coded = pc.dictionary_encode(cut.flatten())
    words, known = coded.dictionary.to_pylist(), _WORDS.number
    _WORDS.learn([w for w in words if w not in known])
    own = np.array([known[w] for w in words], dtype=np.int64)
    blank = np.array([not w for w in words], bool)
    codes = coded.indices.to_numpy()
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))))
    parts = [codes[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return [own[p[~blank[p]]] for p in parts] if blank.any() else [own[p] for p in parts]


def canonical(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and their kinds (plain, number, name, unit) of a whole text."""
    return with_kinds(word_numbers([text])[0])


def with_kinds(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the words that are more than signs, and their kinds."""
    flags = _WORDS.flags[numbers]
    starts = np.ones(len(numbers), bool)
    starts[1:] = flags[:-1, 4]
    if not flags[:, 0].all():  # words of signs only hand their sentence end on
        for i in np.flatnonzero(~flags[:-1, 0]).tolist():
            starts[i + 1] |= starts[i]
        filled = flags[:, 0]
        numbers, flags, starts = numbers[filled], flags[filled], starts[filled]
    kinds = np.where(flags[:, 1] & ~starts, NAME, PLAIN)
    kinds[flags[:, 2]] = NUMBER
    kinds[1:][flags[1:, 3] & (kinds[:-1] == NUMBER)] = UNIT
    return numbers, kinds


class Form:
    """The template words of a text: first word of each (and the end of the last), kind and hash."""

    def __init__(self, numbers: np.ndarray, kinds: np.ndarray):
        self.numbers = numbers
        firsts = kinds != UNIT
        firsts[1:] &= ~((kinds[1:] == NAME) & (kinds[:-1] == NAME))
        starts = np.flatnonzero(firsts)
        self.starts, self.kinds = np.append(starts, len(numbers)), kinds[starts]
        self.codes = np.where(self.kinds == PLAIN, _WORDS.codes[numbers[starts]], _CODES[self.kinds])

    def slots(self, place: int, size: int) -> list[str]:
        """Values of a window: a name, or a number and its unit (empty without one)."""
        found, bare = [], _WORDS.bare
        for i in np.flatnonzero(self.kinds[place : place + size]).tolist():
            words = [bare[n] for n in self.numbers[self.starts[place + i] : self.starts[place + i + 1]].tolist()]
            found += [" ".join(words)] if self.kinds[place + i] == NAME else [words[0], " ".join(words[1:])]
        return found


def forms(numbers: np.ndarray, kinds: np.ndarray) -> list[Form]:
    """The template with names as placeholders and, if there are names, with the names as the words they are. The
    second finds copies whose capitals or sentence ends differ."""
    named = kinds == NAME
    first = [Form(numbers, kinds)]
    return [*first, Form(numbers, np.where(named, PLAIN, kinds))] if named.any() else first


def templates(numbers: np.ndarray, kinds: np.ndarray, sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, Form, int]]:
    """(places, hashes, form, size) of all windows of a document; the second form only where a window has a name."""
    both = forms(numbers, kinds)
    seen = np.concatenate(([0], np.cumsum(kinds == NAME)))
    for size in sizes:
        for number, form in enumerate(both):
            values = window_hashes(form.codes, size)
            places = np.arange(len(values))
            if number:
                places = np.flatnonzero(seen[form.starts[size:]] > seen[form.starts[:-size]]) if len(values) else places
            yield places, values[places], form, size


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` codes (mixed with the size); none when there are fewer."""
    count = len(codes) - size + 1
    if count < 1:
        return np.zeros(0, np.int64)
    total = np.full(count, size, np.uint64)
    for i in range(size):
        total = (total ^ codes[i : i + count]) * _MIX
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def _windows(text: str | None, size: int) -> list[tuple[int, int, int, int, list[str], int, int]]:
    """(first word, words, hash, plain words, slots, size, words of the item) of each window of an item."""
    words, kinds = canonical(text)
    rows = []
    for form in forms(words, kinds) if len(words) else []:
        width = min(size, len(form.codes))
        for place, value in enumerate(window_hashes(form.codes, width).tolist()):
            first, end = int(form.starts[place]), int(form.starts[place + width])
            plain = int((form.kinds[place : place + width] == PLAIN).sum())
            rows.append((first, end - first, value, plain, form.slots(place, width), width, len(words)))
    return rows


_ITEM = "item_id {kind}, place int, span int, hash bigint, plain int, slots array<string>, size int, words int"
_HIT = "doc_id {kind}, body bigint, at int, hash bigint, found array<string>"


def template_windows(items: DataFrame, key: str, text: str, size: int = SIZE) -> DataFrame:
    """The windows of every benchmark item: (item_id, place, span, hash, plain, slots, size, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, body in rows_of(batch, "item_id", "_text"):
                out += [(item, *row) for row in _windows(body, size)]
            yield _batch(out, [batch.schema.field("item_id").type, pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32()],
                         ["item_id", "place", "span", "hash", "plain", "slots", "size", "words"])

    kind = items.schema[key].dataType.simpleString()
    rows = items.select(F.col(key).alias("item_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, _ITEM.format(kind=kind))


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _beginning(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.uint64) >> np.uint64(64 - FILTER_BITS)


def _groups(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Consecutive rows with about ``GROUP_BYTES`` of text."""
    at = 0
    while at < len(rows):
        until, size = at, 0
        while until < len(rows) and (until == at or size < GROUP_BYTES):
            size += len(rows[until][1] or "")
            until += 1
        yield rows[at:until]
        at = until


def _hits(docs: DataFrame, key: str, text: str, sizes: list[int], hashes: np.ndarray | None) -> DataFrame:
    """Windows of the documents, of every size that items have; only those in ``hashes`` if it is given."""
    sent = docs.sparkSession.sparkContext.broadcast(hashes)  # sorted; at most BROADCAST_ROWS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, maybe = sent.value, None
        if wanted is not None:  # one bit per beginning of a hash rules most windows out before the search
            maybe = np.zeros(1 << FILTER_BITS, bool)
            maybe[_beginning(wanted)] = True
        for batch in batches:
            out = []
            for group in _groups(list(rows_of(batch, "doc_id", "_text"))):
                for (doc, body), numbers in zip(group, word_numbers([t for _, t in group]), strict=True):
                    for places, values, form, size in templates(*with_kinds(numbers), sizes):
                        if wanted is not None:
                            at = np.flatnonzero(maybe[_beginning(values)])
                            near = np.searchsorted(wanted, values[at]).clip(max=len(wanted) - 1)
                            at = at[wanted[near] == values[at]]
                            places, values = places[at], values[at]
                        if len(places):
                            mark = xxhash.xxh64_intdigest((body or "").encode("utf-8", "surrogatepass")) - (1 << 63)
                        for place, value in zip(places.tolist(), values.tolist(), strict=True):
                            out.append((doc, mark, int(form.starts[place]), value, form.slots(place, size)))
            yield _batch(out, [batch.schema.field("doc_id").type, pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())],
                         ["doc_id", "body", "at", "hash", "found"])
        _WORDS.__init__()

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("_text"))
    return rows.mapInArrow(run, _HIT.format(kind=kind))


class Match:
    """Windows of an item found in a document: slot values both ways, covered words of the item."""

    def __init__(self):
        self.there, self.back, self.pairs, self.covered, self.plain = {}, {}, set(), set(), 0

    def with_run(self, run: list[dict]) -> Match | None:
        """This and the windows of a run; None if their slots are not consistent."""
        new = Match()
        new.there, new.back = dict(self.there), dict(self.back)
        new.pairs, new.covered, new.plain = set(self.pairs), set(self.covered), self.plain
        for row in run:
            if len(row["slots"]) != len(row["found"]):
                continue
            for own, other in zip(row["slots"], row["found"], strict=True):
                new.pairs.add((own, other))
                if own and other and (new.there.setdefault(own, other) != other or new.back.setdefault(other, own) != own):
                    return None
            new.covered.update(range(row["place"], row["place"] + row["span"]))
            new.plain = max(new.plain, row["plain"])
        return new


def best_match(rows: list[dict], size: int, share: float, least_words: int) -> tuple[int, int, int] | None:
    """(matched, windows, changed) of the best runs of one document with one item, or None."""
    words = rows[0]["words"]
    size = min(size, words)
    windows = words - size + 1
    runs: dict[int, list[dict]] = {}
    for row in rows:
        runs.setdefault(row["at"] - row["place"], []).append(row)
    offsets, best = sorted(runs), None
    alone = {offset: Match().with_run(runs[offset]) for offset in offsets}
    breaks = [0, *[i for i in range(1, len(offsets)) if offsets[i] - offsets[i - 1] > SLIP], len(offsets)]
    for low, high in zip(breaks, breaks[1:], strict=False):
        group = [o for o in offsets[low:high] if alone[o]]
        reach = set().union(*[alone[o].covered for o in group])
        if len(reach) - size + 1 < share * windows:
            continue
        for base in group:
            whole, joined, tried = alone[base], {base}, [alone[base]]
            for other in sorted(group, key=lambda o: (abs(o - base), o)):
                if abs(other - base) > words or len(whole.covered) == words:
                    break
                near = other not in joined and any(abs(other - o) <= SLIP for o in joined)
                if not near or alone[other].covered <= whole.covered:
                    continue
                more = whole.with_run(runs[other])
                if more:
                    whole = more
                    joined.add(other)
            tried.append(whole)
            for match in tried:
                matched = min(windows, len(match.covered) - size + 1)
                changed = sum(own != other for own, other in match.pairs)
                if matched >= share * windows and (not changed or match.plain >= least_words):
                    best = max(best or (matched, -changed), (matched, -changed))
            if best == (windows, 0):
                break
    return best and (best[0], windows, -best[1])


def short_items(items: DataFrame, key: str = "item_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(item_id, words): the items with words that are too few to be searched."""
    return template_windows(items, key, text).filter(F.col("words") < least_words).select("item_id", "words").distinct()


def matches(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    share: float = SHARE,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """(doc_id, item_id, matched, windows, changed): the items each document contains.

    ``matched`` of the item's ``windows`` are as many as cover the words found in the document's best runs; ``changed`` counts
    slot values that differ. Hashes of up to ``BROADCAST_ROWS`` benchmark windows are sent to the tasks as a filter;
    with more, all document windows go into the same hash join.
    """
    own = saved(template_windows(items, item_key, item_text, size).distinct(), "templates")
    short = own.filter(F.col("words") < least_words).select("item_id").distinct().count()
    if short:
        warnings.warn(f"{short} benchmark items have fewer than {least_words} words and are not searched", stacklevel=2)
    own = own.filter(F.col("words") >= least_words)
    sizes = sorted(r["size"] for r in own.select("size").distinct().collect())  # at most ``size`` numbers
    counted = own.select("hash").distinct().limit(BROADCAST_ROWS + 1)
    hashes = None
    if counted.count() <= BROADCAST_ROWS:
        hashes = np.sort(np.array([r["hash"] for r in counted.collect()], dtype=np.int64))
    if hashes is not None and not len(hashes):
        sizes = []
    hits = _hits(docs, key, text, sizes, hashes)
    joined = small_join(hits, own.withColumnRenamed("item_id", "_item"), "hash")
    rows = joined.select("doc_id", "body", F.col("_item").alias("item_id"), "at", "place", "span", "plain", "words", "slots", "found").distinct()
    kinds = [rows.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")]

    def judge(group: pa.Table) -> pa.Table:
        found = best_match(group.select(["at", "place", "span", "plain", "words", "slots", "found"]).to_pylist(), size, share, least_words)
        ids = group.select(["doc_id", "item_id"]).slice(0, 1 if found else 0)
        for name, value in zip(("matched", "windows", "changed"), found or (0, 0, 0), strict=True):
            ids = ids.append_column(name, pa.array([value] * len(ids), pa.int64()))
        return ids

    # the windows of one text with one item
    good = rows.groupBy("doc_id", "body", "item_id").applyInArrow(
        judge, "doc_id {}, item_id {}, matched bigint, windows bigint, changed bigint".format(*kinds)
    )
    best = F.max(F.struct("matched", (-F.col("changed")).alias("same"), "windows")).alias("best")
    return good.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.matched", "best.windows", (-F.col("best.same")).alias("changed")
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that contain no benchmark item, with their columns."""
    found = saved(matches(docs, items, key, text, **options).select(F.col("doc_id").alias("_found")).distinct(), "leaks")
    return small_join(docs, found, docs[key] == F.col("_found"), "left_anti")
