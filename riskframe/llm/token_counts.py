"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

The vocabulary must drop white space between tokens (checked when it is opened), so every run of ASCII white space is
a safe boundary: no token, normalisation or special string spans it. A batch of texts is cut there by Arrow, each
distinct piece of the batch is encoded once, and the lengths are added up per text. Batches hold about ``BATCH_BYTES``
of text, whatever the number of rows. A text above ``PIECE_BYTES`` is split at safe boundaries into pieces of about that
size, which are dealt over all tasks, so that one very long text is not the work of one task.

Special strings inside a text are treated as the library does by default.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a text without white space is one piece, however long;
repeated rows keep one result row each; null keys are kept; an empty table gives no rows. Columns that are not named in
``carry`` are ignored, and ``carry`` must not name a result column.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import parts_for, saved

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
BATCH_BYTES, PIECE_BYTES, ENCODED_AT_ONCE, PIECES_PER_TASK = 8 << 20, 1 << 20, 10_000, 8
RESULTS = ("n_bytes", "n_tokens", "over_limit")
_WHITE = re.compile(rb"[\x20\x09-\x0d]")


class Counter:
    """Token counts of batches of texts with one vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        probe = self._encoded(["a b", "a", "b", "x\t\n y", "x", "y"])
        if probe[0] != probe[1] + probe[2] or probe[3] != probe[4] + probe[5]:
            raise ValueError(f"{path} keeps white space in its tokens")

    def _encoded(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of an array without nulls."""
        cut = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(cut.flatten())
        pieces, each = coded.dictionary.to_pylist(), np.zeros(len(coded.dictionary), np.int64)
        for at in range(0, len(pieces), ENCODED_AT_ONCE):
            each[at : at + ENCODED_AT_ONCE] = self._encoded(pieces[at : at + ENCODED_AT_ONCE])
        total = np.concatenate(([0], np.cumsum(each[coded.indices.to_numpy()]))) if len(coded) else np.zeros(1, np.int64)
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))))
        return np.diff(total[ends])


def balanced(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose sizes add up to about ``most`` bytes; a larger row is a range of its own."""
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


def split(text: bytes, size: int) -> Iterator[bytes]:
    """Pieces of a text, cut at the first white space after every ``size`` bytes."""
    at = 0
    while at < len(text):
        found = _WHITE.search(text, at + size)
        to = found.start() if found else len(text)
        yield text[at:to]
        at = to


def count_tokens(
    df: DataFrame, vocabulary: str, text: str = "text", carry: Sequence[str] = ("doc_id",), limit: int = 2048,
    piece_bytes: int = PIECE_BYTES, batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(carried columns, n_bytes, n_tokens, over_limit) of every row; ``over_limit`` is ``n_tokens > limit``."""
    carry = list(carry)
    if clash := [c for c in carry if c.lower() in RESULTS]:
        raise ValueError(f"carried columns have the names of results: {clash}")
    rows = df.select(F.struct(*carry).alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    kind = rows.schema["row"].dataType.simpleString()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            row, body = batch.column(0), batch.column(1)
            sizes = pc.binary_length(body).to_numpy(zero_copy_only=False).astype(np.int64)
            short = np.flatnonzero(sizes <= piece_bytes)
            for a, b in balanced(sizes[short], batch_bytes):
                at = pa.array(short[a:b])
                n, none = b - a, pa.nulls(b - a, pa.binary())
                columns = [row.take(at), pa.array(sizes[short[a:b]]), pa.array(counter.counts(body.take(at))), none, pa.array(np.zeros(n, np.int32)), none.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "n_bytes", "n_tokens", "digest", "piece", "body"])
            for i in np.flatnonzero(sizes > piece_bytes).tolist():
                whole = body[i].as_py().encode()
                digest, nobody = hashlib.sha256(whole).digest(), pa.nulls(1, pa.int64())
                for number, piece in enumerate(split(whole, piece_bytes)):
                    columns = [row.slice(i, 1), pa.array([len(whole)]), nobody, pa.array([digest]), pa.array([number], pa.int32()), pa.array([piece.decode()])]
                    yield pa.RecordBatch.from_arrays(columns, names=["row", "n_bytes", "n_tokens", "digest", "piece", "body"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            body = batch.column(batch.schema.get_field_index("body"))
            sizes = pc.binary_length(body).to_numpy(zero_copy_only=False).astype(np.int64)
            found = [counter.counts(body.slice(a, b - a)) for a, b in balanced(sizes, batch_bytes)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("row", "n_bytes", "digest", "piece")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate([np.zeros(0, np.int64), *found]))], names=["row", "n_bytes", "digest", "piece", "n_tokens"])

    seen = saved(rows.mapInArrow(first, f"row {kind}, n_bytes bigint, n_tokens bigint, digest binary, piece int, body string"), "counted")
    pieces = seen.filter(F.col("body").isNotNull())
    # Equal pieces are dealt out by turn, not by a key: many copies of one long text are no hot task.
    dealt = pieces.repartition(parts_for(pieces.count(), PIECES_PER_TASK)).select("row", "n_bytes", "digest", "piece", "body")
    counted = dealt.mapInArrow(later, f"row {kind}, n_bytes bigint, digest binary, piece int, n_tokens bigint")
    copies = F.sum((F.col("piece") == 0).cast("long"))
    whole = counted.groupBy("row", "n_bytes", "digest").agg(F.sum("n_tokens").alias("_all"), copies.alias("_copies"))
    each = F.expr("_all div _copies").alias("n_tokens")  # repeated rows have equal pieces
    whole = whole.select("row", "n_bytes", each, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    found = seen.filter(F.col("body").isNull()).select("row", "n_bytes", "n_tokens").union(whole.select("row", "n_bytes", "n_tokens"))
    return found.select("row.*", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
