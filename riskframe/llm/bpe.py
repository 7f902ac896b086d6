"""Token ids of whole texts with the ``tokenizers`` library, encoding each distinct chunk once per group of texts.

A text is cut at places where the tokenizer's own pre-tokenizer always cuts, so the ids of the chunks put
together are the ids of the text. Arrow cuts a group of texts, numbers its distinct chunks and puts their ids together;
chunks met before are looked up, new ones go to ``encode_batch``. The memory has two generations of about ``CHUNKS``
chunks; the older one is dropped when the younger is full, and both are when the task ends.

The ids are those of the library's plain call: a text with the string of a special token is given to it as it is.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
CHUNKS, BATCH, GROUP_BYTES = 300_000, 10_000, 8 << 20
#: Before a blank that a visible character follows: a byte-level token never spans this place.
_BEFORE_WORD = re.compile("(?= [^\\s\u180e\u200b\ufeff])")
#: An ASCII letter or digit and the ASCII sign after it; the pre-tokenizers cut between them. Other letters may become more than
#: one character when they are normalised.
_SIGN_AFTER = r"([0-9A-Za-z])([!-&(-/:-@\[-^`{-~])"
_OPEN: dict[tuple[str, str], "Encoder"] = {}


def byte_level_chunks(text: str) -> list[str]:
    """Chunks of a text, written as: ``word`` for a word after one blank, a line end and the word after it, or NUL
    and any piece as it stands. Printable text with single blanks and line ends is cut without a pattern."""
    spaced = text.replace("\n", " \n")
    if not text or spaced[0] in " \n" or spaced[-1] in " \n" or "  " in spaced or "\n " in spaced or not spaced.replace("\n", "").isprintable():
        return ["\0" + piece for piece in _BEFORE_WORD.split(text)]
    chunks = spaced.split(" ")
    chunks[0] = "\0" + chunks[0]
    return chunks


def byte_level_cut(texts: list[str]) -> pa.ListArray:
    """The chunks of each text; texts of printable signs with single blanks are cut by Arrow."""
    spaced = [t.replace("\n", " \n") for t in texts]
    plain = [
        bool(t) and t[0] not in " \n" and t[-1] not in " \n" and "  " not in t and "\n " not in t and t.replace("\n", "").isprintable()
        for t in spaced
    ]
    marked = pa.array(["\0" + t if p else "" for t, p in zip(spaced, plain, strict=True)], pa.string())
    cut = pc.split_pattern(pc.replace_substring_regex(marked, _SIGN_AFTER, "\\1 \0\\2"), " ")
    if all(plain):
        return cut
    mixed = iter(cut.filter(pa.array(plain)).to_pylist())
    return pa.array([next(mixed) if p else byte_level_chunks(t) for t, p in zip(texts, plain, strict=True)], pa.list_(pa.string()))


def word_level_cut(texts: list[str]) -> pa.ListArray:
    """Chunks between ASCII white space, words apart from the signs after them; the tokenizer drops white space, never joins across it,
    and makes all letters small."""
    lower = pc.ascii_lower(pa.array(texts, pa.string()))
    return pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _SIGN_AFTER, "\\1 \\2"))


def byte_level_text(chunk: str) -> str:
    return chunk[1:] if chunk[:1] == "\0" else chunk if chunk[:1] == "\n" else " " + chunk


class Encoder:
    def __init__(self, path: str, cut, written):
        from tokenizers import Tokenizer

        self.tokenizer, self.cut, self.written, self.known, self.before = Tokenizer.from_file(path), cut, written, {}, {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as unsigned 32-bit numbers; none for a null or empty text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, worked out for groups of about ``GROUP_BYTES``."""
        at = 0
        while at < len(texts):
            until, size = at, 0
            while until < len(texts) and (until == at or size < GROUP_BYTES):
                size += len(texts[until] or "")
                until += 1
            yield from self._encode_group([t or "" for t in texts[at:until]])
            at = until

    def forget(self) -> None:
        self.known, self.before = {}, {}

    def _encode_group(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = {i: self._plain(t) for i, t in enumerate(texts) if "<" in t and any(s in t for s in self.special)}
        lists = self.cut(["" if i in whole else t for i, t in enumerate(texts)])
        coded = pc.dictionary_encode(lists.flatten())
        chunks = coded.dictionary.to_pylist()
        if new := {c for c in chunks if c not in self.known}:
            self._learn(new)
        # Taking the ids of the chunks in order puts them together in one buffer.
        ids = pa.array([self.known[c] for c in chunks], pa.binary()).take(coded.indices)
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False), dtype=np.int64)))
        ends = ends[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))]
        data = memoryview(ids.buffers()[2]) if len(ids) and ids.buffers()[2] is not None else b""
        flat = np.frombuffer(data, dtype=self.code, count=int(ends[-1]) // array(self.code).itemsize)
        width = array(self.code).itemsize
        for i in range(len(texts)):
            yield whole[i] if i in whole else flat[ends[i] // width : ends[i + 1] // width].astype("<u4")
        if len(self.known) > CHUNKS:
            self.known, self.before = {}, self.known

    def _plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _learn(self, chunks: set[str]) -> None:
        """Add chunks to the memory, from the older generation or from the library."""
        known, before = self.known, self.before
        known.update((c, ids) for c in chunks if (ids := before.get(c)) is not None)
        new = [c for c in chunks if c not in known]
        for at in range(0, len(new), BATCH):
            part = new[at : at + BATCH]
            texts = [self.written(c) for c in part]
            for chunk, ids in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                known[chunk] = array(self.code, ids.ids).tobytes()


_LEVELS = {"byte": (byte_level_cut, byte_level_text), "word": (word_level_cut, str)}


def encoder(path: str, level: str) -> Encoder:
    """The worker's encoder for a vocabulary file; ``level`` is ``byte`` or ``word``."""
    if (path, level) not in _OPEN:
        _OPEN[path, level] = Encoder(path, *_LEVELS[level])
    return _OPEN[path, level]
