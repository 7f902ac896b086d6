"""Text expressions made of built-in functions only (no Python workers)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskframe.functions.rules import as_column

WORD = r"[\p{L}\p{N}_]"


def clean_text(value: str | Column) -> Column:
    """Lower case; letters a-z, digits and single blanks only."""
    kept = F.regexp_replace(F.lower(as_column(value)), r"[^a-z0-9\s]", "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def expand_tokens(value: str | Column, lexicon: dict[str, str]) -> Column:
    """Replace whole blank-separated tokens by their entry in ``lexicon``."""
    entries = F.create_map(*[F.lit(x) for pair in lexicon.items() for x in pair])
    tokens = F.split(as_column(value), " ")
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(entries, t), t)), " ")


def word_count(value: str | Column) -> Column:
    """Number of blank-separated words; blank text has none, NULL stays NULL."""
    words = F.filter(F.split(as_column(value), r"\s+"), lambda t: t != "")
    return F.when(as_column(value).isNotNull(), F.size(words))


def lexicon_pattern(words: Sequence[str]) -> str:
    """Case-insensitive pattern for whole words, with Unicode word boundaries; longer entries first."""
    alternatives = "|".join(re.escape(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    return f"(?iu)(?<!{WORD})(?:{alternatives})(?!{WORD})"


def count_words(value: str | Column, words: Sequence[str]) -> Column:
    """Number of whole-word matches; NULL text has none."""
    return F.coalesce(F.regexp_count(as_column(value), F.lit(lexicon_pattern(words))), F.lit(0))


def count_substrings(value: str | Column, words: Sequence[str]) -> Column:
    """Sum of the substring counts of all words in the lower-cased text; NULL text has none."""
    text = F.lower(as_column(value))
    total = F.lit(0)
    for word in words:
        removed = F.length(text) - F.length(F.replace(text, F.lit(word), F.lit("")))
        total = total + (removed / F.lit(len(word))).cast("int")
    return F.coalesce(total, F.lit(0))


def phrases_after(value: str | Column, cues: Sequence[str], window: int = 60, words: int = 4) -> Column:
    """Up to ``words`` words of the ``window`` characters after each cue, cue by cue; NULL text gives an empty array."""
    text = F.lower(as_column(value))
    found = []
    for cue in cues:
        tail = F.lit(f"(?s){re.escape(cue)}(?=(.{{0,{window}}}))")
        snippets = F.regexp_extract_all(text, tail, 1)
        found.append(
            F.transform(
                snippets,
                lambda s: F.array_join(
                    F.slice(F.filter(F.split(s, r"(?U)\s+"), lambda w: w != ""), 1, words), " "
                ),
            )
        )
    phrases = F.filter(F.concat(*found), lambda p: p != "")
    return F.coalesce(phrases, F.array().cast("array<string>"))


def tokens(value: str | Column, pattern: str = WORD + "{2,}") -> Column:
    """Lower-cased tokens that match ``pattern``; NULL text has none."""
    return F.coalesce(
        F.regexp_extract_all(F.lower(as_column(value)), F.lit(f"({pattern})"), 1), F.array().cast("array<string>")
    )


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` consecutive words, joined by a blank.

    Shifted slices are zipped, so that ``words`` is evaluated a fixed number of times per row.
    """
    length = F.greatest(F.size(words) - (n - 1), F.lit(0))
    grams = F.slice(words, F.lit(1), length)
    for shift in range(2, n + 1):
        grams = F.zip_with(grams, F.slice(words, F.lit(shift), length), lambda a, b: F.concat_ws(" ", a, b))
    return grams
