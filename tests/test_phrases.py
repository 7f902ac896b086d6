"""Phrases of large lexicons against patterns and plain loops."""

import random
import re

import pytest

from riskframe.functions.lexicons import DRUGS, ENTITY_LEXICONS
from riskframe.functions.textual import count_words
from riskframe.operators import phrases


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "note_id int, note_text string")


def as_table(spark, lexicons):
    return spark.createDataFrame([(p, n) for n, some in lexicons.items() for p in some], "phrase string, lexicon string")


def test_given_lists_agree_with_their_patterns(spark):
    lists = {**ENTITY_LEXICONS, "drugs": DRUGS}
    rng, known = random.Random(2), [w for some in lists.values() for w in some]
    gaps = [" ", " ", " ", "-", ", ", "  ", ".\n", "x", "_"]
    texts = [None, "", " ", "...", *["".join(rng.choice([*known, "Word", "été"]).upper() * (rng.random() < 0.3) or rng.choice(known)
                                             + rng.choice(gaps) for _ in range(rng.randrange(1, 25))) for _ in range(400)]]
    df = rows(spark, texts)
    got = phrases.with_phrase_counts(df, as_table(spark, lists), list(lists)).collect()
    want = df.withColumns({f"w_{n}": count_words("note_text", some) for n, some in lists.items()})
    want = {r["note_id"]: r for r in want.collect()}
    assert len(got) == len(texts) and sum(r["drugs"] for r in got) > 100
    for r in got:
        assert [r[n] for n in lists] == [want[r["note_id"]][f"w_{n}"] for n in lists], texts[r["note_id"]]


def test_hundred_thousand_phrases(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    known = {" ".join(rng.choices(words, k=rng.choice([1, 2, 2, 3]))) for _ in range(150_000)}
    assert len(known) > 100_000
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 80))) for _ in range(60)]
    lexicon = as_table(spark, {"large": known})
    for limit in (64 << 20, 1000):  # broadcast, and joined by a shuffle
        got = {r["note_id"]: r["n"] for r in phrases.phrase_counts(rows(spark, texts), lexicon, max_bytes=limit).collect()}
        for i, body in enumerate(texts):
            parts, at, n = body.split(), 0, 0
            while at < len(parts):
                length = next((k for k in (3, 2, 1) if " ".join(parts[at : at + k]) in known and at + k <= len(parts)), 0)
                n, at = n + (length > 0), at + max(length, 1)
            assert got.get(i, 0) == n


def test_hits_keep_overlaps_and_places(spark):
    df = rows(spark, ["(Acute chest pain) chest", "acute  chest", None])
    lexicon = as_table(spark, {"a": ["acute chest", "chest pain", "chest", "CHEST"], "b": ["pain"]})
    got = sorted((r["note_id"], r["lexicon"], r["phrase"], r["at"]) for r in phrases.phrase_hits(df, lexicon).collect())
    assert got == [
        (0, "a", "acute chest", 2), (0, "a", "chest", 4), (0, "a", "chest", 8), (0, "a", "chest pain", 4), (0, "b", "pain", 6), (1, "a", "chest", 3),
    ]
    counts = {(r["note_id"], r["lexicon"]): r["n"] for r in phrases.phrase_counts(df, lexicon).collect()}
    assert counts == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1}


def test_phrases_without_word_ends_and_empty_lexicons(spark):
    df = rows(spark, ["a b", "c"])
    with pytest.raises(ValueError, match="begin and end"):
        phrases.phrase_hits(df, as_table(spark, {"a": ["-x"]}))
    with pytest.raises(ValueError, match="begin and end"):
        phrases.phrase_hits(df, as_table(spark, {"a": [""]}))
    empty = as_table(spark, {"a": ["x"]}).limit(0)
    assert phrases.phrase_hits(df, empty).collect() == []
    assert [r["a"] for r in phrases.with_phrase_counts(df, empty, ["a"]).collect()] == [0, 0]
    assert re.search("Broadcast", phrases.phrase_hits(df, as_table(spark, {"a": ["b"]}))._jdf.queryExecution().executedPlan().toString())
