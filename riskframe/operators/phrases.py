"""Whole-word phrases of large lexicons.

A pattern of all phrases grows with the lexicon and is tried at every place of every text. Here a text is cut into words and the
gaps between them; the runs that are as long as some phrase are looked up in the lexicon by a join whose small side is checked
for its size. A phrase begins and ends with a letter, digit or underscore; case does not matter, gaps must agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.textual import WORD
from riskframe.operators.clean import require
from riskframe.operators.sizing import BROADCAST_BYTES, lookup_join
from riskframe.session import materialize

_PIECES = rf"({WORD}+|[^\p{{L}}\p{{N}}_]+)"


def _pieces(value: Column) -> Column:
    return F.regexp_extract_all(F.lower(value), F.lit(_PIECES), 1)


def prepared_lexicon(lexicon: DataFrame, phrase: str = "phrase", name: str = "lexicon") -> DataFrame:
    """Saved rows ``(lexicon, phrase, pieces)`` of the distinct lower-case phrases; an error for one without word ends."""
    require(lexicon, [phrase, name])
    rows = lexicon.select(F.col(name).alias("lexicon"), F.lower(phrase).alias("phrase")).distinct()
    saved = materialize(rows.withColumn("pieces", F.size(_pieces(F.col("phrase")))))
    wrong = saved.filter(~F.coalesce(F.col("phrase").rlike(f"(?s)^{WORD}(.*{WORD})?$"), F.lit(False))).limit(3).collect()
    if wrong:
        raise ValueError(f"phrases must begin and end with a word: {[r['phrase'] for r in wrong]}")
    return saved


def phrase_hits(
    df: DataFrame, lexicon: DataFrame, key: str = "note_id", text: str = "note_text", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``(key, lexicon, phrase, at, pieces)``: every place where a phrase of ``lexicon`` (phrase, lexicon) stands, overlapping ones too.

    ``at`` counts words and gaps. ``key`` identifies a text. A lexicon of more than ``max_bytes`` is joined by a shuffle.
    """
    require(df, [key, text])
    words = prepared_lexicon(lexicon)
    lengths = sorted(r[0] for r in words.select("pieces").distinct().collect())  # as many as phrases have words
    # Exploding an array of one keeps the optimizer from cutting the text anew for every run.
    cut = df.filter(F.col(text).isNotNull()).select(key, F.explode(F.array(_pieces(F.col(text)))).alias("_p"))
    first = F.when(F.element_at(F.col("_p"), 1).rlike(f"^{WORD}"), F.lit(1)).otherwise(F.lit(2))  # words and gaps alternate
    cut = cut.filter(F.size("_p") > 0).select(key, "_p", first.alias("_first"), F.size("_p").alias("_n"))
    none = F.array().cast("array<int>")

    def runs_of(size: int) -> Column:
        last = F.col("_n") - size + 1
        starts = F.coalesce(F.when(last >= F.col("_first"), F.sequence(F.col("_first"), last, F.lit(2))), none)
        run = lambda i: F.array_join(F.slice("_p", i, F.lit(size)), "")
        return F.transform(starts, lambda i: F.struct(run(i).alias("phrase"), i.alias("at"), F.lit(size).alias("pieces")))

    runs = [runs_of(size) for size in lengths]
    if not runs:
        runs = [F.array().cast("array<struct<phrase:string,at:int,pieces:int>>")]
    found = cut.select(key, F.inline(F.concat(*runs)))
    return lookup_join(found, words, ["phrase", "pieces"], max_bytes=max_bytes).select(key, "lexicon", "phrase", "at", "pieces")


def phrase_counts(
    df: DataFrame, lexicon: DataFrame, key: str = "note_id", text: str = "note_text", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``(key, lexicon, n)``: matches per text as a pattern finds them, from left to right, the longest phrase first, without overlap.
    Texts without a match have no row."""
    hits = phrase_hits(df, lexicon, key, text, max_bytes)
    longest = hits.groupBy(key, "lexicon", "at").agg(F.max("pieces").alias("pieces"))
    places = F.sort_array(F.collect_list(F.struct("at", "pieces")))  # shorter than the text itself
    free = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def take(state: Column, hit: Column) -> Column:
        taken = F.struct((hit["at"] + hit["pieces"]).alias("end"), (state["n"] + 1).alias("n"))
        return F.when(hit["at"] >= state["end"], taken).otherwise(state)

    return longest.groupBy(key, "lexicon").agg(places.alias("_at")).select(
        key, "lexicon", F.aggregate("_at", free, take, lambda s: s["n"]).alias("n")
    )


def with_phrase_counts(
    df: DataFrame, lexicon: DataFrame, names: list[str], key: str = "note_id", text: str = "note_text"
) -> DataFrame:
    """One count column per lexicon name; 0 without a match."""
    counts = phrase_counts(df, lexicon, key, text)
    wide = counts.groupBy(key).agg(*[F.coalesce(F.sum(F.when(F.col("lexicon") == n, F.col("n"))), F.lit(0)).alias(n) for n in names])
    return df.join(wide, key, "left").withColumns({n: F.coalesce(n, F.lit(0)).cast("int") for n in names})
