"""Features of clinical notes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from riskframe.functions.lexicons import (
    BENIGN_WORDS,
    CRITICAL_WORDS,
    DRUGS,
    ENTITY_LEXICONS,
    NEGATION_CUES,
    NOTE_ABBREVIATIONS,
    STOP_WORDS,
)
from riskframe.functions.textual import (
    clean_text,
    count_substrings,
    count_words,
    expand_tokens,
    ngrams,
    phrases_after,
    tokens,
    word_count,
)
from riskframe.operators.sizing import BROADCAST_BYTES, dealt_by_key, lookup_join, saved_bytes
from riskframe.session import materialize

#: Bytes of files that a model gets at once, and that are counted at once.
FILE_BYTES, PIECE = 8 << 20, 1 << 20


def clean_notes(df: DataFrame, text: str = "note_text", lexicon: dict[str, str] = NOTE_ABBREVIATIONS) -> DataFrame:
    """Cleaned text with expanded abbreviations, and ``word_count``."""
    return df.withColumn(text, expand_tokens(clean_text(text), lexicon)).withColumn("word_count", word_count(text))


def with_entity_counts(
    df: DataFrame, text: str = "note_text", lexicons: dict[str, Sequence[str]] = ENTITY_LEXICONS
) -> DataFrame:
    """One whole-word count column per lexicon."""
    return df.withColumns({name: count_words(text, words) for name, words in lexicons.items()})


def with_drug_count(df: DataFrame, text: str = "note_text", drugs: Sequence[str] = DRUGS) -> DataFrame:
    return df.withColumn("drug_count", count_words(text, drugs))


def with_negations(df: DataFrame, text: str = "note_text", cues: Sequence[str] = NEGATION_CUES) -> DataFrame:
    """``negation_count`` (overlapping cues all count) and the array ``negated_terms``."""
    return df.withColumns({"negation_count": count_substrings(text, cues), "negated_terms": phrases_after(text, cues)})


def with_severity(
    df: DataFrame,
    text: str = "note_text",
    critical: Sequence[str] = CRITICAL_WORDS,
    benign: Sequence[str] = BENIGN_WORDS,
) -> DataFrame:
    """Critical and benign keyword counts and their difference."""
    counted = df.withColumns(
        {"critical_keyword_count": count_substrings(text, critical), "benign_keyword_count": count_substrings(text, benign)}
    )
    return counted.withColumn("note_severity_score", F.col("critical_keyword_count") - F.col("benign_keyword_count"))


def top_terms(
    df: DataFrame,
    text: str = "note_text",
    n: int = 20,
    stop_words: Sequence[str] = STOP_WORDS,
    min_length: int = 3,
    by: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` most frequent lower-case ``[a-z]+`` terms without stop words (ties alphabetical)."""
    words = F.filter(
        F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z]+)"), 1),
        lambda w: (F.length(w) >= min_length) & ~w.isin(list(stop_words)),
    )
    counts = df.select(*by, F.explode(words).alias("term")).groupBy(*by, "term").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(n)


def hashed_tfidf(text: str = "note_text", max_features: int = 5000, output: str = "tfidf_features") -> Pipeline:
    """Tokens without stop words, hashed counts and inverse document frequency, as a pipeline to fit."""
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text, outputCol="_tokens"),
            StopWordsRemover(inputCol="_tokens", outputCol="_kept"),
            HashingTF(inputCol="_kept", outputCol="_tf", numFeatures=max_features),
            IDF(inputCol="_tf", outputCol=output),
        ]
    )


def _counted_by_key(df: DataFrame, key: str, text: str, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``count`` of the rows with a text, by key: the texts are moved, so that what is cut from them is counted in one task per key.
    Keys with more rows than a task gets on average are counted in a shuffle of what is cut from their texts."""
    usual, frequent = dealt_by_key(df.select(key, text).filter(F.col(text).isNotNull()), key, F.octet_length(text))
    return count(usual) if frequent is None else count(usual).union(count(frequent))


def _term_rows(df: DataFrame, key: str, text: str, sizes: Sequence[int]) -> DataFrame:
    words = df.select(key, tokens(text).alias("_words"))
    return words.select(key, F.explode(F.concat(*[ngrams(F.col("_words"), n) for n in sizes])).alias("term"))


def term_counts(df: DataFrame, key: str, text: str, sizes: Sequence[int] = (1, 2)) -> DataFrame:
    """``(key, term, tf)`` for word runs of the given sizes; rows with the same key add up."""
    tf = F.count(F.lit(1)).alias("tf")
    return _counted_by_key(df, key, text, lambda rows: _term_rows(rows, key, text, sizes).groupBy(key, "term").agg(tf))


def vocabulary(
    counts: DataFrame, n_documents: Column, min_df: int = 2, max_df: float = 0.95, max_features: int | None = 5000
) -> DataFrame:
    """Terms with their document frequency and smoothed inverse document frequency.

    With ``max_features`` the terms with the highest total count are kept (ties alphabetical).
    """
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    return most_frequent(stats, n_documents, min_df, max_df, max_features)


def most_frequent(stats: DataFrame, n_documents: Column, min_df: int, max_df: float, max_features: int | None) -> DataFrame:
    """The vocabulary of ``stats`` (term, df, total), as ``vocabulary`` says."""
    kept = stats.filter((F.col("df") >= min_df) & (F.col("df") <= n_documents * F.lit(max_df)))
    if max_features is not None:
        kept = kept.orderBy(F.desc("total"), "term").limit(max_features)
    idf = F.log((n_documents + 1) / (F.col("df") + 1)) + 1
    return kept.select("term", "df", "total", idf.alias("idf"))


def tfidf(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "note_text",
    sizes: Sequence[int] = (1, 2),
    min_df: int = 2,
    max_df: float = 0.95,
    max_features: int | None = 5000,
) -> DataFrame:
    """Long TF-IDF table ``(key, term, tf, weight)`` with unit length per key."""
    counts = term_counts(df, key, text, sizes)
    n_documents = df.agg(F.count_distinct(key)).scalar()
    terms = materialize(vocabulary(counts, n_documents, min_df, max_df, max_features).select("term", "idf"))
    if max_features is not None and saved_bytes(terms) <= BROADCAST_BYTES:
        # Only the terms of the vocabulary are counted the second time.
        count = F.count(F.lit(1)).alias("tf")
        known = lambda rows: _term_rows(rows, key, text, sizes).join(F.broadcast(terms), "term")
        weighted = _counted_by_key(df, key, text, lambda rows: known(rows).groupBy(key, "term", "idf").agg(count))
    else:
        weighted = lookup_join(counts, terms, ["term"])
    weighted = weighted.withColumn("w", F.col("tf") * F.col("idf"))
    square = F.sum(F.col("w") * F.col("w"))
    if max_features is not None:
        # A key has at most ``max_features`` rows here, so its window is small.
        normed = weighted.withColumn("norm", F.sqrt(square.over(Window.partitionBy(key))))
    else:
        normed = weighted.join(weighted.groupBy(key).agg(F.sqrt(square).alias("norm")), key)
    return normed.select(key, "term", "tf", (F.col("w") / F.col("norm")).alias("weight"))


def pool_mean(df: DataFrame, key: str, vector: str, mask: str | None = None) -> DataFrame:
    """Mean vector per key over the rows whose mask is 1; vectors are merged before the shuffle."""
    rows = df.filter(F.col(mask) == 1) if mask else df
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    return rows.groupBy(key).agg(vector_to_array(Summarizer.mean(as_vector)).alias("pooled"))


def pool_first(df: DataFrame, key: str, vector: str, position: str) -> DataFrame:
    """The vector of the lowest position per key."""
    return df.groupBy(key).agg(F.min_by(vector, position).alias("pooled"))


def md5_bucket(term: Column, buckets: int) -> Column:
    """Bucket of a term: the first 32 bits of its md5 digest, modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(term.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def hashed_tfidf_rows(
    df: DataFrame, key: str, text: str = "note_text", max_features: int = 5000, stop_words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Hashed TF-IDF as rows ``(key, bucket, tf, weight)``; built-in functions only, nothing to fit or load."""
    terms = F.filter(F.split(F.lower(text), r"\s+"), lambda t: (t != "") & ~t.isin(list(stop_words)))
    tf = F.count(F.lit(1)).alias("tf")

    def count(rows: DataFrame) -> DataFrame:
        # Hashed after the explode: there the digest is compiled code.
        buckets = rows.select(key, F.explode(terms).alias("_t")).select(key, md5_bucket(F.col("_t"), max_features).alias("bucket"))
        return buckets.groupBy(key, "bucket").agg(tf)

    counts = _counted_by_key(df, key, text, count)
    documents = df.agg(F.count_distinct(key)).scalar()
    found = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))  # at most max_features rows
    idf = found.select("bucket", F.log((documents + 1) / (F.col("df") + 1)).alias("idf"))
    return counts.join(F.broadcast(idf), "bucket").select(key, "bucket", "tf", (F.col("tf") * F.col("idf")).alias("weight"))


def _hashed_vectors(text: str, dim: int) -> Column:
    """Unit vectors of hashed word counts: buckets come from built-in functions, a batch is counted at once.

    The squares are whole numbers and the division is in double precision, so every batch size gives the same bits.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"([\p{L}\p{N}_]+)"), 1)

    @F.pandas_udf(ArrayType(DoubleType()))
    def count(parts: pd.Series) -> pd.Series:
        found = []
        for buckets in parts:  # row by row: beside the result, only one row's counts are held
            out = np.bincount(buckets, minlength=dim)
            norm = np.sqrt(np.float64((out * out).sum()))
            found.append(out / (norm or 1.0))
        return pd.Series(found)

    return count(F.transform(words, lambda w: md5_bucket(w, dim)))


def embed(
    df: DataFrame,
    column: str = "note_text",
    make_model: Callable | None = None,
    dim: int = 768,
    batch_size: int = 16,
    output: str = "embedding",
    input_dim: int | None = None,
) -> DataFrame:
    """Batched model inference on the executors; the model is built once per Python worker.

    ``make_model()`` returns a function from an array of inputs to an array of shape ``(n, dim)``. Without one
    the vectors are hashed word counts of unit length (doubles), which need no download. With ``input_dim`` the column
    holds vectors of that size instead of texts.
    """
    if make_model is None:
        return df.withColumn(output, _hashed_vectors(column, dim))
    kind, shapes = ArrayType(FloatType()), [[input_dim]] if input_dim else None
    run = predict_batch_udf(make_model, return_type=kind, batch_size=batch_size, input_tensor_shapes=shapes)
    return df.withColumn(output, run(F.col(column) if input_dim else F.coalesce(F.col(column), F.lit(""))))


def byte_histogram_model(dim: int = 64) -> Callable:
    """Default file model: share of byte values in ``dim`` equal ranges."""

    def make() -> Callable:
        def predict(contents: list[bytes]) -> np.ndarray:
            sizes = np.array([len(c) for c in contents])
            if not sizes.all():
                raise ValueError("an empty file has no byte values")
            ranges = np.arange(256) * dim // 256
            counts = np.zeros((len(contents), dim))
            for row, content in enumerate(contents):
                seen = np.zeros(256)
                for at in range(0, len(content), PIECE):
                    piece = np.frombuffer(content, dtype=np.uint8, count=min(PIECE, len(content) - at), offset=at)
                    seen += np.bincount(piece, minlength=256)
                counts[row] = np.bincount(ranges, weights=seen, minlength=dim)[:dim]
            return (counts / sizes[:, None]).astype(np.float32)

        return predict

    return make


def embed_files(
    df: DataFrame,
    keep: Sequence[str] = ("path",),
    content: str = "content",
    make_model: Callable | None = None,
    dim: int = 64,
    output: str = "embedding",
) -> DataFrame:
    """Model inference over file contents; a file the model cannot read gives a zero vector and ``ok`` false.

    The model gets some files at a time, about ``FILE_BYTES`` of them, so a task's memory does not grow with the rows of a batch.
    """
    make = make_model or byte_histogram_model(dim)
    kept = list(keep)

    def judged(model: Callable, items: list[bytes | None]) -> tuple[list[np.ndarray], list[bool]]:
        try:
            return list(np.asarray(model(items), dtype=np.float32)), [True] * len(items)
        except Exception:  # find the files that the model cannot read
            vectors, ok = [], []
            for item in items:
                try:
                    vectors.append(np.asarray(model([item])[0], dtype=np.float32))
                    ok.append(True)
                except Exception:
                    vectors.append(np.zeros(dim, dtype=np.float32))
                    ok.append(False)
            return vectors, ok

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for batch in batches:
            contents = batch.column(len(kept))
            sizes = np.array(pc.fill_null(pc.binary_length(contents), 0), dtype=np.int64)
            group = (np.cumsum(sizes) - sizes) // FILE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)] if len(batch) else []
            for start, end in zip(cuts, cuts[1:]):
                vectors, ok = judged(model, contents.slice(start, end - start).to_pylist())
                part = batch.slice(start, end - start)
                columns = [*part.columns[: len(kept)], pa.array(vectors, pa.list_(pa.float32())), pa.array(ok, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, output, "ok"])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept)
    rows = df.select(*[F.col(c) for c in kept], F.col(content).cast("binary").alias("_content"))
    return rows.mapInArrow(run, f"{fields}, `{output}` array<float>, ok boolean")


def classify(
    df: DataFrame,
    column: str,
    make_model: Callable,
    n_classes: int,
    batch_size: int = 16,
    input_dim: int | None = None,
) -> DataFrame:
    """Batched classifier inference: the model returns logits, the result has probabilities and the class."""
    from riskframe.operators.fusion import argmax, softmax

    scored = embed(df, column, make_model, n_classes, batch_size, "_logits", input_dim)
    return (
        scored.withColumn("probability", softmax("_logits"))
        .withColumn("predicted_class", argmax("probability"))
        .drop("_logits")
    )


def fit_term_classes(
    df: DataFrame, label: str, text: str = "note_text", dim: int = 768, sharpness: float = 1.0
) -> tuple[list, Callable]:
    """The sorted classes and a model for ``classify``: naive Bayes on hashed words, for unit vectors of ``embed``.

    A class's weight of a bucket is the logarithm of its smoothed share of the class's words. What reaches the driver is one
    count per class and bucket. Logits are the weighted sums of a unit vector times ``sharpness``, so long texts are not surer.
    """
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"([\p{L}\p{N}_]+)"), 1)
    rows = df.filter(F.col(label).isNotNull()).select(label, F.explode(words).alias("w"))
    counted = rows.select(label, md5_bucket(F.col("w"), dim).alias("bucket")).groupBy(label, "bucket").agg(F.count(F.lit(1)).alias("n"))
    found = counted.collect()
    classes = sorted({r[label] for r in found})
    counts = np.zeros((len(classes), dim))
    for r in found:
        counts[classes.index(r[label]), r["bucket"]] = r["n"]
    weights = (np.log((counts + 1) / (counts.sum(axis=1, keepdims=True) + dim)) * sharpness).T

    def make() -> Callable:
        return lambda vectors: (np.asarray(vectors, dtype=np.float64) @ weights).astype(np.float32)

    return classes, make
