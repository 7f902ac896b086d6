"""A text model of entities whose notes are never joined into one text.

The terms of an entity are counted from its notes in order: words and word pairs inside the notes, and the pairs across the border
of two notes, which come from the last word of one and the first of the next. Their weights make a sparse vector per entity with at
most as many entries as the vocabulary, so an entity with very many notes is no large row. The result is that of a model
fitted on the joined texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskframe.functions.textual import WORD, ngrams, tokens
from riskframe.operators import models
from riskframe.operators.clean import require
from riskframe.operators.grouped_terms import all_terms, known_pairs, known_terms, run_counts, term_totals
from riskframe.operators.integrate import date_bucket, keep_ids
from riskframe.operators.prefix import BUCKET_ROWS, adjacent_pairs
from riskframe.operators.sizing import Dealing
from riskframe.operators.text import most_frequent, vocabulary
from riskframe.session import materialize

VECTOR = "text_features"


@dataclass
class EntityNotes:
    """The notes whose terms ``entity_terms`` counts, dealt once for all that is counted of them."""

    df: DataFrame
    key: str = "patient_id"
    text: str = "note_text"
    order: Sequence[str] = ("note_date",)
    bucket: Column | None = None
    bucket_rows: int = BUCKET_ROWS

    def __post_init__(self):
        require(self.df, [self.key, self.text, *self.order])
        self._dealing: Dealing | None = None

    def only(self, ids: DataFrame) -> EntityNotes:
        """The notes of the entities in ``ids``, dealt as all of them are."""
        some = replace(self, df=keep_ids(self.df, ids, self.key))
        some._dealing = self.dealing()
        return some

    def dealing(self) -> Dealing:
        if self._dealing is None:
            self._dealing = Dealing.of(self._narrow(), self.key, F.octet_length(self.text))
        return self._dealing

    def terms(self, words: Vocabulary | None = None) -> DataFrame:
        """``(key, term, tf)`` of all terms, or of those of a vocabulary."""
        usual, frequent = self._parts()
        kind = self.df.schema[self.key].dataType.simpleString()
        counted = usual.mapInArrow(run_counts(known_terms(words.terms) if words else all_terms), f"`{self.key}` {kind}, term string, tf long")
        return counted if frequent is None else counted.union(_counted(frequent, self.key, words))

    def totals(self) -> DataFrame:
        """``(term, df, total)``: the entities with a term and its occurrences. A term comes once for every group of entities."""
        usual, frequent = self._parts()
        counted = usual.mapInArrow(run_counts(term_totals), "term string, df long, total long")
        if frequent is None:
            return counted
        rest = _counted(frequent, self.key, None).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
        return counted.union(rest)

    def packed(self, words: Vocabulary) -> DataFrame:
        """Per entity with known terms the array ``_p`` of ``(at, tf * idf)``, by ``at``."""
        usual, frequent = self._parts()
        kind = self.df.schema[self.key].dataType.simpleString()
        counted = usual.mapInArrow(run_counts(known_pairs(words.terms, words.weights)), f"`{self.key}` {kind}, _p array<struct<at:int,w:double>>")
        return counted if frequent is None else counted.union(_packed(_counted(frequent, self.key, words), words, self.key))

    def _narrow(self) -> DataFrame:
        return self.df.select(self.key, *self.order, self.text).filter(F.col(self.text).isNotNull())

    def _parts(self) -> tuple[DataFrame, DataFrame | None]:
        """The words of the usual entities' notes, an entity's in order in one task, and ``(key, term)`` of the others."""
        usual, frequent = self.dealing().split(self._narrow())
        ordered = usual.sortWithinPartitions(self.key, *self.order, self.text).select(self.key, tokens(self.text).alias("_words"))
        if frequent is None:
            return ordered, None
        day = date_bucket(self.order[0]) if self.bucket is None else self.bucket
        spoken = frequent.filter(F.regexp_like(F.lower(self.text), F.lit(rf"{WORD}{{2,}}")))  # a note without words has no first one
        return ordered, _terms_of_frequent(spoken, self.key, self.text, self.order, day, self.bucket_rows)


def entity_terms(
    df: DataFrame,
    key: str = "patient_id",
    text: str = "note_text",
    order: Sequence[str] = ("note_date",),
    bucket: Column | None = None,
    bucket_rows: int = BUCKET_ROWS,
    words: Vocabulary | None = None,
) -> DataFrame:
    """``(key, term, tf)``: words of two or more signs and pairs of neighbouring words of the entity's notes in order.

    The counts are those of the notes joined by blanks; notes of equal order are taken in the order of their texts. Notes without
    words, and null texts, add nothing. ``bucket`` is monotone along ``order``; by default it is the day of its first column.
    With ``words`` only the terms of that vocabulary are counted.

    The notes are moved, not their terms: all notes of an entity come into one task, which counts their terms. Only an entity with more
    notes than a task gets on average is counted by (key, term), and its notes are ordered in buckets.
    """
    return EntityNotes(df, key, text, order, bucket, bucket_rows).terms(words)


def _counted(rows: DataFrame, key: str, words: Vocabulary | None) -> DataFrame:
    if words is not None:
        rows = rows.join(F.broadcast(words.table(rows.sparkSession).select("term")), "term", "left_semi").select(key, "term")
    return rows.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def _terms_of_frequent(notes: DataFrame, key: str, text: str, order: Sequence[str], day: Column, bucket_rows: int) -> DataFrame:
    spoken = notes.withColumn("_words", tokens(text))
    inside = spoken.select(key, F.explode(F.concat("_words", ngrams(F.col("_words"), 2))).alias("term"))
    ends = spoken.select(
        key, *order, text, F.element_at("_words", 1).alias("_head"), F.element_at("_words", -1).alias("_tail")
    )
    borders = adjacent_pairs(ends, [key], [*order, text], "_tail", "_head", day, bucket_rows)
    across = borders.select(key, F.concat_ws(" ", "before", "after").alias("term"))
    return inside.union(across)


@dataclass
class Vocabulary:
    """At most ``max_features`` terms, by total count and then alphabetically, with their inverse document frequencies."""

    terms: list[str]
    weights: list[float]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, i, w) for i, (t, w) in enumerate(zip(self.terms, self.weights, strict=True))]
        return spark.createDataFrame(rows, "term string, at int, idf double")


def fit_vocabulary(
    terms: DataFrame | EntityNotes, entities: int, min_df: int = 2, max_df: float = 0.95, max_features: int = 5000
) -> Vocabulary:
    """The terms of at least ``min_df`` and at most a share ``max_df`` of the ``entities``; the most frequent stay."""
    if isinstance(terms, EntityNotes):
        seen = terms.totals().groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
        kept = most_frequent(seen, F.lit(entities), min_df, max_df, max_features)
    else:
        kept = vocabulary(terms, F.lit(entities), min_df, max_df, max_features)
    rows = kept.orderBy(F.desc("total"), "term").collect()  # at most ``max_features`` rows
    return Vocabulary([r["term"] for r in rows], [r["idf"] for r in rows])


def _packed(terms: DataFrame, words: Vocabulary, key: str) -> DataFrame:
    table = F.broadcast(words.table(terms.sparkSession))  # bounded by the vocabulary's size
    weighted = terms.join(table, "term").select(key, F.struct("at", (F.col("tf") * F.col("idf")).alias("w")).alias("_p"))
    return weighted.groupBy(key).agg(F.sort_array(F.collect_list("_p")).alias("_p"))


def entity_weights(terms: DataFrame | EntityNotes, words: Vocabulary, key: str = "patient_id") -> DataFrame:
    """Per entity the sorted array ``pairs`` of ``(at, weight)``, of unit length; one entry per term of the vocabulary at most."""
    packed = terms.packed(words) if isinstance(terms, EntityNotes) else _packed(terms, words, key)
    norm = F.sqrt(F.aggregate("_p", F.lit(0.0), lambda a, p: a + p["w"] * p["w"]))
    # Repeated beside the pairs, the norm is computed once; named inside a lambda it would be computed for every pair.
    pair = F.zip_with("_p", F.array_repeat(norm, F.size("_p")), lambda p, n: F.struct(p["at"].alias("at"), (p["w"] / n).alias("weight")))
    return packed.select(key, pair.alias("pairs"))


def entity_vectors(
    entities: DataFrame, terms: DataFrame | EntityNotes, words: Vocabulary, key: str = "patient_id", output: str = VECTOR
) -> DataFrame:
    """``entities`` (one row per key) with a sparse vector each; an entity without known terms has an empty one."""
    size, columns = max(len(words.terms), 1), entities.columns
    none = F.array().cast("array<struct<at:int,weight:double>>")
    joined = entities.join(entity_weights(terms, words, key), key, "left").select(
        *columns, F.coalesce("pairs", none).alias("pairs")
    )
    split = joined.select(*columns, F.col("pairs.at").alias("_at"), F.col("pairs.weight").alias("_w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Name the columns as the parts of a sparse vector; the arrays are passed on as they are."""
        for batch in batches:
            n = len(batch)
            at, weight = batch.column(len(columns)), batch.column(len(columns) + 1)
            parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), at, weight]
            vector = pa.StructArray.from_arrays(parts, names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], vector], names=[*columns, output])

    schema = StructType([*[split.schema[c] for c in columns], StructField(output, VectorUDT())])
    return split.mapInArrow(run, schema)


@dataclass
class EntityTextModel:
    words: Vocabulary
    classifier: PipelineModel

    def vectors(self, entities: DataFrame, terms: DataFrame | EntityNotes, key: str = "patient_id") -> DataFrame:
        return entity_vectors(entities, terms, self.words, key)

    def predict(self, entities: DataFrame, terms: DataFrame | EntityNotes, key: str = "patient_id") -> DataFrame:
        return models.prediction_frame(self.classifier, self.vectors(entities, terms, key), (key,))

    def for_texts(self, text: str = "note_text") -> PipelineModel:
        """The same model for rows that hold a whole text, to save it or to score single texts."""
        counter = CountVectorizerModel.from_vocabulary(self.words.terms or [""], inputCol="_grams", outputCol="_tf")
        weights = Vectors.dense(self.words.weights or [0.0])
        return PipelineModel(
            [
                *Pipeline(stages=models.word_stages(text)).getStages(),
                counter,
                ElementwiseProduct(scalingVec=weights, inputCol="_tf", outputCol="_weighted"),
                Normalizer(p=2.0, inputCol="_weighted", outputCol=VECTOR),
                SQLTransformer(statement="SELECT * EXCEPT (_words, _pairs, _grams, _tf, _weighted) FROM __THIS__"),
                *self.classifier.stages,
            ]
        )


def fit_entity_text_classifier(
    entities: DataFrame,
    terms: DataFrame | EntityNotes,
    label: str,
    key: str = "patient_id",
    c: float = 1.0,
    max_iter: int = 1000,
    labels: Sequence[str] | None = None,
    min_df: int = 2,
    max_df: float = 0.95,
    max_features: int = 5000,
) -> EntityTextModel:
    """Vocabulary and multinomial logistic regression with the penalty ``1 / (c n)`` on the vectors of ``entities``
    (one row per key, with ``label``); ``terms`` holds the counts of these entities, or their notes: then the second
    pass counts the terms of the vocabulary only and nothing is saved between."""
    n = entities.count()
    words = fit_vocabulary(terms, n, min_df, max_df, max_features)
    vectors = materialize(entity_vectors(entities.select(key, label), terms, words, key).drop(key))
    return fit_on_vectors(vectors, words, label, n, c, max_iter, labels)


def fit_on_vectors(
    vectors: DataFrame, words: Vocabulary, label: str, n: int, c: float = 1.0, max_iter: int = 1000, labels: Sequence[str] | None = None
) -> EntityTextModel:
    """The regression of ``fit_entity_text_classifier`` on saved rows of ``entity_vectors``, ``n`` in number."""
    indexed = models.label_indexer(label, labels)
    indexed = indexed.fit(vectors) if labels is None else indexed
    model = LogisticRegression(
        featuresCol=VECTOR,
        labelCol="label_index",
        family="multinomial",
        standardization=False,
        regParam=1.0 / (c * max(n, 1)),
        maxIter=max_iter,
    ).fit(indexed.transform(vectors).select(VECTOR, "label_index"))
    return EntityTextModel(words, PipelineModel([indexed, model]))
