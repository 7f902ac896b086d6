"""The text model on term counts against the model on joined texts."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskframe.operators import entity_text, grouped_terms, integrate, models, sizing

WORDS = "fever cough pain normal visit acute stable x no chest mild today".split()


@pytest.fixture(scope="module")
def notes(spark):
    """One entity holds most notes, all of one day; some notes have no words or no text, some are equal."""
    rng, rows = random.Random(11), []
    for i in range(900):
        who = 0 if i % 3 else 1 + i % 40
        body = " ".join(rng.choices(WORDS, k=rng.randrange(0, 6))) + rng.choice(["", ".", " !"])
        rows.append((who, "2024-01-05" if i % 7 else None, rng.randrange(500), None if i % 31 == 0 else body, "ill" if who % 2 else "well"))
    return spark.createDataFrame(rows, "patient_id int, note_date string, n int, note_text string, label string").repartition(4)


def brute_terms(rows):
    groups = {}
    for r in rows:
        if r["note_text"] is not None:
            groups.setdefault(r["patient_id"], []).append((r["note_date"] is not None, r["note_date"] or "", r["n"], r["note_text"]))
    found = Counter()
    for who, some in groups.items():
        words = [w for w in " ".join(x[3] for x in sorted(some)).replace(".", " ").replace("!", " ").split() if len(w) > 1]
        found.update((who, w) for w in words)
        found.update((who, f"{a} {b}") for a, b in zip(words, words[1:]))
    return found


@pytest.mark.parametrize("limit", [200_000, 40])
def test_terms_are_those_of_the_joined_texts(spark, notes, limit):
    got = entity_text.entity_terms(notes, order=("note_date", "n"), bucket_rows=limit).collect()
    assert {(r["patient_id"], r["term"]): r["tf"] for r in got} == brute_terms(notes.collect())
    assert len(got) == len(brute_terms(notes.collect()))


def test_same_model_as_on_joined_texts(spark, notes, tmp_path):
    order = ("note_date", "n")
    joined = integrate.concat_texts(notes, order=order, label="label")
    old = models.fit_text_classifier(joined, "label", max_df=1.0, min_df=2)
    terms = entity_text.entity_terms(notes, order=order)
    entities = notes.filter(F.col("note_text").isNotNull()).select("patient_id", "label").distinct()
    new = entity_text.fit_entity_text_classifier(entities, terms, "label", max_df=1.0)
    before, after = old.stages[-1], new.classifier.stages[-1]
    counter = next(s for s in old.stages if hasattr(s, "vocabulary"))
    assert set(counter.vocabulary) == set(new.words.terms)
    one = dict(zip(counter.vocabulary, before.coefficientMatrix.toArray().T.tolist(), strict=True))
    two = dict(zip(new.words.terms, after.coefficientMatrix.toArray().T.tolist(), strict=True))
    assert np.allclose([one[t] for t in new.words.terms], [two[t] for t in new.words.terms], atol=1e-5)
    expected = {r["patient_id"]: r["prob"] for r in models.prediction_frame(old, joined).collect()}
    got = {r["patient_id"]: r["prob"] for r in new.predict(entities, terms).collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k], abs=1e-5) for k in got)
    # The model for whole texts is the same model, also after it was saved.
    new.for_texts().write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    texts = {r["patient_id"]: r["prob"] for r in models.prediction_frame(loaded, joined).collect()}
    assert all(texts[k] == pytest.approx(got[k], abs=1e-9) for k in got)


def test_entities_without_known_terms_have_empty_vectors(spark):
    notes = spark.createDataFrame(
        [(1, "2024-01-01", "fever"), (2, "2024-01-01", "fever"), (3, "2024-01-01", "?"), (4, "2024-01-01", "rare")], "patient_id int, note_date string, note_text string"
    )
    terms = entity_text.entity_terms(notes)
    words = entity_text.fit_vocabulary(terms, 4)
    assert words.terms == ["fever"]
    got = {r["patient_id"]: r["text_features"].toArray().tolist() for r in entity_text.entity_vectors(notes.select("patient_id"), terms, words).collect()}
    assert got == {1: [1.0], 2: [1.0], 3: [0.0], 4: [0.0]}
    assert entity_text.fit_vocabulary(terms.limit(0), 0).terms == []


def test_no_row_collects_texts(spark, notes):
    plan = entity_text.entity_terms(notes, order=("note_date", "n"))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "array_join" not in plan


def test_terms_are_counted_without_moving_them(spark):
    """Notes are dealt by entity; no exchange moves the terms, and the vocabulary is applied before they are counted."""
    rows = [(i // 2, "2024-01-05", i, f"fever cough w{i % 9} pain") for i in range(4000)]
    notes = spark.createDataFrame(rows, "patient_id int, note_date string, n int, note_text string")
    terms = entity_text.entity_terms(notes, order=("note_date", "n"))
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "term" not in plan.split("Exchange ")[1].split("\n")[0]
    got = {(r["patient_id"], r["term"]): r["tf"] for r in terms.collect()}
    assert got[3, "fever"] == 2 and got[3, "pain fever"] == 1 and got[3, "w6 pain"] == 1
    words = entity_text.Vocabulary(["fever", "pain fever"], [1.0, 2.0])
    some = entity_text.entity_terms(notes, order=("note_date", "n"), words=words).collect()
    assert {(r["patient_id"], r["term"]): r["tf"] for r in some} == {k: n for k, n in got.items() if k[1] in words.terms}


def test_norm_is_computed_once_per_entity(spark):
    terms = spark.createDataFrame([(1, "a", 3), (1, "b", 4)], "patient_id int, term string, tf long")
    weights = entity_text.entity_weights(terms, entity_text.Vocabulary(["a", "b"], [1.0, 1.0]))
    assert [tuple(p) for p in weights.first()["pairs"]] == [(0, 0.6), (1, 0.8)]
    plan = weights._jdf.queryExecution().optimizedPlan().toString()
    assert "array_repeat(SQRT" in plan


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_groups_cut_no_entity(monkeypatch, size):
    """An entity's words may come in several batches; its pairs across notes and batches are counted, those across entities are not."""
    rows = [(None, ["aa", "bb"]), (1, ["aa", "bb"]), (1, []), (1, ["aa"]), (2, []), (3, ["bb", "aa", "bb", "aa", "bb"]), (3, ["cc"]), (4, ["cc"])]
    expected = Counter()
    for who in (None, 1, 3, 4):
        words = [w for k, some in rows if k == who for w in some]
        expected.update([(who, w) for w in words] + [(who, f"{a} {b}") for a, b in zip(words, words[1:])])
    kind = pa.schema([("k", pa.int64()), ("w", pa.list_(pa.string()))])
    batches = [pa.RecordBatch.from_pylist([dict(zip("kw", r)) for r in rows[i : i + 3]], schema=kind) for i in range(0, len(rows), 3)]
    monkeypatch.setattr(grouped_terms, "GROUP_WORDS", size)
    monkeypatch.setattr(grouped_terms, "OUTPUT_ROWS", 2)

    def found(count):
        return [tuple(r.values()) for b in grouped_terms.run_counts(count)(iter(batches)) for r in b.to_pylist()]

    every = found(grouped_terms.all_terms)
    assert {(k, t): n for k, t, n in every} == expected and len(every) == len(expected)
    totals = {}
    for term, df, total in found(grouped_terms.term_totals):
        totals[term] = tuple(map(sum, zip(totals.get(term, (0, 0)), (df, total))))
    assert totals == {t: (sum(u == t for _, u in expected), sum(n for (_, u), n in expected.items() if u == t)) for t in {u for _, u in expected}}
    some = ["bb aa", "bb", "no", "no bb", "aa bb"]
    assert {(k, t): n for k, t, n in found(grouped_terms.known_terms(some))} == {k: n for k, n in expected.items() if k[1] in some}
    pairs = {k: [tuple(p.values()) for p in ps] for k, ps in found(grouped_terms.known_pairs(some, [2.0, 1.0, 1.0, 1.0, 0.5]))}
    assert pairs == {None: [(1, 1.0), (4, 0.5)], 1: [(0, 2.0), (1, 1.0), (4, 0.5)], 3: [(0, 4.0), (1, 3.0), (4, 1.0)]}


def test_numbers_too_large_for_one_are_told_apart():
    outer, inner = np.array([1 << 61, 3, 1 << 61, 3]), np.array([7, 7, 7, 1 << 20])
    assert [x.tolist() for x in grouped_terms._tally(outer, inner)] == [[3, 3, 1 << 61], [7, 1 << 20, 7], [1, 1, 2]]


def test_notes_give_what_their_counted_terms_give(spark, notes):
    """Vocabulary and weights of the notes, also of the entity with too many of them for one task; neither moves terms of entities."""
    order = ("note_date", "n")
    spoken, terms = entity_text.EntityNotes(notes, order=order), entity_text.entity_terms(notes, order=order)
    assert len(spoken.dealing().hot) == 1
    words = entity_text.fit_vocabulary(spoken, 41, max_df=1.0)
    assert words == entity_text.fit_vocabulary(terms, 41, max_df=1.0) and len(words.terms) > 100
    got, expected = ({r[0]: r[1] for r in entity_text.entity_weights(x, words).collect()} for x in (spoken, terms))
    assert got == expected and len(got) == 41
    few = entity_text.EntityNotes(notes.filter("patient_id > 0"), order=order)
    plans = [x._jdf.queryExecution().executedPlan().toString() for x in (few.totals(), few.packed(words))]
    assert [p.count("Exchange ") for p in plans] == [1, 1] and not any("Generate" in p for p in plans)


def test_notes_of_some_entities_are_dealt_as_all_are(spark, notes):
    spoken = entity_text.EntityNotes(notes, order=("note_date", "n"))
    some = spoken.only(spark.createDataFrame([(3,), (4,)], "patient_id int"))
    assert some.dealing() is spoken.dealing()
    expected = {r[:] for r in spoken.terms().filter("patient_id in (3, 4)").collect()}
    assert {r[:] for r in some.terms().collect()} == expected and expected


def test_fits_get_rows_on_all_cores(spark, monkeypatch):
    """A plan hands on few tasks for few bytes; a fit of many passes gets as many tasks as there are cores, or whole rounds of them."""
    cores = spark.sparkContext.defaultParallelism
    sizes = lambda df: df.groupBy(F.spark_partition_id()).count().orderBy("count").toPandas()["count"].tolist()
    assert sizes(sizing.evenly(spark.range(400 * cores).coalesce(1))) == pytest.approx([400] * cores, rel=0.02)
    assert sizing.evenly(spark.range(3)).count() == 3 and sizing.evenly(spark.range(0)).count() == 0
    monkeypatch.setattr(sizing, "MOST_ROWS", 300)
    assert len(sizes(sizing.evenly(spark.range(400 * cores).coalesce(1)))) == min(2 * cores, 400 * cores // sizing.LEAST_ROWS)
