from pyspark.sql import functions as F

from riskframe.functions.textual import ngrams, tokens
from riskframe.operators import text


def notes(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "note_id int, note_text string")


def collect(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("note_id").collect()]


def test_clean_and_expand(spark):
    got = collect(text.clean_notes(notes(spark, "Pt  c/o SOB; BP 120/80!", "", None)), "note_text", "word_count")
    assert got[0] == ("patient co shortness of breath blood pressure 12080", 8)
    assert got[1] == ("", 0) and got[2] == (None, None)


def test_entity_counts(spark):
    df = notes(spark, "ASPIRIN and metformin, aspirins; CT scan of the lung. X-ray. copd", None)
    got = collect(text.with_entity_counts(df), "medication_count", "diagnosis_count", "procedure_count", "anatomy_count")
    assert got == [(2, 1, 2, 1), (0, 0, 0, 0)]


def test_negations(spark):
    df = notes(spark, "No evidence of fever or chills today at all. Denies pain", "no ", None)
    got = collect(text.with_negations(df), "negation_count", "negated_terms")
    assert got[0][0] == 3  # "no ", "no evidence of ", "denies "
    assert got[0][1] == ["evidence of fever or", "pain", "fever or chills today"]
    assert got[1] == (1, []) and got[2] == (0, [])


def test_negation_window_is_sixty_characters(spark):
    df = notes(spark, "without " + "a" * 58 + " bcd efg")
    assert collect(text.with_negations(df), "negated_terms")[0][0] == ["a" * 58 + " b"]


def test_severity(spark):
    df = notes(spark, "Unstable, critical. Stable and stat", None)
    got = collect(text.with_severity(df), "critical_keyword_count", "benign_keyword_count", "note_severity_score")
    assert got == [(3, 2, 1), (0, 0, 0)]


def test_top_terms_and_ngrams(spark):
    df = notes(spark, "the pain pain fever", "fever to be pain", None)
    assert [(r["term"], r["n"]) for r in text.top_terms(df, n=2).collect()] == [("pain", 3), ("fever", 2)]
    grams = df.select("note_id", ngrams(tokens("note_text"), 2).alias("g"), ngrams(tokens("note_text"), 9).alias("h"))
    assert collect(grams, "g", "h")[0] == (["the pain", "pain pain", "pain fever"], [])


def test_tfidf_has_unit_length(spark):
    df = notes(spark, "aa bb cc aa", "aa bb dd", "cc dd ee", "ee ff", "")
    rows = text.tfidf(df, "note_id").groupBy("note_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert len(rows) == 4 and all(abs(r["s"] - 1) < 1e-9 for r in rows)


def test_embedding_keeps_rows_and_flags_unreadable(spark):
    df = notes(spark, "some words here", None, "some words here")
    got = collect(text.embed(df, dim=32, batch_size=2), "embedding")
    assert len(got) == 3 and got[0] == got[2] and not any(got[1][0])
    files = spark.createDataFrame([("a", b"xyz"), ("b", b"")], "path string, content binary")

    def strict():
        def predict(contents):
            if not contents[0]:
                raise ValueError("empty")
            return [[1.0, 2.0]]

        return predict

    rows = {r["path"]: r for r in text.embed_files(files, make_model=strict, dim=2).collect()}
    assert rows["a"]["ok"] and list(rows["a"]["embedding"]) == [1.0, 2.0]
    assert not rows["b"]["ok"] and list(rows["b"]["embedding"]) == [0.0, 0.0]


def test_row_wise_operators_run_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "notes")
    notes(spark, "acute pain", "normal").write.parquet(source)
    stream = spark.readStream.schema("note_id int, note_text string").parquet(source)
    query = (
        text.with_severity(text.clean_notes(stream)).writeStream.format("memory").queryName("scored_notes").outputMode("append")
        .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination(60)
    scores = {r["note_id"]: r["note_severity_score"] for r in spark.table("scored_notes").collect()}
    assert scores == {0: 1, 1: -1}


def test_terms_of_unique_notes_are_not_moved(spark):
    rows = [(i, f"fever cough w{i % 7}") for i in range(3000)] + [(5, "fever"), (6, None)]
    notes = spark.createDataFrame(rows, "note_id int, note_text string")
    counts = text.term_counts(notes, "note_id", "note_text")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
    got = {(r["note_id"], r["term"]): r["tf"] for r in counts.collect()}
    assert got[5, "fever"] == 2 and got[5, "cough w5"] == 1 and len(got) == 15000
    buckets = text.hashed_tfidf_rows(notes, "note_id").select("note_id", "bucket", "tf")
    assert sum(r["tf"] for r in buckets.collect()) == 9001


def test_models_get_bounded_groups_of_files(spark, monkeypatch):
    """Whatever the rows of a batch, a model sees about ``FILE_BYTES`` at once; null and empty files come back too."""
    bodies = [b"a" * 5000 for _ in range(40)] + [None, b"", b"\x00\xff" * 3]
    files = spark.createDataFrame(list(enumerate(bodies)), "page_id long, content binary").coalesce(1)

    def sizes():
        def predict(contents):
            total = sum(len(c) for c in contents)
            if total > 20000:
                raise ValueError("too many at once")
            return [[float(total)] for _ in contents]

        return predict

    monkeypatch.setattr(text, "FILE_BYTES", 10000)
    rows = {r["page_id"]: r for r in text.embed_files(files, keep=["page_id"], make_model=sizes, dim=1).collect()}
    assert len(rows) == 43 and max(r["embedding"][0] for r in rows.values()) == 10000.0 and not rows[40]["ok"] and rows[41]["ok"]
    found = {r["page_id"]: r for r in text.embed_files(files, keep=["page_id"]).collect()}
    assert [found[i]["ok"] for i in (0, 40, 41, 42)] == [True, False, False, True]
    assert found[0]["embedding"][24] == 1.0 and found[42]["embedding"][0] == found[42]["embedding"][63] == 0.5


def test_hashed_vectors_of_empty_and_null_texts(spark):
    rows = spark.createDataFrame([(0, None), (1, "? "), (2, "a b b")], "i int, t string")
    got = {r["i"]: sorted(r["embedding"], reverse=True)[:2] for r in text.embed(rows, "t").collect()}
    assert got == {0: [0.0, 0.0], 1: [0.0, 0.0], 2: [2 / 5**0.5, 1 / 5**0.5]}
