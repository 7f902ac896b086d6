"""Features of the notes."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.functions.lexicons import ENTITY_LEXICONS, NOTE_ABBREVIATIONS, STOP_WORDS
from riskframe.functions.textual import ngrams
from riskframe.operators import entity_text, phrases, text
from riskframe.plans.catalog.registry import joined, query, rounded

_CLEANED = r"trim(regexp_replace(regexp_replace(lower(note_text), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g'))"
_LEXICON = {**NOTE_ABBREVIATIONS, "is": "exists as", "le": "masculine article", "der": "article", "and": "plus"}
_ARMS = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in _LEXICON.items())


@query(
    "text_clean_and_expand",
    f"""
    WITH expanded AS (
      SELECT note_id, array_to_string(list_transform(string_split({_CLEANED}, ' '), lambda t: CASE t {_ARMS} ELSE t END), ' ') AS note_text
      FROM notes)
    SELECT note_id, note_text, CASE WHEN note_text IS NOT NULL
      THEN len(list_filter(string_split(note_text, ' '), lambda w: w <> '')) END AS word_count FROM expanded
    """,
)
def text_clean_and_expand(v):
    return text.clean_notes(v.notes, lexicon=_LEXICON).select("note_id", "note_text", "word_count")


_WORDS = {"article_count": ["the", "der", "le", "la"], "joiner_count": ["and", "und", "et", "with"]}


def _whole_words(words: list[str]) -> str:
    wanted = ", ".join(f"'{w.lower()}'" for w in words)
    return (
        r"coalesce(len(list_filter(string_split_regex(lower(note_text), '[^\p{L}\p{N}_]+'), "
        f"lambda x: x IN ({wanted}))), 0)"
    )


@query(
    "text_lexicon_counts",
    "SELECT note_id, " + ", ".join(f"{_whole_words(w)} AS {n}" for n, w in _WORDS.items()) + " FROM notes",
)
def text_lexicon_counts(v):
    return text.with_entity_counts(v.notes, lexicons=_WORDS).select("note_id", *_WORDS)


@query(
    "text_medical_entity_counts",
    "SELECT note_id, "
    + ", ".join(
        f"coalesce(len(regexp_extract_all(concat(' ', regexp_replace(lower(note_text), '[^\\p{{L}}\\p{{N}}_]', '  ', 'g'), ' '), "
        f"' (?:{'|'.join(w.lower().replace('-', '  ').replace(' ', '  ').replace('    ', '  ') for w in words)}) ')), 0) AS {name}"
        for name, words in ENTITY_LEXICONS.items()
    )
    + " FROM notes",
)
def text_medical_entity_counts(v):
    return text.with_entity_counts(v.notes).select("note_id", *ENTITY_LEXICONS)


_DRUG_WORDS = ["thi", "ation", "de", "un", "aspirin", "warfarin"]


@query("text_drug_counts", f"SELECT note_id, {_whole_words(_DRUG_WORDS)} AS drug_count FROM notes")
def text_drug_counts(v):
    return text.with_drug_count(v.notes, drugs=_DRUG_WORDS).select("note_id", "drug_count")


_CUES = ["no ", "not ", "without ", "then "]


def _substrings(words: list[str]) -> str:
    parts = [
        f"(length(lower(note_text)) - length(replace(lower(note_text), '{w}', ''))) // {len(w)}" for w in words
    ]
    return f"coalesce({' + '.join(parts)}, 0)"


def _phrases(cue: str) -> str:
    rest = f"array_to_string(string_split(lower(note_text), '{cue}')[i + 1:i + 62], '{cue}')"
    words = rf"list_filter(string_split_regex(substr({rest}, 1, 60), '\s+'), lambda w: w <> '')[1:4]"
    return (
        f"list_transform(range(1, len(string_split(lower(note_text), '{cue}'))), "
        f"lambda i: array_to_string({words}, ' '))"
    )


@query(
    "text_negations",
    f"""
    SELECT note_id, {_substrings(_CUES)} AS negation_count,
      coalesce(array_to_string(list_filter(flatten([{", ".join(_phrases(c) for c in _CUES)}]), lambda p: p <> ''), '|'), '') AS negated_terms
    FROM notes
    """,
)
def text_negations(v):
    found = text.with_negations(v.notes, cues=_CUES)
    return found.select("note_id", "negation_count", joined("negated_terms").alias("negated_terms"))


_GRAVE, _CALM = ["th", "ation", "ing", "und"], ["le", "on", "er"]


@query(
    "text_severity",
    f"""
    SELECT note_id, {_substrings(_GRAVE)} AS critical_keyword_count, {_substrings(_CALM)} AS benign_keyword_count,
      {_substrings(_GRAVE)} - {_substrings(_CALM)} AS note_severity_score
    FROM notes
    """,
)
def text_severity(v):
    scored = text.with_severity(v.notes, critical=_GRAVE, benign=_CALM)
    return scored.select("note_id", "critical_keyword_count", "benign_keyword_count", "note_severity_score")


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)


@query(
    "text_top_terms",
    f"""
    WITH terms AS (SELECT unnest(regexp_extract_all(lower(note_text), '[a-z]+')) AS term FROM notes)
    SELECT term, count(*) AS n FROM terms WHERE length(term) > 2 AND term NOT IN ({_STOPS})
    GROUP BY term ORDER BY n DESC, term LIMIT 20
    """,
)
def text_top_terms(v):
    return text.top_terms(v.notes)


_TFIDF = r"""
WITH words AS (
  SELECT note_id, coalesce(regexp_extract_all(lower(note_text), '[\p{L}\p{N}_]{2,}'), []) AS w FROM notes),
grams AS (
  SELECT note_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term FROM words),
counts AS (SELECT note_id, term, count(*) AS tf FROM grams GROUP BY note_id, term),
stats AS (SELECT term, count(*) AS df, sum(tf) AS total FROM counts GROUP BY term),
size AS (SELECT count(DISTINCT note_id) AS n FROM notes),
vocabulary AS (
  SELECT term, df, CAST(total AS BIGINT) AS total, ln((1 + n) / (1 + df)) + 1 AS idf FROM stats, size
  WHERE df >= 2 AND df <= 0.95::DOUBLE * n ORDER BY total DESC, term LIMIT 5000)
"""


@query(
    "text_tfidf",
    f"""{_TFIDF}, weighted AS (
      SELECT note_id, c.term, tf, tf * idf AS w FROM counts c JOIN vocabulary v ON c.term = v.term)
    SELECT note_id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY note_id)), 8) AS weight FROM weighted
    """,
)
def text_tfidf(v):
    return rounded(text.tfidf(v.notes, "note_id"), ["weight"], 8)


@query("text_vocabulary", f"{_TFIDF} SELECT term, df, total, round(idf, 9) AS idf FROM vocabulary")
def text_vocabulary(v):
    counts = text.term_counts(v.notes, "note_id", "note_text")
    size = v.notes.agg(F.count_distinct("note_id")).scalar()
    return rounded(text.vocabulary(counts, size), ["idf"], 9)


_BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % {}"


@query(
    "text_hashed_tfidf",
    f"""
    WITH terms AS (
      SELECT note_id, t, count(*) AS n FROM (SELECT note_id, unnest(regexp_extract_all(lower(note_text), '[^\\s]+')) AS t FROM notes) GROUP BY ALL),
    words AS MATERIALIZED (
      SELECT t, {_BUCKET.format("t", 5000)} AS bucket FROM (SELECT DISTINCT t FROM terms) WHERE t NOT IN ({_STOPS})),
    counts AS (SELECT note_id, bucket, CAST(sum(n) AS BIGINT) AS tf FROM terms JOIN words ON terms.t = words.t GROUP BY ALL),
    size AS (SELECT count(DISTINCT note_id) AS n FROM notes),
    idf AS (SELECT bucket, ln((max(n) + 1) / (count(*) + 1)) AS idf FROM counts, size GROUP BY bucket)
    SELECT note_id, CAST(c.bucket AS INT) AS bucket, tf, round(tf * idf, 8) AS weight FROM counts c JOIN idf ON c.bucket = idf.bucket
    """,
)
def text_hashed_tfidf(v):
    return rounded(text.hashed_tfidf_rows(v.notes, "note_id"), ["weight"], 8)


@query(
    "vector_mean_pooling",
    """
    WITH parts AS (
      SELECT label, unnest(range(0, len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings WHERE vec_id % 3 <> 0)
    SELECT label, CAST(dim AS INT) AS dim, round(avg(x), 7) AS x FROM parts GROUP BY label, dim
    """,
)
def vector_mean_pooling(v):
    masked = v.embeddings.withColumn("mask", (F.col("vec_id") % 3 != 0).cast("int"))
    pooled = text.pool_mean(masked, "label", "embedding", "mask")
    return rounded(pooled.select("label", F.posexplode("pooled").alias("dim", "x")), ["x"], 7)


@query(
    "vector_first_pooling",
    """
    WITH firsts AS (SELECT label, arg_min(embedding, vec_id) AS e FROM embeddings GROUP BY label)
    SELECT label, CAST(unnest(range(0, len(e))) AS INT) AS dim, unnest(e)::DOUBLE AS x FROM firsts
    """,
)
def vector_first_pooling(v):
    pooled = text.pool_first(v.embeddings, "label", "embedding", "vec_id")
    return pooled.select("label", F.posexplode("pooled").alias("dim", "x")).withColumn("x", F.col("x").cast("double"))


@query(
    "text_embedding",
    f"""
    WITH words AS (SELECT note_id, unnest(regexp_extract_all(lower(note_text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM notes),
    counts AS (SELECT note_id, {_BUCKET.format("w", 768)} AS bucket, count(*) AS n FROM words GROUP BY ALL),
    peaks AS (SELECT note_id, max(n) / sqrt(sum(n * n)) AS peak FROM counts GROUP BY note_id)
    SELECT n.note_id, 768 AS dim, round(coalesce(peak, 0), 5) AS peak FROM notes n LEFT JOIN peaks p ON n.note_id = p.note_id
    """,
)
def text_embedding(v):
    embedded = text.embed(v.notes.select("note_id", "note_text"))
    peak = F.round(F.array_max("embedding").cast("double"), 5)
    return embedded.select("note_id", F.size("embedding").alias("dim"), peak.alias("peak"))


@query(
    "file_embedding",
    """
    WITH raw AS (SELECT page_id, hex(encode(html)) AS h FROM pages),
    bytes AS (SELECT page_id, length(h) // 2 AS size, unnest(list_transform(range(0, length(h) // 2), lambda i: substr(h, 2 * i + 1, 2))) AS b FROM raw),
    counts AS (SELECT page_id, max(size) AS size, ('0x' || b)::INT // 4 AS slot, count(*) AS n FROM bytes GROUP BY page_id, slot)
    SELECT page_id, true AS ok, round(max(n) / max(size), 5) AS peak FROM counts GROUP BY page_id
    """,
)
def file_embedding(v):
    pages = v.pages.select("page_id", F.col("html").cast("binary").alias("content"))
    embedded = text.embed_files(pages, keep=["page_id"])
    return embedded.select("page_id", "ok", F.round(F.array_max("embedding").cast("double"), 5).alias("peak"))


_HASHED = f"""
WITH words AS (SELECT note_id, note_type, unnest(regexp_extract_all(lower(note_text), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM notes),
places AS MATERIALIZED (SELECT w, {_BUCKET.format("w", 768)} AS bucket FROM (SELECT DISTINCT w FROM words)),
counts AS (SELECT note_id, note_type, bucket, count(*) AS n FROM words JOIN places ON words.w = places.w GROUP BY ALL)
"""


@query(
    "text_batch_classification",
    f"""{_HASHED},
    classes AS (SELECT note_type AS class, row_number() OVER (ORDER BY note_type) - 1 AS c FROM counts WHERE note_type IS NOT NULL GROUP BY note_type),
    seen AS (SELECT note_type AS class, bucket, sum(n) AS n FROM counts WHERE note_type IS NOT NULL GROUP BY ALL),
    sizes AS (SELECT class, sum(n) AS total FROM seen GROUP BY class),
    weights AS (
      SELECT c, b AS bucket, ln((coalesce(n, 0) + 1) / (total + 768)) AS w
      FROM classes JOIN sizes USING (class) CROSS JOIN (SELECT unnest(range(0, 768)) AS b)
      LEFT JOIN seen ON seen.class = classes.class AND seen.bucket = b),
    norms AS (SELECT note_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY note_id),
    logits AS (
      SELECT n.note_id, k.c, coalesce(sum(x.n * w.w) / max(norm), 0) AS z FROM notes n CROSS JOIN classes k
      LEFT JOIN counts x ON x.note_id = n.note_id LEFT JOIN weights w ON w.c = k.c AND w.bucket = x.bucket LEFT JOIN norms m ON m.note_id = n.note_id
      GROUP BY n.note_id, k.c)
    SELECT note_id, CAST(arg_min(c, (-z, c)) AS INT) AS predicted_class,
      round(1 / sum(exp(z - top)), 3) AS confidence
    FROM (SELECT *, max(z) OVER (PARTITION BY note_id) AS top FROM logits) GROUP BY note_id
    """,
)
def text_batch_classification(v):
    notes = v.notes.select("note_id", "note_type", "note_text")
    classes, model = text.fit_term_classes(notes, "note_type")
    embedded = text.embed(notes.select("note_id", "note_text"), output="_vector")
    scored = text.classify(embedded, "_vector", model, len(classes), batch_size=64, input_dim=768)
    return scored.select("note_id", "predicted_class", F.round(F.array_max("probability"), 3).alias("confidence"))


_LISTS = {**_WORDS, "drug_count": _DRUG_WORDS}


@query("text_phrase_counts", "SELECT note_id, " + ", ".join(f"{_whole_words(w)} AS {n}" for n, w in _LISTS.items()) + " FROM notes")
def text_phrase_counts(v):
    rows = [(w, n) for n, some in _LISTS.items() for w in some]
    lexicon = v.spark.createDataFrame(rows, "phrase string, lexicon string")
    return phrases.with_phrase_counts(v.notes, lexicon, list(_LISTS)).select("note_id", *_LISTS)


# All pairs of neighbouring words of the benchmark are the lexicon, so it grows with the tables.
@query(
    "text_phrase_hits",
    r"""
    WITH parts AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark),
    pairs AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: {'a': w[i], 'b': w[i + 1]})) AS p FROM parts),
    lexicon AS (
      SELECT DISTINCT p.a || ' ' || p.b AS phrase FROM pairs
      WHERE regexp_full_match(p.a, '[\p{L}\p{N}_]+') AND regexp_full_match(p.b, '[\p{L}\p{N}_]+')),
    pieces AS (SELECT note_id, regexp_extract_all(lower(note_text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS p FROM notes),
    runs AS (SELECT note_id, unnest(list_transform(range(1, len(p) - 1), lambda i: CASE WHEN p[i + 1] = ' ' THEN p[i] || ' ' || p[i + 2] END)) AS phrase FROM pieces)
    SELECT note_id, runs.phrase, count(*) AS n FROM runs JOIN lexicon ON runs.phrase = lexicon.phrase GROUP BY ALL
    """,
)
def text_phrase_hits(v):
    words = F.split(F.lower("text"), " ")
    whole = F.col("phrase").rlike(r"^[\p{L}\p{N}_]+ [\p{L}\p{N}_]+$")
    pairs = v.benchmark.select(F.explode(ngrams(words, 2)).alias("phrase"), F.lit("benchmark").alias("lexicon")).filter(whole)
    hits = phrases.phrase_hits(v.notes, pairs)
    return hits.groupBy("note_id", "phrase").agg(F.count(F.lit(1)).alias("n"))


_ENTITY_TERMS = r"""
WITH joined_notes AS (
  SELECT patient_id, string_agg(note_text, ' ' ORDER BY note_date, note_id, note_text) AS body FROM notes WHERE note_text IS NOT NULL GROUP BY patient_id),
words AS (SELECT patient_id, regexp_extract_all(lower(body), '[\p{L}\p{N}_]{2,}') AS w FROM joined_notes),
terms AS (
  SELECT patient_id, term, count(*) AS tf FROM (
    SELECT patient_id, unnest(w) AS term FROM words
    UNION ALL SELECT patient_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words)
  GROUP BY patient_id, term)
"""


def _entity_terms(v, words=None):
    return entity_text.entity_terms(v.notes, order=("note_date", "note_id"), words=words)


@query("text_entity_terms", f"{_ENTITY_TERMS} SELECT patient_id, term, tf FROM terms")
def text_entity_terms(v):
    return _entity_terms(v)


@query(
    "text_entity_weights",
    f"""{_ENTITY_TERMS},
    n AS (SELECT count(*) AS n FROM joined_notes),
    kept AS (
      SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf FROM terms, n GROUP BY term, n
      HAVING count(*) >= 2 AND count(*) <= 0.95 * n ORDER BY sum(tf) DESC, term LIMIT 5000),
    weighted AS (SELECT patient_id, term, tf * idf AS w FROM terms JOIN kept USING (term))
    SELECT patient_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY patient_id)), 7) AS weight FROM weighted
    """,
)
def text_entity_weights(v):
    entities = v.notes.filter(F.col("note_text").isNotNull()).agg(F.count_distinct("patient_id")).first()[0]
    words = entity_text.fit_vocabulary(_entity_terms(v), entities)
    pairs = entity_text.entity_weights(_entity_terms(v, words), words).select("patient_id", F.inline("pairs"))
    named = pairs.join(F.broadcast(words.table(v.spark)), "at")
    return rounded(named.select("patient_id", "term", "weight"), ["weight"], 7)
