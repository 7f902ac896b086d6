"""Exploratory summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import SYMPTOM_CLUSTERS, SYMPTOMS
from riskframe.operators import explore, integrate, labs, scorecard
from riskframe.plans.catalog.laboratory import _WIDE, _PANELS, latest_wide
from riskframe.plans.catalog.registry import query, rounded
from riskframe.plans.catalog.scoring import _CLUSTERS, _MEWS
from riskframe.functions.presets import LAB_PANELS

_VITALS = ["heart_rate", "systolic_bp", "temperature", "oxygen_saturation"]

_PREVALENCE = " UNION ALL ".join(
    f"SELECT final_diagnosis, '{s}' AS flag, round(avg({s}) * 100, 6) AS pct FROM symptoms s "
    "JOIN truth t ON s.patient_id = t.patient_id GROUP BY final_diagnosis"
    for s in SYMPTOMS
)


@query("flag_prevalence_by_class", _PREVALENCE)
def flag_prevalence_by_class(v):
    joined = v.symptoms.join(v.truth, "patient_id")
    return rounded(explore.flag_prevalence(joined, SYMPTOMS, "final_diagnosis"), ["pct"])


@query(
    "long_prevalence_by_class",
    """
    WITH entities AS (SELECT l_returnflag, count(DISTINCT l_orderkey) AS k FROM lineitem GROUP BY l_returnflag),
    pairs AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus)
    SELECT pairs.l_returnflag, l_linestatus, round(n / k * 100, 6) AS pct FROM pairs JOIN entities ON pairs.l_returnflag = entities.l_returnflag
    """,
)
def long_prevalence_by_class(v):
    shares = explore.long_prevalence(v.lineitem, "l_linestatus", "l_returnflag", "l_orderkey")
    return rounded(shares, ["pct"])


def _describe_sql(source: str, columns: dict[str, str], label: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {label}, '{c}' AS feature, count({sql}) AS n, round(avg({sql}), 6) AS mean, "
        f"round(stddev_samp({sql}), 6) AS std, CAST(min({sql}) AS DOUBLE) AS \"min\", "
        f"round(quantile_cont({sql}, 0.25), 6) AS p25, round(quantile_cont({sql}, 0.5), 6) AS p50, "
        f"round(quantile_cont({sql}, 0.75), 6) AS p75, CAST(max({sql}) AS DOUBLE) AS \"max\" FROM {source} GROUP BY {label}"
        for c, sql in columns.items()
    )


@query(
    "describe_scores_by_class",
    f"WITH scored AS (SELECT final_diagnosis, {_MEWS} AS mews_score, bmi FROM patients p JOIN truth t ON p.patient_id = t.patient_id) "
    + _describe_sql("scored", {"mews_score": "mews_score", "bmi": "bmi"}, "final_diagnosis"),
)
def describe_scores_by_class(v):
    scored = scorecard.with_vital_scores(v.patients).join(v.truth, "patient_id")
    table = explore.describe_by(scored, ["mews_score", "bmi"], "final_diagnosis")
    return rounded(table, ["mean", "std", "p25", "p50", "p75"])


@query(
    "describe_prices_by_status",
    _describe_sql("orders", {"o_totalprice": "o_totalprice"}, "o_orderstatus"),
)
def describe_prices_by_status(v):
    return rounded(explore.describe_by(v.orders, ["o_totalprice"], "o_orderstatus"), ["mean", "std", "p25", "p50", "p75"])


@query(
    "summarize_vitals",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f'CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" FROM patients'
        for c in _VITALS
    ),
)
def summarize_vitals(v):
    return rounded(explore.summarize(v.patients, _VITALS), ["mean", "std"])


@query(
    "value_counts_of_diagnosis",
    """
    SELECT final_diagnosis, count(*) AS n, round(count(*) / (SELECT count(*) FROM truth WHERE final_diagnosis IS NOT NULL) * 100, 6) AS pct
    FROM truth WHERE final_diagnosis IS NOT NULL GROUP BY final_diagnosis
    """,
)
def value_counts_of_diagnosis(v):
    return rounded(explore.value_counts(v.truth, "final_diagnosis"), ["pct"])


@query(
    "class_imbalance",
    """
    WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
    SELECT count(*) AS n_classes, round(max(n) / min(n), 6) AS ratio FROM counts
    """,
)
def class_imbalance(v):
    return rounded(explore.imbalance_ratio(v.events, "event_type"), ["ratio"])


_FLAGGED = """
WITH flagged AS (
  SELECT final_diagnosis, CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END AS is_abnormal
  FROM labs l LEFT JOIN truth t ON l.patient_id = t.patient_id)
"""


@query(
    "abnormal_rate_by_class",
    f"{_FLAGGED} SELECT final_diagnosis, round(avg(is_abnormal) * 100, 6) AS pct FROM flagged GROUP BY final_diagnosis",
)
def abnormal_rate_by_class(v):
    flagged = integrate.with_label(v.labs.withColumn("is_abnormal", labs.abnormal_flag()), v.truth)
    return rounded(explore.flag_rate(flagged, "is_abnormal", "final_diagnosis"), ["pct"])


@query("measurements_by_class", f"{_FLAGGED} SELECT final_diagnosis, count(*) AS n FROM flagged GROUP BY final_diagnosis")
def measurements_by_class(v):
    return explore.count_by(integrate.with_label(v.labs, v.truth), "final_diagnosis")


@query("distinct_tests", "SELECT DISTINCT test_name FROM labs")
def distinct_tests(v):
    return explore.distinct_values(v.labs, "test_name")


@query(
    "distinct_counts",
    """
    SELECT 'patient_id' AS feature, count(DISTINCT patient_id) AS n_distinct FROM labs
    UNION ALL SELECT 'test_name', count(DISTINCT test_name) FROM labs
    UNION ALL SELECT 'test_date', count(DISTINCT test_date) FROM labs
    """,
)
def distinct_counts(v):
    return explore.distinct_counts(v.labs, ["patient_id", "test_name", "test_date"])


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(_NUMBERS)
    for b in _NUMBERS[i + 1 :]
)


@query("correlation_matrix", _PAIRS)
def correlation_matrix(v):
    return rounded(explore.correlations(v.lineitem, _NUMBERS), ["r"])


# 64 columns: the components of the vectors, each missing in one row of seven.
_COMPONENTS = 64


@query(
    "correlation_wide",
    f"""
    WITH long AS (
      SELECT vec_id, d, CASE WHEN (vec_id + d) % 7 <> 0 THEN embedding[d + 1]::DOUBLE END AS x
      FROM embeddings, (SELECT unnest(range(0, {_COMPONENTS})) AS d) WHERE len(embedding) = {_COMPONENTS})
    SELECT concat('c', a.d) AS feature_a, concat('c', b.d) AS feature_b, round(corr(a.x, b.x), 6) AS r
    FROM long a JOIN long b ON a.vec_id = b.vec_id AND a.d < b.d GROUP BY a.d, b.d
    """,
)
def correlation_wide(v):
    rows = v.embeddings.filter(F.size("embedding") == _COMPONENTS)
    value = lambda d: F.when((F.col("vec_id") + d) % 7 != 0, F.col("embedding")[d].cast("double"))
    wide = rows.select(*[value(d).alias(f"c{d}") for d in range(_COMPONENTS)])
    return rounded(explore.correlations(wide, wide.columns), ["r"])


_PATIENT_NUMBERS = ["age", "bmi", "heart_rate", "systolic_bp", "temperature", "respiratory_rate"]
_PATIENT_PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r FROM patients"
    for i, a in enumerate(_PATIENT_NUMBERS)
    for b in _PATIENT_NUMBERS[i + 1 :]
)


@query(
    "strongest_correlations",
    f"SELECT * FROM ({_PATIENT_PAIRS}) pairs ORDER BY abs(r) DESC, feature_a, feature_b LIMIT 10",
)
def strongest_correlations(v):
    matrix = explore.correlations(v.patients, _PATIENT_NUMBERS)
    return explore.strongest_pairs(rounded(matrix, ["r"]))


@query(
    "cluster_profile_by_class",
    f"""
    WITH clustered AS (
      SELECT final_diagnosis, {_CLUSTERS} FROM symptoms s JOIN truth t ON s.patient_id = t.patient_id)
    """
    + " UNION ALL ".join(
        f"SELECT final_diagnosis, '{c}' AS feature, round(avg({c}) / (SELECT max({c}) FROM clustered), 6) AS profile "
        "FROM clustered GROUP BY final_diagnosis"
        for c in SYMPTOM_CLUSTERS
    ),
)
def cluster_profile_by_class(v):
    clustered = scorecard.with_symptom_clusters(v.symptoms).join(v.truth, "patient_id")
    return rounded(explore.cluster_profile(clustered, list(SYMPTOM_CLUSTERS), "final_diagnosis"), ["profile"])


@query(
    "mean_panel_by_class",
    f"""{_WIDE},
    panels AS (SELECT patient_id, {_PANELS} FROM wide)
    SELECT final_diagnosis, {", ".join(f"round(avg({p}), 4) AS {p}" for p in LAB_PANELS)}
    FROM panels JOIN truth ON panels.patient_id = truth.patient_id GROUP BY final_diagnosis
    """,
)
def mean_panel_by_class(v):
    panels = labs.with_panel_scores(labs.with_deviations(latest_wide(v)))
    joined = panels.join(v.truth, "patient_id")
    return rounded(explore.mean_by(joined, list(LAB_PANELS), "final_diagnosis"), list(LAB_PANELS), 4)


def _histogram_sql(source: str, column: str, bins: int, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    return f"""
    WITH limits AS (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM {source}),
    binned AS (
      SELECT {keys}CAST(least(floor(({column} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INT) AS bin, lo, hi
      FROM {source}, limits WHERE {column} IS NOT NULL)
    SELECT {keys}bin, count(*) AS n, round(min(lo + (hi - lo) * bin / {bins}), 6) AS bin_low,
      round(min(lo + (hi - lo) * (bin + 1) / {bins}), 6) AS bin_high
    FROM binned GROUP BY {keys}bin
    """


@query("age_histogram", _histogram_sql("patients", "age", 30))
def age_histogram(v):
    return rounded(explore.histogram(v.patients, "age", 30), ["bin_low", "bin_high"])


@query("price_histogram_by_status", _histogram_sql("orders", "o_totalprice", 50, "o_orderstatus"))
def price_histogram_by_status(v):
    return rounded(explore.histogram(v.orders, "o_totalprice", 50, ["o_orderstatus"]), ["bin_low", "bin_high"])


@query(
    "box_summary_by_class",
    "WITH joined AS (SELECT * FROM patients JOIN truth USING (patient_id)) "
    + " UNION ALL ".join(
        f"""SELECT q.final_diagnosis, '{c}' AS feature, count(*) AS n, round(min(q1), 6) AS q1, round(min(q2), 6) AS median,
      round(min(q3), 6) AS q3,
      round(least(min(CASE WHEN {c} >= q1 - (q3 - q1) * 1.5 THEN {c} END), min(q1)), 6) AS whisker_low,
      round(greatest(max(CASE WHEN {c} <= q3 + (q3 - q1) * 1.5 THEN {c} END), min(q3)), 6) AS whisker_high
    FROM joined j JOIN (
      SELECT final_diagnosis, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
      FROM joined GROUP BY final_diagnosis) q ON j.final_diagnosis = q.final_diagnosis
    WHERE {c} IS NOT NULL GROUP BY q.final_diagnosis"""
        for c in _VITALS
    ),
)
def box_summary_by_class(v):
    table = explore.box_summary(v.patients.join(v.truth, "patient_id"), _VITALS, "final_diagnosis")
    return rounded(table, ["q1", "median", "q3", "whisker_low", "whisker_high"])


@query(
    "balanced_class_weights",
    """
    WITH counts AS (SELECT final_diagnosis, count(*) AS n FROM truth GROUP BY final_diagnosis)
    SELECT patient_id, t.final_diagnosis,
      round((SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n + 1e-6), 9) AS class_weight
    FROM truth t JOIN counts c ON t.final_diagnosis = c.final_diagnosis
    """,
)
def balanced_class_weights(v):
    weighted = explore.with_class_weight(v.truth, "final_diagnosis")
    return rounded(weighted.select("patient_id", "final_diagnosis", "class_weight"), ["class_weight"], 9)


@query(
    "top_labels",
    "SELECT p_type, count(*) AS n FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 10",
)
def top_labels(v):
    return explore.top_labels(v.part, "p_type")


@query("first_rows", "SELECT * FROM truth ORDER BY patient_id LIMIT 20")
def first_rows(v):
    return explore.first_rows(v.truth)


_FEATURES = ["age", "bmi", "heart_rate", "oxygen_saturation"]
_EDGES = ", ".join(
    f"(SELECT quantile_disc(coalesce({c}, 0)::DOUBLE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM patients) AS e_{c}"
    for c in _FEATURES
)
_BINS = " UNION ALL ".join(
    f"SELECT risk_level AS class, '{c}' AS feature, len(list_filter(e_{c}, lambda e: e < coalesce({c}, 0))) AS bin FROM base"
    for c in _FEATURES
)
_INFORMATION = f"""
WITH edges AS (SELECT {_EDGES}),
base AS (SELECT p.*, t.risk_level, edges.* FROM patients p JOIN truth t ON p.patient_id = t.patient_id, edges),
binned AS ({_BINS}),
joint AS (SELECT feature, bin, class, CAST(count(*) AS DOUBLE) AS n FROM binned GROUP BY feature, bin, class),
shares AS (
  SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS n_all, sum(n) OVER (PARTITION BY feature, bin) AS n_bin,
    sum(n) OVER (PARTITION BY feature, class) AS n_class FROM joint)
SELECT feature, round(sum(n / n_all * ln(n * n_all / (n_bin * n_class))), 6) AS mi_score FROM shares GROUP BY feature
"""


@query("mutual_information", _INFORMATION)
def mutual_information(v):
    joined = v.patients.join(v.truth, "patient_id")
    return rounded(explore.mutual_information(joined, _FEATURES, "risk_level"), ["mi_score"])


def _digamma_sql(n: str) -> str:
    y = f"({n} + 8.0::DOUBLE)"
    series = f"ln{y} - 0.5 / {y} - (1 / 12.0::DOUBLE - (1 / 120.0::DOUBLE - (1 / 252.0::DOUBLE - 1 / ({y} * {y}) / 240) / ({y} * {y})) / ({y} * {y})) / ({y} * {y})"
    return f"({series} - ({' + '.join(f'1.0::DOUBLE / ({n} + {i})' for i in range(8))}))"


_LONG_FEATURES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, coalesce({c}, 0)::DOUBLE AS x, coalesce(risk_level, 'unknown') AS class FROM rows_" for c in _FEATURES
)


@query(
    "mutual_information_nearest",
    f"""
    WITH rows_ AS (SELECT * FROM patients p JOIN truth t ON p.patient_id = t.patient_id),
    counts AS MATERIALIZED (SELECT feature, class, x, count(*) AS n FROM ({_LONG_FEATURES}) GROUP BY ALL),
    sized AS (SELECT *, sum(n) OVER (PARTITION BY feature, class) AS c FROM counts),
    kept AS MATERIALIZED (SELECT *, least(3, c - 1) AS k FROM sized WHERE c > 1),
    reached AS (
      SELECT a.feature, a.class, a.x, a.n, a.c, a.k, abs(b.x - a.x) AS d,
        sum(b.n - CASE WHEN b.x = a.x THEN 1 ELSE 0 END) OVER (PARTITION BY a.feature, a.class, a.x ORDER BY abs(b.x - a.x), b.x
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen
      FROM kept a JOIN kept b ON a.feature = b.feature AND a.class = b.class),
    radius AS (SELECT feature, class, x, n, c, k, min(d) AS d FROM reached WHERE seen >= k GROUP BY ALL),
    nearer AS (
      SELECT r.feature, r.class, r.x, r.n, r.c, r.k, sum(o.n) AS m FROM radius r JOIN kept o ON o.feature = r.feature
        AND CASE WHEN r.d > 0 THEN o.x < r.x + r.d AND o.x > r.x - r.d ELSE o.x = r.x END GROUP BY ALL)
    SELECT feature, round(greatest(0, {_digamma_sql("sum(n)")} + sum(n * ({_digamma_sql("k")} - {_digamma_sql("c")} - {_digamma_sql("m")})) / sum(n)), 6) AS mi_score
    FROM nearer GROUP BY feature
    """,
)
def mutual_information_nearest(v):
    joined = v.patients.join(v.truth, "patient_id")
    return rounded(explore.mutual_information_nearest(joined, _FEATURES, "risk_level"), ["mi_score"])


@query(
    "most_informative_features",
    f"SELECT * FROM ({_INFORMATION}) scores ORDER BY mi_score DESC, feature LIMIT 2",
)
def most_informative_features(v):
    joined = v.patients.join(v.truth, "patient_id")
    scores = explore.mutual_information(joined, _FEATURES, "risk_level")
    return rounded(explore.top_features(scores, 2, score="mi_score"), ["mi_score"])


@query(
    "standardized_columns",
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
      round((l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem), 6) AS l_quantity_z,
      round((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem), 6)
        AS l_extendedprice_z
    FROM lineitem
    """,
)
def standardized_columns(v):
    scaled = explore.standardize_columns(v.lineitem, ["l_quantity", "l_extendedprice"])
    shown = scaled.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity_z", "l_extendedprice_z")
    return rounded(shown, ["l_quantity_z", "l_extendedprice_z"])


@query(
    "word_count_histogram",
    _histogram_sql(
        "(SELECT len(list_filter(string_split_regex(note_text, '\\s+'), lambda w: w <> '')) AS word_count FROM notes) counted",
        "word_count",
        30,
    ),
)
def word_count_histogram(v):
    from riskframe.functions.textual import word_count

    counted = v.notes.select(word_count("note_text").alias("word_count"))
    return rounded(explore.histogram(counted, "word_count", 30), ["bin_low", "bin_high"])


@query(
    "entity_means_by_class",
    """
    SELECT lang, round(avg(n_chars), 6) AS n_chars, round(avg(quality), 6) AS quality, round(avg(toxic), 6) AS toxic
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang
    """,
)
def entity_means_by_class(v):
    joined = v.documents.join(v.labels, "doc_id")
    return rounded(explore.mean_by(joined, ["n_chars", "quality", "toxic"], "lang"), ["n_chars", "quality", "toxic"])
