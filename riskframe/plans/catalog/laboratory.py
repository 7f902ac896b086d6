"""Measurements: fences, flags, ranges, deviations, panels and trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.presets import LAB_CRITICAL, LAB_PANELS, LAB_RANGES, RANGE_DIMENSION
from riskframe.operators import integrate, labs
from riskframe.plans.catalog.registry import query, rounded
from riskframe.plans.views import LAB_TESTS

_FENCED = """
WITH quartiles AS (
  SELECT test_name, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
  FROM labs WHERE value IS NOT NULL GROUP BY test_name)
"""


@query(
    "lab_iqr_fences",
    f"""{_FENCED}
    SELECT test_name, q1, q3, q1 - (q3 - q1) * 3.0::DOUBLE AS fence_low, q3 + (q3 - q1) * 3.0::DOUBLE AS fence_high
    FROM quartiles
    """,
)
def lab_iqr_fences(v):
    return labs.iqr_fences(v.labs)


@query(
    "lab_outliers_dropped",
    f"""{_FENCED}
    SELECT patient_id, l.test_name, test_date, order_no, line_no, value FROM labs l JOIN quartiles q ON l.test_name = q.test_name
    WHERE value >= q1 - (q3 - q1) * 3.0::DOUBLE AND value <= q3 + (q3 - q1) * 3.0::DOUBLE
    """,
)
def lab_outliers_dropped(v):
    kept = labs.drop_outliers(v.labs)
    return kept.select("patient_id", "test_name", "test_date", "order_no", "line_no", "value")


@query(
    "lab_abnormal_flags",
    """
    SELECT patient_id, order_no, line_no, test_name, value,
      CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END AS is_abnormal
    FROM labs
    """,
)
def lab_abnormal_flags(v):
    return v.labs.select("patient_id", "order_no", "line_no", "test_name", "value", labs.abnormal_flag().alias("is_abnormal"))


_LATEST = """
WITH flagged AS (
  SELECT *, CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END AS is_abnormal FROM labs),
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY patient_id, test_name ORDER BY test_date DESC, order_no DESC, line_no DESC) AS rn
    FROM flagged) ranked
  WHERE rn = 1)
"""
_PIVOT = ", ".join(
    f"max(CASE WHEN test_name = '{t}' THEN value END) AS {t}, "
    f"max(CASE WHEN test_name = '{t}' THEN is_abnormal END) AS {t}_abnormal"
    for t in LAB_TESTS
)


def latest_wide(v):
    flagged = v.labs.withColumn("is_abnormal", labs.abnormal_flag())
    return integrate.pivot_latest(flagged, LAB_TESTS, tie_break=("order_no", "line_no"))


@query("lab_pivot_latest", f"{_LATEST} SELECT patient_id, {_PIVOT} FROM newest GROUP BY patient_id")
def lab_pivot_latest(v):
    return latest_wide(v)


@query(
    "lab_cleaned_pivot",
    f"""{_FENCED},
    kept AS (
      SELECT l.*, CASE WHEN value < reference_low OR value > reference_high THEN 1 ELSE 0 END AS is_abnormal
      FROM labs l JOIN quartiles q ON l.test_name = q.test_name
      WHERE value >= q1 - (q3 - q1) * 3.0::DOUBLE AND value <= q3 + (q3 - q1) * 3.0::DOUBLE),
    newest AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY patient_id, test_name ORDER BY test_date DESC, order_no DESC, line_no DESC) AS rn
        FROM kept) ranked WHERE rn = 1)
    SELECT patient_id, {_PIVOT} FROM newest GROUP BY patient_id
    """,
)
def lab_cleaned_pivot(v):
    kept = labs.drop_outliers(v.labs).withColumn("is_abnormal", labs.abnormal_flag())
    return integrate.pivot_latest(kept, LAB_TESTS, tie_break=("order_no", "line_no"))


@query(
    "lab_pivot_mean",
    "SELECT patient_id, "
    + ", ".join(f"round(avg(CASE WHEN test_name = '{t}' THEN value END), 6) AS {t}" for t in LAB_TESTS)
    + " FROM labs GROUP BY patient_id",
)
def lab_pivot_mean(v):
    return rounded(integrate.pivot_mean(v.labs, LAB_TESTS), LAB_TESTS)


_DIMENSION = ", ".join(
    f"('{t}', {'NULL' if s is None else repr(s)}, " + ", ".join(f"{x}::DOUBLE" for x in limits) + f", '{unit}')"
    for t, s, *limits, unit in RANGE_DIMENSION
)


@query(
    "lab_range_lookup",
    f"""
    WITH dim (test_name, sex, low, high, critical_low, critical_high, unit) AS (VALUES {_DIMENSION}),
    measured AS (
      SELECT l.patient_id, l.order_no, l.line_no, l.test_name, l.value, p.sex
      FROM labs l LEFT JOIN patients p ON l.patient_id = p.patient_id)
    SELECT m.patient_id, m.order_no, m.line_no, m.test_name, m.sex, m.value, d.low, d.high, d.critical_low, d.critical_high,
      d.unit, (m.value - (d.low + d.high) / 2) / ((d.high - d.low) / 2) AS deviation
    FROM measured m LEFT JOIN dim d ON m.test_name = d.test_name AND (d.sex IS NULL OR d.sex = m.sex)
    """,
)
def lab_range_lookup(v):
    measured = v.labs.select("patient_id", "order_no", "line_no", "test_name", "value")
    with_sex = measured.join(v.patients.select("patient_id", "sex"), "patient_id", "left")
    return labs.long_deviations(labs.with_ranges(with_sex, labs.range_dimension(v.spark)))


_WIDE = f"{_LATEST}, wide AS (SELECT patient_id, {_PIVOT} FROM newest GROUP BY patient_id)"


def _deviation_sql(test: str) -> str:
    low, high = LAB_RANGES[test]
    return f"({test} - {(low + high) / 2}::DOUBLE) / {(high - low) / 2}::DOUBLE"


_DEVIATIONS = ", ".join(f"{_deviation_sql(t)} AS {t}_deviation" for t in LAB_TESTS)


@query("lab_deviations", f"{_WIDE} SELECT patient_id, {_DEVIATIONS} FROM wide")
def lab_deviations(v):
    return labs.with_deviations(latest_wide(v)).select("patient_id", *[f"{t}_deviation" for t in LAB_TESTS])


_ABNORMAL = " + ".join(
    f"CASE WHEN {t} < {LAB_RANGES[t][0]}::DOUBLE OR {t} > {LAB_RANGES[t][1]}::DOUBLE THEN 1 ELSE 0 END" for t in LAB_TESTS
)


@query("lab_abnormality_count", f"{_WIDE} SELECT patient_id, {_ABNORMAL} AS abnormality_count FROM wide")
def lab_abnormality_count(v):
    return labs.with_abnormality_count(latest_wide(v)).select("patient_id", "abnormality_count")


_CRITICAL_TESTS = [t for t in LAB_CRITICAL if t in LAB_TESTS]
_CRITICAL = {
    t: f"CASE WHEN {t} < {LAB_CRITICAL[t][0]}::DOUBLE OR {t} > {LAB_CRITICAL[t][1]}::DOUBLE THEN 1 ELSE 0 END"
    for t in _CRITICAL_TESTS
}


@query(
    "lab_critical_flags",
    f"{_WIDE} SELECT patient_id, "
    + ", ".join(f"{sql} AS {t}_critical" for t, sql in _CRITICAL.items())
    + f", {' + '.join(_CRITICAL.values())} AS total_critical_flags FROM wide",
)
def lab_critical_flags(v):
    marked = labs.with_critical_flags(latest_wide(v))
    return marked.select("patient_id", *[f"{t}_critical" for t in _CRITICAL_TESTS], "total_critical_flags")


_PANELS = ", ".join(
    "round((" + " + ".join(f"abs(coalesce({_deviation_sql(t)}, 0))" for t in tests) + f") / {len(tests)}, 6) AS {panel}"
    for panel, tests in LAB_PANELS.items()
)


@query("lab_panel_scores", f"{_WIDE} SELECT patient_id, {_PANELS} FROM wide")
def lab_panel_scores(v):
    scored = labs.with_panel_scores(labs.with_deviations(latest_wide(v)))
    return rounded(scored.select("patient_id", *LAB_PANELS), list(LAB_PANELS))


def _rule_points(test: str) -> str:
    low, high = LAB_RANGES[test]
    margin = 0.5 * (high - low)
    return (
        f"CASE WHEN {test} < {low - margin}::DOUBLE OR {test} > {high + margin}::DOUBLE THEN 1.0::DOUBLE "
        f"WHEN {test} < {low}::DOUBLE OR {test} > {high}::DOUBLE THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END"
    )


_RISK = f"greatest(0, least(1, ({' + '.join(_rule_points(t) for t in LAB_TESTS)}) / {len(LAB_RANGES)}))"


@query(
    "lab_rule_risk",
    f"""{_WIDE}
    SELECT patient_id, round({_RISK}, 6) AS rule_risk,
      round(greatest(0, least(1, 0.6 * ((patient_id % 101) / 100) + 0.4 * {_RISK})), 6) AS combined_risk
    FROM wide
    """,
)
def lab_rule_risk(v):
    scored = labs.with_rule_risk(latest_wide(v), LAB_RANGES)
    ml = (F.col("patient_id") % 101) / 100
    result = scored.select("patient_id", "rule_risk", labs.combined_risk(ml, "rule_risk").alias("combined_risk"))
    return rounded(result, ["rule_risk", "combined_risk"])


@query(
    "lab_trend_slopes",
    """
    WITH numbered AS (
      SELECT patient_id, value, row_number() OVER (PARTITION BY patient_id, test_name ORDER BY test_date, order_no, line_no) AS r,
        test_name FROM labs),
    fitted AS (
      SELECT patient_id, test_name, count(value) AS n, regr_slope(value, r) AS slope FROM numbered GROUP BY patient_id, test_name)
    SELECT patient_id, test_name, CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE round(slope, 5) END AS value_trend FROM fitted
    """,
)
def lab_trend_slopes(v):
    slopes = labs.trend_slopes(
        v.labs,
        ["patient_id", "test_name"],
        ["test_date", "order_no", "line_no"],
        ["value"],
        integrate.date_bucket("test_date"),
    )
    return rounded(slopes, ["value_trend"], 5)


@query(
    "event_trends_on_rows",
    """
    WITH numbered AS (
      SELECT event_id, user_id, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events),
    fitted AS (
      SELECT user_id, count(value) AS n, regr_slope(value, r) AS slope FROM numbered GROUP BY user_id)
    SELECT event_id, numbered.user_id, value, CASE WHEN n < 2 THEN 0.0::DOUBLE ELSE round(slope, 6) END AS value_trend
    FROM numbered JOIN fitted ON numbered.user_id = fitted.user_id
    """,
)
def event_trends_on_rows(v):
    fitted = labs.with_trends(v.events, ["user_id"], ["ts", "event_id"], ["value"], integrate.date_bucket("ts"))
    return rounded(fitted.select("event_id", "user_id", "value", "value_trend"), ["value_trend"])
