"""Classification metrics of all models in one pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import evaluate
from riskframe.plans.catalog.registry import query, rounded
from riskframe.plans.views import N_CLASSES

_COUNTS = """
WITH conf AS (SELECT model, y_true, y_pred, count(*) AS n FROM predictions GROUP BY model, y_true, y_pred),
sides AS (
  SELECT model, y_true AS class, n AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN n ELSE 0 END AS tp FROM conf
  UNION ALL SELECT model, y_pred, 0, n, 0 FROM conf),
raw AS (
  SELECT model, class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(predicted) AS BIGINT) AS predicted,
    CAST(sum(tp) AS BIGINT) AS tp FROM sides GROUP BY model, class),
counts AS (
  SELECT *, predicted - tp AS fp, support - tp AS fn,
    CAST(sum(support) OVER (PARTITION BY model) AS BIGINT) - support - predicted + tp AS tn FROM raw)
"""


@query(
    "metric_confusion",
    """
    WITH conf AS (SELECT model, y_true, y_pred, count(*) AS n FROM predictions GROUP BY model, y_true, y_pred)
    SELECT *, round(n / sum(n) OVER (PARTITION BY model, y_true), 9) AS share FROM conf
    """,
)
def metric_confusion(v):
    return rounded(evaluate.confusion_shares(v.predictions), ["share"], 9)


@query("metric_class_counts", f"{_COUNTS} SELECT * FROM counts")
def metric_class_counts(v):
    return evaluate.class_counts(v.predictions)


@query(
    "metric_clinical",
    f"""{_COUNTS}
    SELECT model, class, round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS sensitivity,
      round(coalesce(tn / nullif(tn + fp, 0), 0), 9) AS specificity, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS ppv,
      round(coalesce(tn / nullif(tn + fn, 0), 0), 9) AS npv,
      round(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0) - 1, 9) AS youden_index,
      round(coalesce(tp * tn / nullif(fp * fn, 0), 'infinity'::DOUBLE), 6) AS diagnostic_odds_ratio
    FROM counts WHERE support > 0
    """,
)
def metric_clinical(v):
    table = evaluate.clinical_metrics(v.predictions)
    table = rounded(table, ["sensitivity", "specificity", "ppv", "npv", "youden_index"], 9)
    return rounded(table, ["diagnostic_odds_ratio"], 6)


@query(
    "metric_classification_report",
    f"""{_COUNTS}
    SELECT model, class, round(coalesce(tp / nullif(predicted, 0), 0), 9) AS precision,
      round(coalesce(tp / nullif(support, 0), 0), 9) AS recall,
      round(coalesce(2 * tp / nullif(support + predicted, 0), 0), 9) AS f1, support
    FROM counts
    """,
)
def metric_classification_report(v):
    return rounded(evaluate.classification_report(v.predictions), ["precision", "recall", "f1"], 9)


_OVERALL = f"""{_COUNTS},
rated AS (
  SELECT *, coalesce(tp / nullif(predicted, 0), 0) AS p, coalesce(tp / nullif(support, 0), 0) AS r,
    coalesce(2 * tp / nullif(support + predicted, 0), 0) AS f, support::DOUBLE AS s, predicted::DOUBLE AS q FROM counts),
sums AS (
  SELECT model, sum(tp)::DOUBLE AS c, sum(s) AS n, sum(s * q) AS sq, sum(s * s) AS ss, sum(q * q) AS qq,
    avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f) AS f1_macro, sum(p * s) / sum(s) AS precision_weighted,
    sum(r * s) / sum(s) AS recall_weighted, sum(f * s) / sum(s) AS f1_weighted
  FROM rated GROUP BY model),
overall AS (
  SELECT model, c / n AS accuracy, precision_macro, recall_macro, f1_macro, precision_weighted, recall_weighted, f1_weighted,
    coalesce((c * n - sq) / nullif(sqrt((n * n - qq) * (n * n - ss)), 0), 0) AS mcc, (c * n - sq) / nullif(n * n - sq, 0) AS cohen_kappa
  FROM sums)
"""
_OVERALL_NAMES = [
    "accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted",
    "mcc", "cohen_kappa",
]


@query(
    "metric_overall",
    f"{_OVERALL} SELECT model, {', '.join(f'round({c}, 8) AS {c}' for c in _OVERALL_NAMES)} FROM overall",
)
def metric_overall(v):
    return rounded(evaluate.overall_metrics(v.predictions), _OVERALL_NAMES, 8)


_LONG = " UNION ALL ".join(
    f"SELECT model, {j} AS class, p{j} AS score, CASE WHEN y_true = {j} THEN 1 ELSE 0 END AS pos FROM predictions"
    for j in range(N_CLASSES)
)
_AREAS = f"""
WITH long AS ({_LONG}),
counted AS (SELECT model, class, score, sum(pos) AS pos, count(*) - sum(pos) AS neg FROM long GROUP BY model, class, score),
cumulated AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, class ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM counted),
areas AS (
  SELECT model, class, CAST(sum(pos) AS BIGINT) AS support,
    sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM cumulated GROUP BY model, class)
"""


@query("metric_auc_by_class", f"{_AREAS} SELECT model, class, support, round(auc, 8) AS auc FROM areas")
def metric_auc_by_class(v):
    return rounded(evaluate.auc_by_class(v.scored), ["auc"], 8)


@query("metric_auc_binned", f"{_AREAS} SELECT model, class, support, round(auc, 8) AS auc FROM areas")
def metric_auc_binned(v):
    return rounded(evaluate.binned_auc_by_class(v.scored), ["auc"], 8)


@query(
    "metric_auc_averages",
    f"""{_AREAS} SELECT model, round(avg(auc), 8) AS auc_roc_macro, round(sum(auc * support) / sum(support), 8) AS auc_roc_weighted
    FROM areas GROUP BY model""",
)
def metric_auc_averages(v):
    return rounded(evaluate.auc_averages(v.scored), ["auc_roc_macro", "auc_roc_weighted"], 8)


_TRUE_P = "CASE y_true " + " ".join(f"WHEN {j} THEN p{j}" for j in range(N_CLASSES)) + " END"
_LOSS = f"avg(-ln(greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, {_TRUE_P}))))"


@query("metric_log_loss", f"SELECT model, round({_LOSS}, 8) AS log_loss FROM predictions GROUP BY model")
def metric_log_loss(v):
    return rounded(evaluate.log_loss(v.scored), ["log_loss"], 8)


def _roc_sql(keys: str) -> str:
    return f"""
    counted AS (SELECT {keys}, score, sum(pos) AS pos, count(*) - sum(pos) AS neg FROM long GROUP BY {keys}, score),
    above AS (
      SELECT {keys}, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY {keys}) AS np,
        sum(neg) OVER (PARTITION BY {keys}) AS nn
      FROM counted WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC)),
    points AS (
      SELECT {keys}, score AS threshold, fp / nn AS fpr, tp / np AS tpr FROM above
      UNION ALL SELECT DISTINCT {keys}, NULL, 0, 0 FROM above)
    """


@query("curve_roc", f"WITH long AS ({_LONG}), {_roc_sql('model, class')} SELECT model, class, threshold, fpr, tpr FROM points")
def curve_roc(v):
    return evaluate.roc_points(v.scored)


@query("curve_roc_micro", f"WITH long AS ({_LONG}), {_roc_sql('model')} SELECT model, threshold, fpr, tpr FROM points")
def curve_roc_micro(v):
    return evaluate.micro_roc_points(v.scored)


# The macro curve is checked on one model's rounded scores, which keeps the SQL join on the grid short.
_MACRO = f"""
WITH long AS ({_LONG}), {_roc_sql('model, class')},
grid AS (SELECT DISTINCT model, fpr AS x FROM points),
everywhere AS (SELECT g.model, class, x FROM grid g JOIN (SELECT DISTINCT model, class FROM points) c ON g.model = c.model),
marks AS (
  SELECT model, class, fpr AS x, min(tpr) AS lo, max(tpr) AS hi FROM points GROUP BY model, class, fpr),
merged AS (
  SELECT e.model, e.class, e.x, m.lo, m.hi, CASE WHEN m.x IS NOT NULL THEN e.x END AS mx
  FROM everywhere e LEFT JOIN marks m ON e.model = m.model AND e.class = m.class AND e.x = m.x),
filled AS (
  SELECT model, class, x, hi, last_value(mx IGNORE NULLS) OVER back AS x0, last_value(hi IGNORE NULLS) OVER back AS y0,
    first_value(mx IGNORE NULLS) OVER ahead AS x1, first_value(lo IGNORE NULLS) OVER ahead AS y1
  FROM merged WINDOW back AS (PARTITION BY model, class ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    ahead AS (PARTITION BY model, class ORDER BY x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
macro AS (
  SELECT model, x AS fpr, avg(CASE WHEN hi IS NOT NULL THEN hi ELSE y0 + (y1 - y0) * (x - x0) / (x1 - x0) END) AS tpr
  FROM filled GROUP BY model, x)
"""


@query("curve_roc_macro", f"{_MACRO} SELECT model, fpr, round(tpr, 8) AS tpr FROM macro")
def curve_roc_macro(v):
    return rounded(evaluate.macro_roc_points(v.scored), ["tpr"], 8)


def _area_sql(source: str, keys: str) -> str:
    return f"""
      SELECT {keys}, sum((x - x0) * (lo + hi0) / 2) AS auc FROM (
        SELECT {keys}, fpr AS x, lo, lag(fpr) OVER w AS x0, lag(hi) OVER w AS hi0 FROM (
          SELECT {keys}, fpr, min(tpr) AS lo, max(tpr) AS hi FROM {source} GROUP BY {keys}, fpr) c
        WINDOW w AS (PARTITION BY {keys} ORDER BY fpr)) d
      GROUP BY {keys}"""


_MICRO = _roc_sql("model").replace("counted", "counted1").replace("above", "above1").replace("points", "points1")


@query(
    "curve_areas",
    f"""{_MACRO}, {_MICRO}
    SELECT model, concat('class ', class) AS curve, round(auc, 7) AS auc FROM ({_area_sql('points', 'model, class')}) a
    UNION ALL SELECT model, 'micro', round(auc, 7) FROM ({_area_sql('points1', 'model')}) b
    UNION ALL SELECT model, 'macro', round(auc, 7) FROM ({_area_sql('macro', 'model')}) c
    """,
)
def curve_areas(v):
    return rounded(evaluate.roc_areas(v.scored), ["auc"], 7)


_PRECISION = f"""
WITH long AS ({_LONG}), {_roc_sql('model, class')},
rated AS (
  SELECT a.model, a.class, a.score AS threshold, tp / (tp + fp) AS precision, tp / np AS recall, c.pos / np AS gain
  FROM above a JOIN counted c ON a.model = c.model AND a.class = c.class AND a.score = c.score)
"""


@query("curve_precision_recall", f"{_PRECISION} SELECT model, class, threshold, precision, recall FROM rated")
def curve_precision_recall(v):
    return evaluate.pr_points(v.scored).select("model", "class", "threshold", "precision", "recall")


@query(
    "metric_average_precision",
    f"{_PRECISION} SELECT model, class, round(sum(gain * precision), 8) AS average_precision FROM rated GROUP BY model, class",
)
def metric_average_precision(v):
    return rounded(evaluate.average_precision(v.scored), ["average_precision"], 8)


@query(
    "curve_calibration",
    """
    WITH top AS (
      SELECT model, greatest(p0, p1, p2, p3, p4) AS p, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS hit FROM predictions)
    SELECT model, CAST(least(greatest(ceil(p * 10) - 1, 0), 9) AS INT) AS bin, count(*) AS n, round(avg(hit), 8) AS observed,
      round(avg(p), 8) AS predicted
    FROM top GROUP BY ALL
    """,
)
def curve_calibration(v):
    return rounded(evaluate.calibration(v.scored), ["observed", "predicted"], 8)


@query(
    "compare_models",
    f"""{_OVERALL}, {_AREAS.strip().removeprefix('WITH')}
    SELECT o.model, round(accuracy, 8) AS accuracy, round(precision_macro, 8) AS precision_macro,
      round(recall_macro, 8) AS recall_macro, round(f1_macro, 8) AS f1_macro, round(m, 8) AS auc_roc_macro
    FROM overall o JOIN (SELECT model, avg(auc) AS m FROM areas GROUP BY model) a ON o.model = a.model
    """,
)
def compare_models(v):
    table = evaluate.compare_models(v.scored)
    return rounded(table, [c for c in table.columns if c != "model"], 8)


ALL_METRICS = f"""{_OVERALL}, {_AREAS.strip().removeprefix('WITH')},
    wide AS (
      SELECT o.*, auc_roc_macro, auc_roc_weighted, log_loss FROM overall o
      JOIN (SELECT model, avg(auc) AS auc_roc_macro, sum(auc * support) / sum(support) AS auc_roc_weighted FROM areas GROUP BY model) a
        ON o.model = a.model
      JOIN (SELECT model, {_LOSS} AS log_loss FROM predictions GROUP BY model) l ON o.model = l.model)
    {" UNION ALL ".join(f"SELECT model, '{c}' AS metric, CAST(NULL AS INT) AS class, round({c}, 7) AS value FROM wide"
                        for c in [*_OVERALL_NAMES, "auc_roc_macro", "auc_roc_weighted", "log_loss"])}
    UNION ALL SELECT model, 'sensitivity', class, round(coalesce(tp / nullif(tp + fn, 0), 0), 7) FROM counts WHERE support > 0
    UNION ALL SELECT model, 'specificity', class, round(coalesce(tn / nullif(tn + fp, 0), 0), 7) FROM counts WHERE support > 0
    UNION ALL SELECT model, 'ppv', class, round(coalesce(tp / nullif(tp + fp, 0), 0), 7) FROM counts WHERE support > 0
    UNION ALL SELECT model, 'npv', class, round(coalesce(tn / nullif(tn + fn, 0), 0), 7) FROM counts WHERE support > 0
    UNION ALL SELECT model, 'youden_index', class,
      round(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0) - 1, 7) FROM counts WHERE support > 0
    UNION ALL SELECT model, 'diagnostic_odds_ratio', class,
      round(coalesce(tp * tn / nullif(fp * fn, 0), 'infinity'::DOUBLE), 7) FROM counts WHERE support > 0
    """


@query("all_metrics", ALL_METRICS)
def all_metrics(v):
    return rounded(evaluate.all_metrics(v.scored), ["value"], 7)


@query(
    "metric_binary_calibration",
    """
    WITH scored AS (SELECT model, p1 AS p, CASE WHEN y_true = 1 THEN 1 ELSE 0 END AS hit FROM predictions)
    SELECT model, CAST(least(greatest(ceil(p * 5) - 1, 0), 4) AS INT) AS bin, count(*) AS n, round(avg(hit), 8) AS observed,
      round(avg(p), 8) AS predicted
    FROM scored GROUP BY ALL
    """,
)
def metric_binary_calibration(v):
    scored = v.predictions.select("model", "p1", (F.col("y_true") == 1).cast("int").alias("hit"))
    return rounded(evaluate.binary_calibration(scored, ["model"], "p1", "hit", 5), ["observed", "predicted"], 8)
