"""Classification metrics as aggregations.

Input: a table of predictions with integer classes ``y_true`` and ``y_pred``, an optional array column
``prob`` (one probability per class) and grouping columns ``by`` (for example the model), so that all
models are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.integrate import stack
from riskframe.operators.prefix import running_totals, value_bucket
from riskframe.operators.sizing import lookup_join
from riskframe.session import materialize

By = Sequence[str]
CURVE_BUCKETS = 4096
#: Distinct scores that a bin may hold, and the parts into which a fuller one is cut.
BIN_ROWS, BIN_PARTS = 100_000, 1024


def _ratio(top: Column, bottom: Column, otherwise: float | None = 0.0) -> Column:
    return F.when(bottom != 0, top / bottom).otherwise(F.lit(otherwise))


def confusion(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """``(by, y_true, y_pred, n)`` for the pairs that occur."""
    return df.groupBy(*by, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("n"))


def confusion_shares(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """Confusion counts with the share of each row of the matrix."""
    row = Window.partitionBy(*by, "y_true")
    return confusion(df, by).withColumn("share", F.col("n") / F.sum("n").over(row))


def _sides() -> Column:
    """The truth side and the prediction side of a row of the confusion table."""
    same = F.col("y_true") == F.col("y_pred")
    return F.array(
        F.struct(F.col("y_true").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(same, F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("y_pred").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )


def class_counts(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """TP, FP, FN, TN, support and predicted count per class that occurs as truth or prediction."""
    per_class = (
        confusion(df, by)
        .select(*by, F.inline(_sides()))
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    )
    total = F.sum("support").over(Window.partitionBy(*by))
    return per_class.select(
        *by,
        "class",
        "support",
        "predicted",
        "tp",
        (F.col("predicted") - F.col("tp")).alias("fp"),
        (F.col("support") - F.col("tp")).alias("fn"),
        (total - F.col("support") - F.col("predicted") + F.col("tp")).alias("tn"),
    )


def clinical_metrics(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """Sensitivity, specificity, PPV, NPV, Youden index and diagnostic odds ratio per true class."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return (
        class_counts(df, by)
        .filter(F.col("support") > 0)
        .select(
            *by,
            "class",
            _ratio(tp, tp + fn).alias("sensitivity"),
            _ratio(tn, tn + fp).alias("specificity"),
            _ratio(tp, tp + fp).alias("ppv"),
            _ratio(tn, tn + fn).alias("npv"),
            (_ratio(tp, tp + fn) + _ratio(tn, tn + fp) - 1.0).alias("youden_index"),
            _ratio(tp * tn, fp * fn, float("inf")).alias("diagnostic_odds_ratio"),
        )
    )


def classification_report(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    tp, support, predicted = (F.col(c).cast("double") for c in ("tp", "support", "predicted"))
    return class_counts(df, by).select(
        *by,
        "class",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(tp * 2, support + predicted).alias("f1"),
        "support",
    )


def overall_metrics(df: DataFrame, by: By = ("model",)) -> DataFrame:
    """Accuracy, macro and weighted precision/recall/F1, Matthews correlation and Cohen's kappa."""
    tp, support, predicted = (F.col(c).cast("double") for c in ("tp", "support", "predicted"))
    scored = class_counts(df, by).withColumns(
        {"_p": _ratio(tp, predicted), "_r": _ratio(tp, support), "_f": _ratio(tp * 2, support + predicted)}
    )
    s, p = F.col("support").cast("double"), F.col("predicted").cast("double")
    sums = scored.groupBy(*by).agg(
        F.sum("tp").cast("double").alias("_c"),
        F.sum(s).alias("_n"),
        F.sum(s * p).alias("_sp"),
        F.sum(s * s).alias("_ss"),
        F.sum(p * p).alias("_pp"),
        *[F.avg(f"_{m}").alias(f"{name}_macro") for m, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))],
        *[
            (F.sum(F.col(f"_{m}") * s) / F.sum(s)).alias(f"{name}_weighted")
            for m, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))
        ],
    )
    c, n, sp, ss, pp = (F.col(x) for x in ("_c", "_n", "_sp", "_ss", "_pp"))
    scale = F.sqrt((n * n - pp) * (n * n - ss))
    return sums.select(
        *by,
        (c / n).alias("accuracy"),
        "precision_macro",
        "recall_macro",
        "f1_macro",
        "precision_weighted",
        "recall_weighted",
        "f1_weighted",
        _ratio(c * n - sp, scale).alias("mcc"),
        _ratio(c * n - sp, n * n - sp, None).alias("cohen_kappa"),
    )


def class_scores(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Positive and negative counts per class and distinct score, counted before the shuffle."""
    # The outer form keeps the optimizer from adding a size test that evaluates a derived array twice.
    long = df.select(*by, "y_true", F.posexplode_outer(prob).alias("class", "score")).filter(F.col("class").isNotNull())
    positive = (F.col("y_true") == F.col("class")).cast("long")
    return long.groupBy(*by, "class", "score").agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))


def pooled_scores(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """The same counts with all classes pooled (micro average)."""
    return class_scores(df, by, prob).groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _cumulated(scores: DataFrame, keys: By) -> DataFrame:
    """Add, per distinct score, the counts below it and the totals of its group."""
    return running_totals(
        scores, keys, ["score"], {"pos": F.col("pos"), "neg": F.col("neg")}, value_bucket("score")
    )


def auc_by_class(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """One-versus-rest area under the ROC curve (ties count half); NULL when a side is empty."""
    keys = [*by, "class"]
    wins = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)
    sums = _cumulated(materialize(class_scores(df, by, prob)), keys).groupBy(*keys).agg(
        F.sum(wins).alias("w"), F.sum("pos").alias("support"), F.sum("neg").alias("n_neg")
    )
    pairs = F.col("support").cast("double") * F.col("n_neg")
    return sums.select(*keys, "support", _ratio(F.col("w"), pairs, None).alias("auc"))


def score_bins(scores: DataFrame, keys: By, limit: int = BIN_ROWS) -> DataFrame:
    """Saved score counts with ``_bin``, whose order is that of the scores; a bin has at most ``limit`` distinct scores.

    The first bins are parts of an octave. A bin with more distinct scores is cut between its least and greatest score, again
    and again, so scores that crowd together do not meet in one task.
    """
    binned = materialize(scores.withColumn("_bin", F.array(value_bucket("score"))))
    while True:
        sizes = binned.groupBy(*keys, "_bin").agg(
            F.count(F.lit(1)).alias("_rows"), F.min("score").alias("_lo"), F.max("score").alias("_hi")
        )
        full = materialize(sizes.filter((F.col("_rows") > limit) & (F.col("_lo") < F.col("_hi"))).drop("_rows"))
        if full.isEmpty():
            return binned
        part = F.floor((F.col("score") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * BIN_PARTS).cast("long")
        cut = F.when(F.col("_lo").isNotNull(), F.concat("_bin", F.array(part))).otherwise(F.col("_bin"))
        binned = materialize(
            lookup_join(binned, full, [*keys, "_bin"], "left").withColumn("_bin", cut).select(*scores.columns, "_bin")
        )


def _bin_histogram(binned: DataFrame, keys: By) -> DataFrame:
    """Positives and negatives per bin, with the negatives of all lower bins; as few rows as there are bins."""
    bins = binned.groupBy(*keys, "_bin").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("score").alias("lo"), F.max("score").alias("hi")
    )
    lower = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    return bins.withColumn("neg_below", F.coalesce(F.sum("neg").over(lower), F.lit(0)))


def binned_auc_by_class(
    df: DataFrame, by: By = ("model",), prob: str = "prob", limit: int = BIN_ROWS
) -> DataFrame:
    """The exact area of ``auc_by_class`` from mergeable score histograms, for many distinct scores.

    The predictions are read once. Pairs of different bins are counted from the histogram; only bins that hold positives and
    negatives at different scores are refined, each in a task of its own.
    """
    keys = [*by, "class"]
    binned = score_bins(class_scores(df, by, prob), keys, limit)
    bins = materialize(_bin_histogram(binned, keys))
    mixed = (F.col("pos") > 0) & (F.col("neg") > 0) & (F.col("lo") < F.col("hi"))
    tied = F.when(mixed, F.lit(0.0)).otherwise(F.col("neg") / 2.0)
    outside = bins.select(
        *keys, "pos", "neg", (F.col("pos").cast("double") * (F.col("neg_below") + tied)).alias("w")
    )
    lower = Window.partitionBy(*keys, "_bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos").cast("double") * (F.coalesce(F.sum("neg").over(lower), F.lit(0)) + F.col("neg") / 2.0)
    refined = lookup_join(binned, bins.filter(mixed).select(*keys, "_bin"), [*keys, "_bin"]).withColumn("w", wins)
    inside = refined.select(*keys, F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"), "w")
    sums = outside.union(inside).groupBy(*keys).agg(
        F.sum("w").alias("w"), F.sum("pos").alias("support"), F.sum("neg").alias("n_neg")
    )
    pairs = F.col("support").cast("double") * F.col("n_neg")
    return sums.select(*keys, "support", _ratio(F.col("w"), pairs, None).alias("auc"))


def auc_averages(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Macro and support-weighted AUC; NULL when a class has no AUC."""
    complete = F.count("auc") == F.count(F.lit(1))
    return auc_by_class(df, by, prob).groupBy(*by).agg(
        F.when(complete, F.avg("auc")).alias("auc_roc_macro"),
        F.when(complete, F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc_roc_weighted"),
    )


def _loss(prob: str, eps: float = 2.220446049250313e-16) -> Column:
    return -F.log(F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(prob)[F.col("y_true")])))


def log_loss(df: DataFrame, by: By = ("model",), prob: str = "prob", eps: float = 2.220446049250313e-16) -> DataFrame:
    """Mean negative logarithm of the probability of the true class, clipped."""
    return df.groupBy(*by).agg(F.avg(_loss(prob, eps)).alias("log_loss"))


def _roc(scores: DataFrame, keys: By) -> DataFrame:
    """One point per distinct threshold; the highest threshold also emits the origin (threshold NULL)."""
    pos, neg = F.col("pos_total"), F.col("neg_total")
    point = F.struct(
        F.col("score").alias("threshold"),
        _ratio((neg - F.col("neg_before")).cast("double"), neg, None).alias("fpr"),
        _ratio((pos - F.col("pos_before")).cast("double"), pos, None).alias("tpr"),
    )
    origin = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    highest = (F.col("pos_before") + F.col("pos") == pos) & (F.col("neg_before") + F.col("neg") == neg)
    points = F.when(highest, F.array(point, origin)).otherwise(F.array(point))
    return _cumulated(scores, keys).select(*keys, F.inline(points))


def roc_points(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """ROC points per class: one per distinct threshold, and the origin (threshold NULL)."""
    return _roc(materialize(class_scores(df, by, prob)), [*by, "class"])


def micro_roc_points(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """ROC points of all classes pooled."""
    return _roc(materialize(pooled_scores(df, by, prob)), list(by))


def _curve_bucket(x: str) -> Column:
    return F.floor(F.col(x) * CURVE_BUCKETS).cast("int")


def _nearest(points: DataFrame, keys: list[str]) -> DataFrame:
    """For every row the last curve point at or before ``x`` and the first one at or after it.

    Rows without ``y`` are grid positions. Both are running maxima/minima, resolved inside a bucket of
    ``x`` and completed by the best point of the earlier (later) buckets.
    """
    point = F.when(F.col("y").isNotNull(), F.struct("x", "y"))
    staged = points.withColumns({"_b": _curve_bucket("x"), "_pt": point})
    ends = staged.groupBy(*keys, "_b").agg(F.max("_pt").alias("hi"), F.min("_pt").alias("lo"))
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    outer = ends.select(
        *keys,
        "_b",
        F.max("hi").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_out"),
        F.min("lo").over(by_bucket.rowsBetween(1, Window.unboundedFollowing)).alias("_next_out"),
    )
    inner = Window.partitionBy(*keys, "_b").orderBy("x")
    local = staged.withColumns(
        {
            "_prev_in": F.max("_pt").over(inner.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
            "_next_in": F.min("_pt").over(inner.rangeBetween(Window.currentRow, Window.unboundedFollowing)),
        }
    )
    joined = local.join(outer, [*keys, "_b"])
    return joined.withColumns(
        {"prev": F.coalesce("_prev_in", "_prev_out"), "next": F.coalesce("_next_in", "_next_out")}
    )


def macro_roc_points(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Mean of the class curves, interpolated on the union of their false-positive rates."""
    return _macro(roc_points(df, by, prob), list(by))


def _macro(points: DataFrame, by: list[str]) -> DataFrame:
    curves = points.select(*by, "class", F.col("fpr").alias("x"), F.col("tpr").alias("y"))
    # Between its ends a vertical step of a curve adds nothing; all positives of a good classifier lie at x = 0.
    ends = F.array_distinct(F.array(F.min("y"), F.max("y")))
    curves = curves.groupBy(*by, "class", "x").agg(ends.alias("y")).withColumn("y", F.explode("y"))
    grid = curves.select(*by, "x").distinct()
    classes = curves.groupBy(*by).agg(F.collect_set("class").alias("classes"))
    everywhere = lookup_join(grid, classes, by).select(
        *by, F.explode("classes").alias("class"), "x", F.lit(None).cast("double").alias("y")
    )
    filled = _nearest(curves.unionByName(everywhere), [*by, "class"]).filter(F.col("y").isNull())
    x0, y0, x1, y1 = F.col("prev.x"), F.col("prev.y"), F.col("next.x"), F.col("next.y")
    value = F.when((x0 == F.col("x")) | (x1 == x0), y0).otherwise(y0 + (y1 - y0) * (F.col("x") - x0) / (x1 - x0))
    return filled.groupBy(*by, "x").agg(F.avg(value).alias("tpr")).withColumnRenamed("x", "fpr")


def trapezoid_area(points: DataFrame, keys: By) -> DataFrame:
    """Area under ``(fpr, tpr)`` points per group, by the trapezoid rule.

    Points with the same ``fpr`` collapse to their lowest and highest ``tpr``; the neighbours are found
    inside buckets of ``fpr``, and the links between buckets are added from one row per bucket.
    """
    keys = list(keys)
    columns = points.groupBy(*keys, "fpr").agg(F.min("tpr").alias("lo"), F.max("tpr").alias("hi"))
    staged = columns.withColumn("_b", _curve_bucket("fpr"))
    inner = Window.partitionBy(*keys, "_b").orderBy("fpr")
    width = F.col("fpr") - F.lag("fpr").over(inner)
    pieces = staged.withColumn("_area", width * (F.col("lo") + F.lag("hi").over(inner)) / 2.0)
    per_bucket = pieces.groupBy(*keys, "_b").agg(
        F.sum("_area").alias("area"),
        F.min(F.struct("fpr", "lo")).alias("first"),
        F.max(F.struct("fpr", "hi")).alias("last"),
    )
    outer = Window.partitionBy(*keys).orderBy("_b")
    before = F.lag("last").over(outer)
    link = (F.col("first.fpr") - before["fpr"]) * (F.col("first.lo") + before["hi"]) / 2.0
    linked = per_bucket.withColumn("_link", link)
    return linked.groupBy(*keys).agg(
        (F.coalesce(F.sum("area"), F.lit(0.0)) + F.coalesce(F.sum("_link"), F.lit(0.0))).alias("auc")
    )


def roc_areas(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Area of every class curve, of the pooled (micro) curve and of the macro curve.

    The scores are counted once and cumulated once. The area under a curve of ranks is the share of won pairs, so the class
    curves and the pooled one need no points. The macro curve takes the upper end of every vertical step; against
    the mean of the class areas this adds, for each step, half its height times the distance to the grid position before it.
    Classes without positives or negatives have no area and are no part of the macro curve.
    """
    by = list(by)
    keys = [*by, "class"]
    counts = materialize(class_scores(df, by, prob))
    cumulated = materialize(_cumulated(counts, keys))
    classes = materialize(_areas(cumulated, keys))
    pooled = counts.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    micro = _areas(_cumulated(pooled, by), by)
    means = classes.filter(F.col("auc").isNotNull()).groupBy(*by).agg(F.avg("auc").alias("_mean"), F.count("auc").alias("_classes"))
    joined = means.join(_macro_excess(cumulated, by), by, "left")
    macro = F.col("_mean") + F.coalesce("_excess", F.lit(0.0)) / F.col("_classes")
    return stack(
        [
            classes.select(*by, F.concat(F.lit("class "), F.col("class")).alias("curve"), "auc"),
            micro.select(*by, F.lit("micro").alias("curve"), "auc"),
            joined.select(*by, F.lit("macro").alias("curve"), macro.alias("auc")),
        ]
    )


def _areas(cumulated: DataFrame, keys: By) -> DataFrame:
    """Share of the pairs of a positive and a negative that the positive wins; ties count half."""
    wins = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0)
    sums = cumulated.groupBy(*keys).agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(*keys, _ratio(F.col("w"), F.col("p").cast("double") * F.col("n"), None).alias("auc"))


def _macro_excess(cumulated: DataFrame, by: list[str]) -> DataFrame:
    """Sum over the class curves' vertical steps of half the height times the width of the grid interval before them."""
    pos, neg = F.col("pos_total"), F.col("neg_total")
    points = cumulated.filter((pos > 0) & (neg > 0)).select(
        *by,
        "class",
        ((neg - F.col("neg_before")).cast("double") / neg).alias("fpr"),
        ((pos - F.col("pos_before")).cast("double") / pos).alias("tpr"),
    )
    steps = points.groupBy(*by, "class", "fpr").agg((F.max("tpr") - F.min("tpr")).alias("step"))
    grid = steps.groupBy(*by, "fpr").agg(F.sum("step").alias("step")).withColumn("_b", _curve_bucket("fpr"))
    inner = Window.partitionBy(*by, "_b").orderBy("fpr")
    local = grid.withColumn("_x", F.col("step") * (F.col("fpr") - F.lag("fpr").over(inner)) / 2.0)
    per_bucket = local.groupBy(*by, "_b").agg(
        F.sum("_x").alias("_x"), F.min(F.struct("fpr", "step")).alias("first"), F.max("fpr").alias("last")
    )
    before = F.coalesce(F.lag("last").over(Window.partitionBy(*by).orderBy("_b")), F.lit(0.0))
    linked = per_bucket.withColumn("_link", F.col("first.step") * (F.col("first.fpr") - before) / 2.0)
    return linked.groupBy(*by).agg((F.coalesce(F.sum("_x"), F.lit(0.0)) + F.sum("_link")).alias("_excess"))


def pr_points(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Precision and recall per class at every distinct threshold."""
    keys = [*by, "class"]
    above = F.col("pos_total") - F.col("pos_before")
    selected = above + F.col("neg_total") - F.col("neg_before")
    return _cumulated(materialize(class_scores(df, by, prob)), keys).select(
        *keys,
        F.col("score").alias("threshold"),
        F.col("pos"),
        (above.cast("double") / selected).alias("precision"),
        _ratio(above.cast("double"), F.col("pos_total"), None).alias("recall"),
        F.col("pos_total"),
    )


def average_precision(df: DataFrame, by: By = ("model",), prob: str = "prob") -> DataFrame:
    """Sum of precision times the recall gained at each threshold."""
    keys = [*by, "class"]
    gain = _ratio(F.col("pos").cast("double"), F.col("pos_total"), None)
    return pr_points(df, by, prob).groupBy(*keys).agg(F.sum(gain * F.col("precision")).alias("average_precision"))


def calibration(df: DataFrame, by: By = ("model",), prob: str = "prob", bins: int = 10) -> DataFrame:
    """Observed rate against mean confidence in equal bins (a value on an edge belongs below); empty bins are absent."""
    from riskframe.operators.fusion import argmax

    top = df.select(
        *by, F.array_max(prob).alias("p"), (argmax(prob) == F.col("y_true")).cast("int").alias("hit")
    )
    return binary_calibration(top, by, "p", "hit", bins)


def binary_calibration(df: DataFrame, by: By, prob: str, hit: str, bins: int = 10) -> DataFrame:
    bin_no = F.least(F.greatest(F.ceil(F.col(prob) * bins) - 1, F.lit(0)), F.lit(bins - 1)).cast("int")
    return df.groupBy(*by, bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(hit).alias("observed"), F.avg(prob).alias("predicted")
    )


def compare_models(df: DataFrame, by: By = ("model",), prob: str | None = "prob") -> DataFrame:
    """One row per model: accuracy, macro precision, recall, F1 and AUC."""
    wanted = [*by, "accuracy", "precision_macro", "recall_macro", "f1_macro"]
    base = overall_metrics(df, by).select(*wanted)
    if prob is None:
        return base.withColumn("auc_roc_macro", F.lit(None).cast("double"))
    return base.join(auc_averages(df, by, prob).select(*by, "auc_roc_macro"), list(by), "left")


def evaluation_frame(df: DataFrame, by: By = ("model",), prob: str | None = "prob", limit: int = BIN_ROWS) -> DataFrame:
    """Everything that the metrics need, counted in one pass over the predictions and saved.

    Each row is exploded to its classes; one aggregation with two grouping sets gives the rows (y_true, y_pred, n, loss, losses) of the
    confusion table and the rows (class, score, pos, neg, _bin) of the score histogram.
    """
    by = list(by)
    if prob is None:
        df, prob = df.withColumn("_none", F.lit(None).cast("array<double>")), "_none"
    first = F.coalesce(F.col("class") == 0, F.lit(True))  # one of the rows of a prediction stands for it
    long = df.select(*by, "y_true", "y_pred", _loss(prob).alias("_loss"), F.posexplode_outer(prob).alias("class", "score"))
    positive = (F.col("y_true") == F.col("class")).cast("long")
    long = long.select(
        *by, "y_true", "y_pred", "class", "score", first.cast("long").alias("_n"), F.when(first, F.col("_loss")).alias("_loss"),
        positive.alias("_pos"), (1 - positive).alias("_neg"),
    )
    sets = [[*by, "y_true", "y_pred"], [*by, "class", "score"]]
    counted = long.groupingSets([[F.col(c) for c in s] for s in sets], *by, "y_true", "y_pred", "class", "score").agg(
        F.grouping("class").alias("_pair"),
        F.sum("_n").alias("n"),
        F.sum("_loss").alias("loss"),
        F.count("_loss").alias("losses"),
        F.sum("_pos").alias("pos"),
        F.sum("_neg").alias("neg"),
    )
    keys = [*by, "_pair", "class"]
    return score_bins(counted.filter((F.col("_pair") == 1) | F.col("class").isNotNull()), keys, limit)


def all_metrics(df: DataFrame, by: By = ("model",), prob: str | None = "prob", limit: int = BIN_ROWS) -> DataFrame:
    """Every metric in long form ``(by, metric, class, value)``; ``class`` is NULL for overall metrics.

    The predictions are read once and shuffled as counts. Wins inside a bin and across bins take a shuffle each, and the last one
    brings a model's few classes together.
    """
    by = list(by)
    frame = evaluation_frame(df, by, prob, limit)
    zero = F.lit(0).cast("long")
    sides = frame.filter("_pair = 1").select(*by, F.inline(_sides()), "loss", "losses")
    truth = F.col("support") > 0  # the loss of a row counts once, on the side of its truth
    sides = sides.withColumns({"loss": F.when(truth, F.col("loss")), "losses": F.when(truth, F.col("losses"))})
    scores, keys = frame.filter("_pair = 0"), [*by, "class"]
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos").cast("double") * (F.coalesce(F.sum("neg").over(in_bin), zero) + F.col("neg") / 2.0)
    bins = scores.withColumn("_w", wins).groupBy(*keys, "_bin").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "_w")])
    below = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("_w") + F.col("pos").cast("double") * F.coalesce(F.sum("neg").over(below), zero)
    areas = bins.withColumn("_w", total).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "_w")])
    together = stack([sides, areas]).repartition(*by) if by else stack([sides, areas]).repartition(1)
    sums = ("support", "predicted", "tp", "loss", "losses", "pos", "neg", "_w")
    classes = together.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    return _melted(classes, by, prob is not None)


def _melted(classes: DataFrame, by: list[str], with_scores: bool) -> DataFrame:
    """All metrics from one row of sums per class; a model's classes are summed over a window of a few rows."""
    group, order = Window.partitionBy(*by), Window.partitionBy(*by).orderBy("class")
    tp, s, p = (F.coalesce(F.col(c), F.lit(0)).cast("double") for c in ("tp", "support", "predicted"))
    total = lambda x: F.sum(x).over(group)
    occurs, auc = s + p > 0, _ratio(F.col("_w"), F.col("pos").cast("double") * F.col("neg"), None)
    rated = {"precision": _ratio(tp, p), "recall": _ratio(tp, s), "f1": _ratio(tp * 2, s + p)}
    n, right, sp, ss, pp = total(s), total(tp), total(s * p), total(s * s), total(p * p)
    overall = {"accuracy": right / n}
    overall |= {f"{m}_macro": F.avg(F.when(occurs, x)).over(group) for m, x in rated.items()}
    overall |= {f"{m}_weighted": total(x * s) / n for m, x in rated.items()}
    overall["mcc"] = _ratio(right * n - sp, F.sqrt((n * n - pp) * (n * n - ss)))
    overall["cohen_kappa"] = _ratio(right * n - sp, n * n - sp, None)
    if with_scores:
        complete = F.count(auc).over(group) == F.count("pos").over(group)
        overall["auc_roc_macro"] = F.when(complete, F.avg(auc).over(group))
        overall["auc_roc_weighted"] = F.when(complete, total(auc * F.col("pos")) / total(F.col("pos")))
        overall["log_loss"] = total(F.col("loss")) / total(F.col("losses"))
    fp, fn = p - tp, s - tp
    tn = n - s - p + tp
    per_class = {
        "sensitivity": _ratio(tp, s),
        "specificity": _ratio(tn, tn + fp),
        "ppv": _ratio(tp, p),
        "npv": _ratio(tn, tn + fn),
        "youden_index": _ratio(tp, s) + _ratio(tn, tn + fp) - 1.0,
        "diagnostic_odds_ratio": _ratio(tp * tn, fp * fn, float("inf")),
    }
    wide = classes.select(
        *by,
        F.col("class").cast("int").alias("class"),
        (s > 0).alias("_true"),
        (F.row_number().over(order) == 1).alias("_first"),
        *[x.alias(f"_o_{m}") for m, x in overall.items()],
        *[x.alias(f"_c_{m}") for m, x in per_class.items()],
    )
    none, no_rows = F.lit(None).cast("int"), F.array().cast("array<struct<metric:string,class:int,value:double>>")
    row = lambda m, c, x: F.struct(F.lit(m).alias("metric"), c.alias("class"), F.col(x).alias("value"))
    once = F.array(*[row(m, none, f"_o_{m}") for m in overall])
    each = F.array(*[row(m, F.col("class"), f"_c_{m}") for m in per_class])
    rows = F.concat(F.when(F.col("_first"), once).otherwise(no_rows), F.when(F.col("_true"), each).otherwise(no_rows))
    return wide.select(*by, F.inline(rows)).select(*by, "metric", "class", "value")


def save_report(df: DataFrame, folder: str, by: By = ("model",), prob: str | None = "prob") -> None:
    """Evaluate any table of predictions and write the report: metrics (JSON), comparison (CSV), confusion table, report per class
    and calibration (Parquet)."""
    from riskframe.sources import writers

    by = list(by)
    writers.write_metrics(all_metrics(df, by, prob), f"{folder}/metrics")
    writers.write_comparison(compare_models(df, by, prob), f"{folder}/comparison")
    writers.write_parquet(confusion_shares(df, by), f"{folder}/confusion")
    writers.write_parquet(classification_report(df, by), f"{folder}/classes")
    if prob is not None:
        writers.write_parquet(calibration(df, by, prob), f"{folder}/calibration")
