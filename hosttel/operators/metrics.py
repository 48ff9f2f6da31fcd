"""Classifier evaluation.

Everything starts from small aggregates: a confusion matrix (classes² rows)
for the multiclass metrics, and one row per distinct score for ROC/AUC. The
prediction table is scanned once per metric family, not once per metric.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed
from .ordinal import prefix_sums


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` counts — one partial aggregate."""
    return df.groupBy(F.col(label).cast("double").alias("label"),
                      F.col(prediction).cast("double").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                           digits: int | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (M11), one row.

    Same definitions as ``MulticlassClassificationEvaluator``: per true class
    ``precision = tp / predicted`` (0 when nothing is predicted),
    ``recall = tp / support``, ``f1 = 2·tp / (predicted + support)``; weights
    are class supports.
    """
    return metrics_of_confusion(confusion(df, label, prediction), digits)


def metrics_of_confusion(cm: DataFrame, digits: int | None = None) -> DataFrame:
    """The metrics from ``(label, prediction, n)``. A cell counts once for its
    true class and once for its predicted one: a single aggregate by class, no join."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), hit.alias("tp"), zero.alias("predicted")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("support"), zero.alias("tp"), F.col("n").alias("predicted")))
    j = cm.select(F.inline(sides)).groupBy("cls").agg(
        *[F.sum(c).alias(c) for c in ("support", "tp", "predicted")])
    tp, sup, pred = (F.col(c).cast("double") for c in ("tp", "support", "predicted"))
    prec = F.when(pred > 0, tp / pred).otherwise(0.0)
    rec = F.when(sup > 0, tp / sup).otherwise(0.0)
    f1 = F.when(pred + sup > 0, 2.0 * tp / (pred + sup)).otherwise(0.0)
    total = F.sum(sup)
    out = j.agg((F.sum(tp) / total).alias("accuracy"),
                (F.sum(sup * prec) / total).alias("weighted_precision"),
                (F.sum(sup * rec) / total).alias("weighted_recall"),
                (F.sum(sup * f1) / total).alias("weighted_f1"))
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def class_probability(prob_col: str = "probability", index: int = 1) -> Column:
    """Component ``index`` of a probability vector as double."""
    return vector_to_array(F.col(prob_col))[index].cast("double")


def inverted_label(label: str = "attack") -> Column:
    """``1.0 - label`` (P12): the reference scores class 0 against it."""
    return F.lit(1.0) - F.col(label).cast("double")


def score_label(pred: DataFrame, label: str = "attack", prob_col: str = "probability",
                positive: int = 1) -> DataFrame:
    """``(score, label)`` pairs for ROC (M12). ``positive=1``: P(class 1)
    against the label; ``positive=0``: the reference's P(class 0) against
    ``1 - label`` (same AUC, reflected curve)."""
    if positive == 1:
        return pred.select(class_probability(prob_col, 1).alias("score"),
                           F.col(label).cast("double").alias("label"))
    return pred.select(class_probability(prob_col, 0).alias("score"),
                       inverted_label(label).alias("label"))


def _cumulative(df: DataFrame, score: str, label: str, positive) -> tuple[DataFrame, DataFrame]:
    """One row per distinct score, thresholds descending, with its positives
    and negatives and their running sums; and the table without the sums."""
    is_pos = (F.col(label) == F.lit(positive)).cast("long")
    by_score = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))
    # materialised once: its input (e.g. scoring a test set) is then computed
    # once for the totals and the sums
    by_score = checkpointed(by_score)
    return prefix_sums(by_score, [F.desc("threshold")], ["pos", "neg"], ["tp", "fp"], rank="point"), by_score


def roc_points(df: DataFrame, score: str = "score", label: str = "label",
               positive=1) -> DataFrame:
    """ROC curve (W4): one point per distinct score, thresholds descending,
    plus the origin. Columns ``threshold, fpr, tpr, point`` (point 0 = origin).

    Rows are first aggregated by score (partial aggregation), then cumulative
    positive/negative counts come from the distributed ``prefix_sums``.
    """
    cum, by_score = _cumulative(df, score, label, positive)
    # two numbers (class totals), computed once and inlined as literals
    totals = by_score.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    p_tot, n_tot = float(totals["P"] or 0), float(totals["N"] or 0)
    if p_tot == 0 or n_tot == 0:
        raise ValueError("roc: labels hold only one class")
    pts = cum.select("threshold", "point", (F.col("fp") / F.lit(n_tot)).alias("fpr"),
                     (F.col("tp") / F.lit(p_tot)).alias("tpr"))
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0).cast("long").alias("point"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(pts)


def score_bins(df: DataFrame, score: str = "score", label: str = "label", positive=1, bins: int = 1000,
               closed: str = "left") -> DataFrame:
    """Counts of positives and negatives in ``bins`` equal parts of [0, 1]
    (M12, M13): ``(bin, pos, neg)``, at most ``bins`` rows whatever the input.

    One partial aggregate. Counts are mergeable: those of several days or
    streams add up. A part holds its lower edge (``closed="left"``) or its
    upper one (``"right"``, for scores that are one minus another's); 0 and 1
    belong to the outermost parts. Rows without score or label are left out.
    """
    if closed not in ("left", "right"):
        raise ValueError(closed)
    # a score that is an edge up to rounding is that edge
    at = F.round(F.col(score).cast("double") * bins, 9)
    part = F.floor(at) if closed == "left" else F.ceil(at) - 1
    is_pos = (F.col(label) == F.lit(positive)).cast("long")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.greatest(F.lit(0), F.least(F.lit(bins - 1), part)).cast("int").alias("bin"))
            .agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg")))


def merge_bins(*tables: DataFrame) -> DataFrame:
    """The counts of several ``score_bins`` added up."""
    return reduce(DataFrame.unionByName, tables).groupBy("bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_of_bins(counts: DataFrame, bins: int = 1000) -> DataFrame:
    """ROC curve from ``score_bins``: ``(point, threshold, pos, neg, fpr, tpr)``,
    thresholds descending, one point per occupied part and the origin (point 0).

    ``threshold`` is the part's lower edge. The window has no partition but at
    most ``bins`` rows. Labels of one class only are an error.
    """
    high_first = Window.orderBy(F.desc("bin"))
    upto = high_first.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    both = F.sum("pos").over(whole) * F.sum("neg").over(whole)
    share = lambda c: (F.when(both > 0, F.sum(c).over(upto) / F.sum(c).over(whole))
                       .otherwise(F.raise_error(F.lit("roc: labels hold only one class")).cast("double")))
    points = counts.select(F.row_number().over(high_first).cast("long").alias("point"),
                           (F.col("bin") / F.lit(float(bins))).alias("threshold"), "pos", "neg",
                           share("neg").alias("fpr"), share("pos").alias("tpr"))
    origin = counts.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("point"), F.lit(float("inf")).alias("threshold"),
        F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(points)


def area_of_bins(counts: DataFrame) -> DataFrame:
    """``(auc, off_by)``, one row: the area under the curve of the parts, and
    the most by which it can differ from the area under the exact curve (the
    pairs of unlike rows that share a part, whose order is not known, halved)."""
    high_first = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    tp = F.sum("pos").over(high_first)
    pairs = F.sum("pos") * F.sum("neg")
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2.0)
    return counts.select("pos", "neg", tp.alias("tp")).agg(
        F.when(pairs > 0, area / pairs).alias("auc"),
        F.when(pairs > 0, F.sum(F.col("pos") * F.col("neg")) / 2.0 / pairs).alias("off_by"))


def model_roc(pred: DataFrame, label: str = "attack", prob_col: str = "probability", bins: int = 1000) -> DataFrame:
    """The ROC curve of a fitted model's probabilities in both label forms
    (M12, P12, M13): ``(form, point, threshold, pos, neg, fpr, tpr)``.

    Form ``attack`` scores P(class 1) against the label, form ``normal``
    P(class 0) against ``1 - label`` (``score_label``). The parts of the second
    hold their upper edges, so the two curves mirror each other exactly: a
    point (fpr, tpr) of one is (1 - tpr, 1 - fpr) on the other. Each form is one scan of the scored rows and
    at most ``bins`` counts.
    """
    out = None
    for form, positive, closed in (("attack", 1, "left"), ("normal", 0, "right")):
        counts = score_bins(score_label(pred, label, prob_col, positive), bins=bins, closed=closed)
        curve = roc_of_bins(checkpointed(counts), bins)
        curve = curve.select(F.lit(form).alias("form"), "*")
        out = curve if out is None else out.unionByName(curve)
    return out


def auc(df: DataFrame, score: str = "score", label: str = "label", positive=1) -> DataFrame:
    """Area under ROC of ``(score, label)`` pairs (W5, M10 check). A point's
    predecessor is known from its own counts, so the area is one sum:
    ``neg · (2·tp - pos) / 2`` over ``P · N``."""
    cum, _ = _cumulative(df, score, label, positive)
    area = F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2.0)
    total = F.sum("pos") * F.sum("neg")
    return cum.agg(F.when(total > 0, area / total)
                   .otherwise(F.raise_error(F.lit("roc: labels hold only one class")).cast("double")).alias("auc"))


def scored_metrics(df: DataFrame, score: Column, label: str, prediction: str) -> DataFrame:
    """Rows scored, AUC and the multiclass metrics, one row, from one pass over
    the scored rows: all start from the counts by (score, label, prediction)."""
    counts = checkpointed(df.groupBy(score.alias("score"), F.col(label).cast("double").alias("label"),
                                     F.col(prediction).cast("double").alias("prediction"))
                          .agg(F.count(F.lit(1)).alias("n")))
    cm = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    by_score = counts.groupBy(F.col("score").alias("threshold")).agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(F.col("n"))).alias("neg"))
    cum = prefix_sums(by_score, [F.desc("threshold")], ["pos", "neg"], ["tp", "fp"])
    area = cum.agg((F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos")) / 2.0)
                    / (F.sum("pos") * F.sum("neg"))).alias("auc"))
    scored = counts.agg(F.coalesce(F.sum("n"), F.lit(0)))
    return metrics_of_confusion(cm).select(scored.scalar().alias("scored"), area.scalar().alias("auc"), "*")
