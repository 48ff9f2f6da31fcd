"""Catalogue entries for sampling, string index, metrics and tree models."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import strip_brackets
from ..operators import metrics as MT
from ..operators import sample as S
from ..session import scratch_path
from ..sources.fixtures import MEM_SQL, PROC_SQL, proc
from . import pipelines as PL
from .registry import DIGITS, register, with_views

PROC = with_views(PROC_SQL)
U = S.unit_sql("sequence")                        # portable hash of the key, seed 0
U_SAMPLE = S.unit_sql("p.sequence", purpose="sample")

TOTALS_SQL = """totals AS (
  SELECT count_if(attack = 0) AS n_normal, count_if(attack = 1) AS n_attack,
         (CAST(count_if(attack = 1) AS DOUBLE) * 0.2 * 2.0) / CAST(count_if(attack = 0) AS DOUBLE) AS ratio
  FROM proc)"""


@register("class_order_counts", PROC + "SELECT attack, count(*) AS count FROM proc GROUP BY attack")
def q_class_order_counts(spark, sf):
    """``groupBy(attack).count().orderBy(attack)``."""
    return S.class_order_counts(proc(spark, sf), "attack")


@register("balance_ratio", with_views(PROC_SQL, TOTALS_SQL) + f"""
SELECT n_normal, n_attack, round(ratio, {DIGITS}) AS ratio,
       round(least(ratio, 1.0), {DIGITS}) AS fraction_normal, CAST(0.2 AS DOUBLE) AS fraction_attack FROM totals""")
def q_balance_ratio(spark, sf):
    """Class totals and balancing fractions in one aggregate."""
    b = S.balance_fractions(proc(spark, sf), "attack")
    return b.select("n_normal", "n_attack", F.round("ratio", DIGITS).alias("ratio"),
                    F.round("fraction_normal", DIGITS).alias("fraction_normal"), "fraction_attack")


@register("hash_split", PROC + f"""
SELECT sequence, attack, CASE WHEN {U} < 0.8 THEN 'train' ELSE 'test' END AS split FROM proc""")
def q_hash_split(spark, sf):
    """Stable 80/20 split by key hash (M1, stable form); every row kept."""
    return S.hash_split(proc(spark, sf).select("sequence", "attack"), "sequence")


@register("hash_sample", with_views(PROC_SQL, TOTALS_SQL) + f"""
SELECT p.* FROM proc p, totals t
WHERE (p.attack = 1 AND {U_SAMPLE} < 0.2)
   OR (p.attack = 0 AND {U_SAMPLE} < least(t.ratio, 1.0))""")
def q_hash_sample(spark, sf):
    """Class-balanced sample with deterministic keep/drop (M2, M3)."""
    return S.balance(proc(spark, sf), "attack", method="hash", key="sequence")


@register("train_sample", with_views(PROC_SQL) + f""",
train AS (SELECT * FROM proc WHERE {U} < 0.8),
totals AS (
  SELECT (CAST(count_if(attack = 1) AS DOUBLE) * 0.2 * 2.0) / CAST(count_if(attack = 0) AS DOUBLE) AS ratio FROM train)
SELECT p.sequence, p.attack FROM train p, totals t
WHERE (p.attack = 1 AND {U_SAMPLE} < 0.2) OR (p.attack = 0 AND {U_SAMPLE} < least(t.ratio, 1.0))""")
def q_train_sample(spark, sf):
    """The balanced sample of the training part that models are fitted on (M1, M3)."""
    train, _ = PL.train_test(proc(spark, sf), PROC_SPEC, key="sequence")
    return train.select("sequence", "attack")


@register("random_split", PROC + "SELECT sequence, 1 AS parts FROM proc")
def q_random_split(spark, sf):
    """``randomSplit([0.8, 0.2], 0)`` (M1): every row lies in exactly one part."""
    train, test = S.random_split(proc(spark, sf))
    parts = train.select("sequence").unionAll(test.select("sequence"))
    return parts.groupBy("sequence").agg(F.count(F.lit(1)).cast("int").alias("parts"))


@register("strat_sample", with_views(PROC_SQL, TOTALS_SQL) + """
SELECT attack, count(*) AS n, true AS within FROM proc GROUP BY attack""")
def q_strat_sample(spark, sf):
    """``sampleBy`` with the balance recipe's fractions (M2, M3): per class the
    rows there are, and whether as many were drawn as the fraction asks for,
    within five standard deviations."""
    rows = proc(spark, sf).select("attack")
    drawn = S.balance(rows, "attack", method="bernoulli").groupBy("attack").agg(F.count(F.lit(1)).alias("k"))
    share = S.balance_fractions(rows, "attack").select(
        F.array("fraction_normal", "fraction_attack")).scalar()
    per = rows.groupBy("attack").agg(F.count(F.lit(1)).alias("n")).join(drawn, "attack", "left")
    f, n = F.get(share, F.col("attack")), F.col("n")
    return per.select("attack", "n", (F.abs(F.coalesce("k", F.lit(0)) - n * f)
                                      <= 5 * F.sqrt(n * f * (1 - f)) + 1e-9).alias("within"))


@register("string_index", PROC + """
SELECT cmd, n, CAST(row_number() OVER (ORDER BY n DESC, cmd) - 1 AS DOUBLE) AS cmd_index
FROM (SELECT rtrim(ltrim(cmd, '<'), '>') AS cmd, count(*) AS n FROM proc GROUP BY 1)""")
def q_string_index(spark, sf):
    """Category index by descending frequency (M4 relational twin)."""
    p = proc(spark, sf).select(strip_brackets("cmd").alias("cmd"))
    return S.string_index(p, "cmd", "cmd_index", "n")


CM_SQL = f"""p AS (SELECT CAST(attack AS DOUBLE) AS label, CASE WHEN cpu > 50 THEN 1.0 ELSE 0.0 END AS prediction FROM proc),
cm AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY ALL),
pc AS (SELECT label AS cls, CAST(sum(n) AS DOUBLE) AS support,
              CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS tp FROM cm GROUP BY label),
pr AS (SELECT prediction AS cls, CAST(sum(n) AS DOUBLE) AS predicted FROM cm GROUP BY prediction),
j AS (SELECT pc.*, coalesce(pr.predicted, 0) AS predicted FROM pc LEFT JOIN pr USING (cls))"""


@register("confusion_metrics", with_views(PROC_SQL, CM_SQL) + f"""
SELECT round(sum(tp) / sum(support), {DIGITS}) AS accuracy,
       round(sum(support * CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END) / sum(support), {DIGITS}) AS weighted_precision,
       round(sum(support * tp / support) / sum(support), {DIGITS}) AS weighted_recall,
       round(sum(support * CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END) / sum(support), {DIGITS}) AS weighted_f1
FROM j""")
def q_confusion_metrics(spark, sf):
    """Accuracy and weighted precision/recall/F1 from one confusion matrix."""
    p = proc(spark, sf).select(F.col("attack").alias("label"),
                               F.when(F.col("cpu") > 50, 1.0).otherwise(0.0).alias("prediction"))
    return MT.classification_metrics(p, "label", "prediction", digits=DIGITS)


ROC_SQL = """s AS (SELECT CAST(tslpi AS DOUBLE) AS threshold,
                  sum(CASE WHEN attack = 1 THEN 1 ELSE 0 END) AS pos,
                  sum(CASE WHEN attack = 1 THEN 0 ELSE 1 END) AS neg FROM proc GROUP BY 1),
c AS (SELECT threshold, row_number() OVER (ORDER BY threshold DESC) AS point,
             sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp FROM s),
t AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM s),
pts AS (
  SELECT CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS point, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
  UNION ALL
  SELECT threshold, CAST(point AS BIGINT), fp / N AS fpr, tp / P AS tpr FROM c, t)"""


@register("roc_points", with_views(PROC_SQL, ROC_SQL) + "SELECT * FROM pts")
def q_roc_points(spark, sf):
    """ROC curve of score ``tslpi`` against ``attack``."""
    p = proc(spark, sf)
    return MT.roc_points(p.select(F.col("tslpi").alias("score"), F.col("attack").alias("label")))


@register("auc", with_views(PROC_SQL, ROC_SQL) + f"""
SELECT round(sum((fpr - f0) * (tpr + t0) / 2.0), {DIGITS}) AS auc
FROM (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY point) AS f0, lag(tpr) OVER (ORDER BY point) AS t0 FROM pts)
WHERE f0 IS NOT NULL""")
def q_auc(spark, sf):
    """Area under that curve, trapezoid rule."""
    p = proc(spark, sf)
    a = MT.auc(p.select(F.col("tslpi").alias("score"), F.col("attack").alias("label")))
    return a.select(F.round("auc", DIGITS).alias("auc"))


# --- tree models over the process-like view --------------------------------

PROC_SPEC = PL.FeatureSpec(categorical=["state", "cmd"], numeric=["tslpi", "cpu"], label="attack")

# The label of the model fixtures: signal from one feature plus noise from the
# row's key, so a working pipeline scores well above chance and below 1.
CPU_SPAN, PRICE_SPAN, CUT = 490.0, 100_000.0, 1.1


def _labelled(df, feature, span: float, key: str):
    noise = S.hash_unit(key, purpose="sample", seed=5)
    return df.withColumn("attack", F.when(F.coalesce(feature, F.lit(0.0)) / span + noise > CUT, 1).otherwise(0))


def _model_input(spark, sf):
    p = proc(spark, sf)
    return _labelled(p.withColumn("cmd", strip_brackets("cmd")), F.col("cpu"), CPU_SPAN, "sequence")


def _fit(spark, sf, kinds):
    data = _model_input(spark, sf)
    train, test = PL.train_test(data, PROC_SPEC, key="sequence")
    models = PL.fit_models(train, PROC_SPEC, kinds)
    return models, test


MODEL_SQL = f"""model_input AS (
  SELECT sequence, machine, CASE WHEN coalesce(cpu, 0.0) / {CPU_SPAN}
    + {S.unit_sql('sequence', 5, 'sample')} > {CUT} THEN 1 ELSE 0 END AS attack FROM proc)"""
TEST_SQL = with_views(PROC_SQL, MODEL_SQL) + f"SELECT sequence, attack, true AS valid FROM model_input WHERE {U} >= 0.8"


def _pred_cols(pred):
    """The row, its prediction and probability, and whether they fit together
    (the probability lies in [0, 1] and the prediction is its likelier class)."""
    p = MT.class_probability("probability", 1)
    return pred.select("sequence", "attack", "prediction", p.alias("p_attack"),
                       (p.between(0, 1) & ((F.col("prediction") == 1) == (p > 0.5))).alias("valid"))


def _checked(pred):
    return _pred_cols(pred).select("sequence", "attack", "valid")


@register("train_predict_dt", TEST_SQL)
def q_train_predict_dt(spark, sf):
    """Decision-tree pipeline: balanced train split → predict the test split,
    every test row once (M4–M7, M9)."""
    models, test = _fit(spark, sf, ("dt",))
    return _checked(PL.predict(models["dt"], test, PROC_SPEC))


@register("train_predict_gbt", TEST_SQL)
def q_train_predict_gbt(spark, sf):
    """Gradient-boosted-trees pipeline on the same split (M8, M9)."""
    models, test = _fit(spark, sf, ("gbt",))
    return _checked(PL.predict(models["gbt"], test, PROC_SPEC))


def _evaluated(models, test, spec):
    """Per model: the rows scored, their confusion cells and all metrics, from one pass over them."""
    out = None
    for kind, model in models.items():
        one = PL.evaluate(PL.predict(model, test, spec), spec).select(F.lit(kind).alias("model"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("model_metrics")
def q_model_metrics(spark, sf):
    """AUC, accuracy, weighted precision/recall/F1 of both models over all test
    rows (M10, M11). No SQL for trees of depth five: pytest compares with
    Spark's evaluators; ``stump_metrics`` is the same by value."""
    models, test = _fit(spark, sf, ("dt", "gbt"))
    return _evaluated(models, test, PROC_SPEC)


def _supports_sql(view: str, where: str) -> str:
    return view + f"""
SELECT m.model, attack, count(*) AS support FROM model_input, (VALUES ('dt'), ('gbt')) AS m(model)
WHERE {where} GROUP BY m.model, attack"""


def _supports(models, test, spec):
    out = None
    for kind, model in models.items():
        cells = MT.confusion(PL.predict(model, test, spec), spec.label)
        one = cells.groupBy(F.col("label").cast("int").alias("attack")).agg(F.sum("n").alias("support"))
        one = one.select(F.lit(kind).alias("model"), "attack", "support")
        out = one if out is None else out.unionByName(one)
    return out


@register("model_supports", _supports_sql(with_views(PROC_SQL, MODEL_SQL), f"{U} >= 0.8"))
def q_model_supports(spark, sf):
    """Rows of each class in the confusion matrix of both models: every test row is scored once."""
    models, test = _fit(spark, sf, ("dt", "gbt"))
    return _supports(models, test, PROC_SPEC)


@register("model_roundtrip", with_views(PROC_SQL, MODEL_SQL) + "SELECT sequence, attack, true AS valid FROM model_input")
def q_model_roundtrip(spark, sf):
    """Final model on the whole balanced table, saved and loaded back: every
    row gets the same probability from both (M14, S10, S11)."""
    data = _model_input(spark, sf)
    path = scratch_path(spark, f"models/proc_gbt_{uuid.uuid4().hex}")
    model = PL.final_model(data, PROC_SPEC, path, kind="gbt")
    both = PL.predict(model, data, PROC_SPEC).select(
        "sequence", "attack", "state", "cmd", "tslpi", "cpu", F.col("probability").alias("p_before"))
    p = MT.class_probability
    return PL.predict(PL.load_model(path), both, PROC_SPEC).select(
        "sequence", "attack", (p("probability", 1) == p("p_before", 1)).alias("valid"))


MEM_SPEC = PL.FeatureSpec(categorical=["cmd"], numeric=["rsize", "vsize", "minflt"], label="attack")


MEM_KEY = "pid * 8 + seq"
MEM_MODEL_SQL = f"""model_input AS (
  SELECT row_key, CASE WHEN minflt / {PRICE_SPAN} + {S.unit_sql('row_key', 5, 'sample')} > {CUT} THEN 1 ELSE 0 END AS attack
  FROM (SELECT {MEM_KEY} AS row_key, CAST(minflt AS DOUBLE) AS minflt FROM mem))"""


def _fit_memory(spark, sf, kinds):
    train, test = PL.train_test(_memory_input(spark, sf), MEM_SPEC, key="row_key")
    return PL.fit_models(train, MEM_SPEC, kinds), test


def _memory_input(spark, sf):
    from .queries_batch import _mem_clean
    data = _mem_clean(spark, sf).withColumn("row_key", F.expr(MEM_KEY))
    return _labelled(data, F.col("minflt").cast("double"), PRICE_SPAN, "row_key")


@register("model_metrics_memory")
def q_model_metrics_memory(spark, sf):
    """The metrics of both tree pipelines on the memory-like table, rows with
    unreadable sizes included (M9–M11 for the second table). No SQL, as above."""
    models, test = _fit_memory(spark, sf, ("dt", "gbt"))
    return _evaluated(models, test, MEM_SPEC)


@register("model_supports_memory", _supports_sql(with_views(MEM_SQL, MEM_MODEL_SQL), f"{S.unit_sql('row_key')} >= 0.8"))
def q_model_supports_memory(spark, sf):
    """The same counts for the memory-like table."""
    models, test = _fit_memory(spark, sf, ("dt", "gbt"))
    return _supports(models, test, MEM_SPEC)
