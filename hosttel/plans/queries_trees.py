"""Catalogue entries that check fitted trees by value.

One feature with at most 32 values and trees of depth one: Spark then tries
every cut between two values, so SQL can grow the same trees. The decision
tree's cut (half way between two values) and leaf counts, the boosted trees' probabilities, their metrics
and their ROC curves in both label forms are compared value by value.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..operators import sample as S
from ..sources.fixtures import PROC_SQL, proc
from . import pipelines as PL
from .queries_models import CPU_SPAN, CUT, U, _labelled
from .registry import DIGITS, register, with_views

LOAD_WIDTH, LOADS = 20, 32
STUMP_SPEC = PL.FeatureSpec(categorical=[], numeric=["load"], label="attack")
#: Boosting rounds, and Spark's weight of every round after the first.
ROUNDS, STEP = 4, 0.1
STUMPS = {"dt": {"maxDepth": 1}, "gbt": {"maxDepth": 1, "maxIter": ROUNDS, "stepSize": STEP}}
BINS = 200


def _loads(spark, sf):
    """The process-like rows with a load of at most 32 values and a label that has signal in it."""
    p = _labelled(proc(spark, sf), F.col("cpu"), CPU_SPAN, "sequence")
    load = F.least(F.floor(F.coalesce("cpu", F.lit(0.0)) / LOAD_WIDTH), F.lit(LOADS - 1)).cast("int")
    return p.select("sequence", load.alias("load"), "attack")


def _stumps(spark, sf, kinds):
    train, test = PL.train_test(_loads(spark, sf), STUMP_SPEC, key="sequence")
    return PL.fit_models(train, STUMP_SPEC, kinds, STUMPS), train, test


US = S.unit_sql("t.sequence", purpose="sample")
LOADS_SQL = f"""loads AS (
  SELECT sequence, CAST(least(floor(coalesce(cpu, 0.0) / {LOAD_WIDTH}), {LOADS - 1}) AS INTEGER) AS load,
         CASE WHEN coalesce(cpu, 0.0) / {CPU_SPAN} + {S.unit_sql('sequence', 5, 'sample')} > {CUT} THEN 1 ELSE 0 END AS attack
  FROM proc),
train AS (SELECT * FROM loads WHERE {U} < 0.8),
test AS (SELECT load, attack, count(*) AS n FROM loads WHERE {U} >= 0.8 GROUP BY load, attack),
ratio AS (SELECT (CAST(count_if(attack = 1) AS DOUBLE) * 0.2 * 2.0) / CAST(count_if(attack = 0) AS DOUBLE) AS ratio FROM train),
cells AS (SELECT load, attack, CAST(count(*) AS DOUBLE) AS n FROM train AS t, ratio
          WHERE (attack = 1 AND {US} < 0.2) OR (attack = 0 AND {US} < least(ratio, 1.0)) GROUP BY load, attack)"""

#: The cut with the greatest fall of Gini impurity; two leaves that predict the same class are one.
STUMP_SQL = """by_load AS (SELECT load, sum(n) FILTER (attack = 0) AS y0, sum(n) FILTER (attack = 1) AS y1 FROM cells GROUP BY load),
upto AS (SELECT load, (load + lead(load) OVER (ORDER BY load)) / 2.0 AS middle, sum(coalesce(y0, 0)) OVER w AS l0, sum(coalesce(y1, 0)) OVER w AS l1,
                sum(coalesce(y0, 0)) OVER () AS t0, sum(coalesce(y1, 0)) OVER () AS t1
         FROM by_load WINDOW w AS (ORDER BY load ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, (l0 * l0 + l1 * l1) / (l0 + l1) + ((t0 - l0) * (t0 - l0) + (t1 - l1) * (t1 - l1)) / (t0 + t1 - l0 - l1) AS purity
        FROM upto WHERE l0 + l1 < t0 + t1 ORDER BY purity DESC, load LIMIT 1),
one AS (SELECT (l1 > l0) = (t1 - l1 > t0 - l0) OR purity <= (t0 * t0 + t1 * t1) / (t0 + t1) AS same FROM cut),
leaf AS (SELECT CASE WHEN same THEN 0 WHEN c.load <= middle THEN 1 ELSE 2 END AS side, min(c.load) AS lowest, max(c.load) AS highest,
                sum(n) FILTER (attack = 0) AS y0, sum(n) FILTER (attack = 1) AS y1 FROM cells AS c, cut, one GROUP BY 1),
leaves AS (SELECT side, lowest, highest, coalesce(y0, 0) AS y0, coalesce(y1, 0) AS y1, coalesce(y1, 0) / (coalesce(y0, 0) + coalesce(y1, 0)) AS p
           FROM leaf)"""


def _boost_sql() -> str:
    """CTEs ``f1`` ... : the sum of the trees after each round, by load. The
    first tree is fitted to -1 and 1, the others to the loss's negative
    gradient; a cut minimises the squared error."""
    out = []
    for r in range(1, ROUNDS + 1):
        y = "2.0 * attack - 1.0"
        aim = y if r == 1 else f"4.0 * ({y}) / (1.0 + exp(2.0 * ({y}) * f))"
        source = "cells" if r == 1 else f"cells JOIN f{r - 1} USING (load)"
        before, weight = ("0.0", 1.0) if r == 1 else ("g.f", STEP)
        join = "" if r == 1 else f" JOIN f{r - 1} AS g USING (load)"
        out.append(f"""a{r} AS (SELECT load, sum(n) AS n, sum(n * ({aim})) AS s FROM {source} GROUP BY load),
b{r} AS (SELECT load, (load + lead(load) OVER (ORDER BY load)) / 2.0 AS middle, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER () AS tn, sum(s) OVER () AS ts
       FROM a{r} WINDOW w AS (ORDER BY load ROWS UNBOUNDED PRECEDING)),
c{r} AS (SELECT * FROM b{r} WHERE ln < tn ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC, load LIMIT 1),
f{r} AS (SELECT a.load, {before} + {weight} * CASE WHEN a.load <= c{r}.middle THEN ls / ln ELSE (ts - ls) / (tn - ln) END AS f
       FROM (SELECT range AS load FROM range({LOADS})) AS a{join}, c{r})""")
    return ",\n".join(out)


SCORED_SQL = f"""scored AS (
  SELECT 'dt' AS model, test.load, attack, n, p, CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
  FROM test CROSS JOIN cut JOIN leaves ON side = 0 OR side = CASE WHEN test.load <= middle THEN 1 ELSE 2 END
  UNION ALL
  SELECT 'gbt', load, attack, n, 1.0 / (1.0 + exp(-2.0 * f)), CASE WHEN f > 0 THEN 1.0 ELSE 0.0 END::DOUBLE
  FROM test JOIN f{ROUNDS} USING (load))"""

VIEWS = with_views(PROC_SQL, LOADS_SQL, STUMP_SQL, _boost_sql(), SCORED_SQL)


@register("tree_stump", with_views(PROC_SQL, LOADS_SQL, STUMP_SQL) + f"""
SELECT lowest, highest, CAST(y0 AS BIGINT) AS n_normal, CAST(y1 AS BIGINT) AS n_attack, round(p, {DIGITS}) AS p_attack,
       CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM leaves""")
def q_tree_stump(spark, sf):
    """The leaves of a decision tree of depth one, from the fitted model (M7):
    the values that fall into each, its class counts, probability and prediction."""
    models, train, _ = _stumps(spark, sf, ("dt",))
    scored = PL.predict(models["dt"], train, STUMP_SPEC)
    raw, p = vector_to_array("rawPrediction"), MT.class_probability("probability", 1)
    return (scored.groupBy(raw.alias("raw"), p.alias("p"), "prediction")
            .agg(F.min("load").alias("lowest"), F.max("load").alias("highest"))
            .select("lowest", "highest", F.col("raw")[0].cast("long").alias("n_normal"),
                    F.col("raw")[1].cast("long").alias("n_attack"), F.round("p", DIGITS).alias("p_attack"), "prediction"))


@register("boosted_stumps", VIEWS + f"""
SELECT load, CAST(sum(n) AS BIGINT) AS n, round(any_value(p), {DIGITS}) AS p_attack, any_value(prediction) AS prediction
FROM scored WHERE model = 'gbt' GROUP BY load""")
def q_boosted_stumps(spark, sf):
    """Gradient-boosted trees of depth one (M8): the probability that the test
    rows of each load get after all rounds."""
    models, _, test = _stumps(spark, sf, ("gbt",))
    scored = PL.predict(models["gbt"], test, STUMP_SPEC)
    p = MT.class_probability("probability", 1)
    return scored.groupBy("load", F.round(p, DIGITS).alias("p_attack"), "prediction").agg(F.count(F.lit(1)).alias("n"))


@register("stump_metrics", VIEWS + f""",
by_p AS (SELECT model, p, sum(n) FILTER (attack = 1) AS pos, sum(n) FILTER (attack = 0) AS neg FROM scored GROUP BY model, p),
cum AS (SELECT model, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg,
               sum(coalesce(pos, 0)) OVER (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp FROM by_p),
area AS (SELECT model, sum(neg * (2 * tp - pos) / 2.0) / (sum(pos) * sum(neg)) AS auc FROM cum GROUP BY model),
class AS (SELECT model, c, sum(n) FILTER (attack = c) AS support, sum(n) FILTER (prediction = c) AS predicted,
                 sum(n) FILTER (attack = c AND prediction = c) AS tp
          FROM scored, (VALUES (0), (1)) AS v(c) GROUP BY model, c),
part AS (SELECT model, coalesce(support, 0)::DOUBLE AS support, coalesce(predicted, 0)::DOUBLE AS predicted, coalesce(tp, 0)::DOUBLE AS tp FROM class)
SELECT model, CAST(sum(support) AS BIGINT) AS scored, round(any_value(auc), {DIGITS}) AS auc,
       round(sum(tp) / sum(support), {DIGITS}) AS accuracy,
       round(sum(support * CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END) / sum(support), {DIGITS}) AS weighted_precision,
       round(sum(support * CASE WHEN support > 0 THEN tp / support ELSE 0 END) / sum(support), {DIGITS}) AS weighted_recall,
       round(sum(support * CASE WHEN support + predicted > 0 THEN 2 * tp / (support + predicted) ELSE 0 END) / sum(support), {DIGITS}) AS weighted_f1
FROM part JOIN area USING (model) GROUP BY model""")
def q_stump_metrics(spark, sf):
    """AUC, accuracy, weighted precision, recall and F1 of both fitted models
    over the test rows, by value (M10, M11)."""
    models, _, test = _stumps(spark, sf, ("dt", "gbt"))
    out = None
    for kind, model in models.items():
        one = PL.evaluate(PL.predict(model, test, STUMP_SPEC), STUMP_SPEC)
        one = one.select(F.lit(kind).alias("model"), "scored", *[F.round(c, DIGITS).alias(c) for c in (
            "auc", "accuracy", "weighted_precision", "weighted_recall", "weighted_f1")])
        out = one if out is None else out.unionByName(one)
    return out


def _roc_sql(form: str, bin_sql: str, positive: int) -> str:
    return f"""
SELECT '{form}' AS form, CAST(0 AS BIGINT) AS point, CAST('inf' AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS pos, CAST(0 AS BIGINT) AS neg,
       0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT '{form}', row_number() OVER (ORDER BY bin DESC), bin / {float(BINS)}, CAST(pos AS BIGINT), CAST(neg AS BIGINT),
       round(sum(neg) OVER w / sum(neg) OVER (), {DIGITS}), round(sum(pos) OVER w / sum(pos) OVER (), {DIGITS})
FROM (SELECT greatest(0, least({BINS - 1}, {bin_sql})) AS bin, coalesce(sum(n) FILTER (attack = {positive}), 0) AS pos,
             coalesce(sum(n) FILTER (attack <> {positive}), 0) AS neg FROM scored WHERE model = 'gbt' GROUP BY 1)
WINDOW w AS (ORDER BY bin DESC ROWS UNBOUNDED PRECEDING)"""


@register("model_roc", VIEWS + "SELECT * FROM (" + _roc_sql("attack", f"floor(round(p * {BINS}, 9))", 1)
          + "\nUNION ALL" + _roc_sql("normal", f"ceil(round((1.0 - p) * {BINS}, 9)) - 1", 0) + ")")
def q_model_roc(spark, sf):
    """ROC curve of the fitted boosted trees in both label forms, over a fixed
    number of threshold bins (M12, P12, M13)."""
    models, _, test = _stumps(spark, sf, ("gbt",))
    curve = MT.model_roc(PL.predict(models["gbt"], test, STUMP_SPEC), "attack", bins=BINS)
    return curve.withColumns({c: F.round(c, DIGITS) for c in ("fpr", "tpr")})
