"""Catalogue entries over the full process feature set and the final models
of both tables (P14, M4–M6, M9, M14, A4, O1)."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import metrics as MT
from ..operators import profile
from ..operators import sample as S
from ..operators.clean import clean_process
from ..session import scratch_path
from ..sources.fixtures import MEM_SQL, PROC_FULL_SQL, mem, proc_full
from . import model_store
from . import pipelines as PL
from .queries_models import CUT, MEM_KEY, PRICE_SPAN, U, _labelled
from .queries_trees import STUMP_SQL
from .registry import DIGITS, register, with_views

FULL = with_views(PROC_FULL_SQL)
SPEC = PL.PROCESS_FEATURES
US = S.unit_sql("t.sequence", purpose="sample")


def _full(spark, sf):
    return clean_process(proc_full(spark, sf))


@register("status_counts", FULL + """
SELECT "Status", count(*) AS "Total" FROM proc_full GROUP BY "Status" ORDER BY 2 DESC, 1 LIMIT 10""")
def q_status_counts(spark, sf):
    """Most frequent process statuses (A4, O1)."""
    return profile.top_values(proc_full(spark, sf), "Status", 10, "Total")


@register("policy_counts", FULL + """
SELECT "POLI", count(*) AS "Total" FROM proc_full GROUP BY "POLI" ORDER BY 2 DESC, 1 LIMIT 10""")
def q_policy_counts(spark, sf):
    """Most frequent scheduling policies (A4, O1)."""
    return profile.top_values(proc_full(spark, sf), "POLI", 10, "Total")


_CATEGORIES = ["Status", "State", "CMD"]


def _index_sql(c: str) -> str:
    return f"""{c}_index AS (SELECT "{c}", CAST(row_number() OVER (ORDER BY count(*) DESC, "{c}") - 1 AS DOUBLE) AS i
  FROM sample WHERE "{c}" IS NOT NULL GROUP BY "{c}")"""


FEATURES_SQL = f"""full_rows AS (SELECT * REPLACE (rtrim(ltrim("CMD", '<'), '>') AS "CMD") FROM proc_full),
train AS (SELECT * FROM full_rows WHERE {U} < 0.8),
ratio AS (SELECT (CAST(count_if(attack = 1) AS DOUBLE) * 0.2 * 2.0) / CAST(count_if(attack = 0) AS DOUBLE) AS ratio FROM train),
sample AS (SELECT t.* FROM train AS t, ratio WHERE (attack = 1 AND {US} < 0.2) OR (attack = 0 AND {US} < least(ratio, 1.0))),
mean AS (SELECT avg("TSLPI") AS mean_tslpi, avg("CPU") AS mean_cpu, avg("CPUNR") AS mean_cpunr FROM sample),
""" + ",\n".join(map(_index_sql, _CATEGORIES))


def _size_sql(c: str) -> str:
    return f"(SELECT count(*) FROM {c}_index)"


@register("process_features", with_views(PROC_FULL_SQL, FEATURES_SQL) + f"""
SELECT sequence, {', '.join(f'coalesce({c}_index.i, {_size_sql(c)}) AS {c.lower()}_index' for c in _CATEGORIES)},
       CAST({' + '.join(map(_size_sql, _CATEGORIES))} + 6 AS BIGINT) AS n_features,
       round(coalesce("TSLPI", mean_tslpi), {DIGITS}) AS tslpi, round(coalesce("CPU", mean_cpu), {DIGITS}) AS cpu,
       CASE WHEN "CPU" IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS cpu_missing, round(coalesce("CPUNR", mean_cpunr), {DIGITS}) AS cpunr,
       CAST((Status_index.i IS NOT NULL)::INT + (State_index.i IS NOT NULL)::INT + (CMD_index.i IS NOT NULL)::INT AS DOUBLE) AS n_seen
FROM full_rows AS p CROSS JOIN mean {' '.join(f'LEFT JOIN {c}_index ON {c}_index."{c}" = p."{c}"' for c in _CATEGORIES)}
WHERE {U} >= 0.8""")
def q_process_features(spark, sf):
    """The feature vectors of the test rows from the pipeline fitted on the
    training sample (P14, M4–M6): three categories by frequency, values that
    were never seen in a place of their own, three numbers, missing ones
    filled with the sample's mean and flagged."""
    from pyspark.ml import Pipeline

    train, test = PL.train_test(_full(spark, sf), SPEC, key="sequence")
    fitted = Pipeline(stages=PL.feature_stages(SPEC)).fit(train)
    made = fitted.transform(test).withColumn("v", vector_to_array("features"))
    n = F.size("v")
    tail = lambda i: F.round(F.element_at("v", n - 5 + i), DIGITS)
    # one place of each category's block is set, but for values never seen: theirs is the one that one-hot drops
    ones = F.aggregate(F.slice("v", F.lit(1), n - 6), F.lit(0.0), lambda a, x: a + x)
    return made.select("sequence", *[F.col(f"{c}_index").alias(f"{c.lower()}_index") for c in _CATEGORIES],
                       n.cast("long").alias("n_features"), tail(0).alias("tslpi"), tail(1).alias("cpu"),
                       tail(4).alias("cpu_missing"), tail(2).alias("cpunr"), ones.alias("n_seen"))


@register("train_predict_full", with_views(PROC_FULL_SQL, FEATURES_SQL) + f"""
SELECT sequence, attack, "State" = 'Z' AS unseen, true AS valid FROM full_rows WHERE {U} >= 0.8""")
def q_train_predict_full(spark, sf):
    """Both classifiers on the full feature set, categories of the test part
    that training never saw included: every test row scored once by each (M6–M9, P14)."""
    train, test = PL.train_test(_full(spark, sf), SPEC, key="sequence")
    models = PL.fit_models(train, SPEC, ("dt", "gbt"), {"gbt": {"maxIter": 5}})
    p = MT.class_probability("probability", 1)
    scored = None
    for model in models.values():
        one = PL.predict(model, test, SPEC).select(
            "sequence", "attack", "State", (p.between(0, 1) & ((F.col("prediction") == 1) == (p > 0.5))).alias("valid"))
        scored = one if scored is None else scored.unionByName(one)
    return (scored.groupBy("sequence", "attack", (F.col("State") == "Z").alias("unseen"))
            .agg((F.bool_and("valid") & (F.count(F.lit(1)) == len(models))).alias("valid")))


# --- final models ------------------------------------------------------------

PAGE_WIDTH, PAGES = 4000, 32
FINAL_SPEC = PL.FeatureSpec(categorical=[], numeric=["load"], label="attack")


def _memory_loads(spark, sf):
    m = mem(spark, sf).select(F.expr(MEM_KEY).alias("row_key"), F.col("minflt").cast("double").alias("minflt"))
    load = F.least(F.floor(F.col("minflt") / PAGE_WIDTH), F.lit(PAGES - 1)).cast("int")
    return _labelled(m, F.col("minflt"), PRICE_SPAN, "row_key").select("row_key", load.alias("load"), "attack")


MEMORY_CELLS_SQL = f"""t AS (
  SELECT row_key, CAST(least(floor(minflt / {PAGE_WIDTH}), {PAGES - 1}) AS INTEGER) AS load,
         CASE WHEN minflt / {PRICE_SPAN} + {S.unit_sql('row_key', 5, 'sample')} > {CUT} THEN 1 ELSE 0 END AS attack
  FROM (SELECT {MEM_KEY} AS row_key, CAST(minflt AS DOUBLE) AS minflt FROM mem)),
ratio AS (SELECT (CAST(count_if(attack = 1) AS DOUBLE) * 0.2 * 2.0) / CAST(count_if(attack = 0) AS DOUBLE) AS ratio FROM t),
cells AS (SELECT load, attack, CAST(count(*) AS DOUBLE) AS n FROM t, ratio
          WHERE (attack = 1 AND {S.unit_sql('row_key', purpose='sample')} < 0.2)
             OR (attack = 0 AND {S.unit_sql('row_key', purpose='sample')} < least(ratio, 1.0)) GROUP BY load, attack)"""


@register("final_model_memory", with_views(MEM_SQL, MEMORY_CELLS_SQL, STUMP_SQL) + f"""
SELECT CAST(2 AS INTEGER) AS version, CASE WHEN side = 0 OR t.load <= middle THEN 0 ELSE 1 END AS side, count(*) AS n,
       round(any_value(p), {DIGITS}) AS p_attack
FROM t CROSS JOIN cut JOIN leaves ON side = 0 OR side = CASE WHEN t.load <= middle THEN 1 ELSE 2 END GROUP BY 2""")
def q_final_model_memory(spark, sf):
    """Final model of the memory-like table (M14, S10, S11): fitted on the
    whole balanced table and saved twice as a version; the newest one is
    loaded by its pointer and scores all rows, compared by value."""
    data = _memory_loads(spark, sf)
    root = scratch_path(spark, f"models/{uuid.uuid4().hex}")
    tables = {"memory": (data, FINAL_SPEC, "row_key")}
    model_store.refit(spark, {"memory": (data.withColumn("attack", 1 - F.col("attack")), FINAL_SPEC, "row_key")},
                      root, kind="dt", maxDepth=1)
    model_store.refit(spark, tables, root, kind="dt", maxDepth=1)
    version, model = model_store.load_current(spark, f"{root}/memory")
    scored = PL.predict(model, data, FINAL_SPEC).groupBy(MT.class_probability("probability", 1).alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.min("load").alias("lowest"))
    return scored.select(F.lit(version).alias("version"), F.when(F.col("lowest") == 0, 0).otherwise(1).alias("side"), "n",
                         F.round("p", DIGITS).alias("p_attack"))
