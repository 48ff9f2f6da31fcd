"""Fitted models: metrics against Spark's evaluators, ROC curves in both label
forms, versions behind a pointer."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from hosttel.operators import metrics as MT
from hosttel.plans import model_store, queries_models, queries_process
from hosttel.plans import pipelines as PL
from hosttel.streaming import score

from conftest import SF_SMALL

MULTI = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall",
         "weighted_f1": "f1"}


@pytest.fixture(scope="module", params=["process", "memory"])
def scored(spark, request):
    """Scored test rows of both full models of a table."""
    if request.param == "process":
        models, test = queries_models._fit(spark, SF_SMALL, ("dt", "gbt"))
        spec = queries_models.PROC_SPEC
    else:
        models, test = queries_models._fit_memory(spark, SF_SMALL, ("dt", "gbt"))
        spec = queries_models.MEM_SPEC
    out = {kind: PL.predict(m, test, spec).select("probability", "prediction", "attack").cache() for kind, m in models.items()}
    yield spec, out
    for df in out.values():
        df.unpersist()


def test_metrics_equal_the_evaluators(scored):
    spec, models = scored
    for pred in models.values():
        ours = PL.evaluate(pred, spec).first()
        area = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="attack", numBins=0).evaluate(pred)
        assert ours["scored"] == pred.count() and ours["auc"] == pytest.approx(area, abs=1e-9)
        assert 0.6 < ours["auc"] < 0.999  # learned, and not from a copy of the label
        for name, metric in MULTI.items():
            want = MulticlassClassificationEvaluator(labelCol="attack", metricName=metric).evaluate(pred)
            assert ours[name] == pytest.approx(want, abs=1e-9), name


@pytest.mark.parametrize("bins", [10, 1000])
def test_both_forms_mirror_each_other(scored, bins):
    for pred in scored[1].values():
        curve = MT.model_roc(pred, bins=bins).orderBy("form", "point").collect()
        forms = {f: [(r.fpr, r.tpr) for r in curve if r.form == f] for f in ("attack", "normal")}
        mirrored = [(1 - t, 1 - f) for f, t in reversed(forms["attack"])]
        assert len(mirrored) == len(forms["normal"]) <= bins + 1
        # the origin mirrors the last point, which is (1, 1)
        for a, b in zip(mirrored, forms["normal"], strict=True):
            assert a == pytest.approx(b, abs=1e-9)


def test_areas_of_bins(scored):
    for pred in scored[1].values():
        exact = {k: MT.auc(MT.score_label(pred, positive=k)).first()["auc"] for k in (1, 0)}
        assert exact[1] == pytest.approx(exact[0], abs=1e-9)
        for k, closed in ((1, "left"), (0, "right")):
            rows = MT.score_label(pred, positive=k)
            for bins in (20, 1000):
                whole = MT.score_bins(rows, bins=bins, closed=closed)
                got = MT.area_of_bins(whole).first()
                assert abs(got["auc"] - exact[k]) <= got["off_by"] + 1e-12
                halves = [rows.where(F.pmod(F.xxhash64("score", "label"), F.lit(2)) == h) for h in (0, 1)]
                merged = MT.merge_bins(*[MT.score_bins(h, bins=bins, closed=closed) for h in halves])
                assert sorted(merged.collect()) == sorted(whole.collect())


def test_bins_of_edges_ties_and_nulls(spark):
    rows = [(0.0, 1.0), (1.0, 0.0), (0.1 + 0.2, 1.0), (0.3, 0.0), (0.29999, 0.0), (None, 1.0), (0.5, None), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    left = {r.bin: (r.pos, r.neg) for r in MT.score_bins(df, bins=10).collect()}
    assert left == {0: (1, 0), 2: (0, 1), 3: (1, 1), 9: (1, 1)}
    right = {r.bin: (r.pos, r.neg) for r in MT.score_bins(df, bins=10, closed="right").collect()}
    assert right == {0: (1, 0), 2: (1, 2), 9: (1, 1)}
    with pytest.raises(Exception, match="only one class"):
        MT.roc_of_bins(MT.score_bins(df.where("label = 1"), bins=10), 10).collect()
    assert MT.area_of_bins(MT.score_bins(df.where("label = 1"))).first()["auc"] is None
    with pytest.raises(ValueError):
        MT.score_bins(df, closed="both")


def test_final_model_does_not_depend_on_partitions(spark):
    data = queries_process._memory_loads(spark, SF_SMALL)
    made = [PL.final_model(data.repartition(n), queries_process.FINAL_SPEC, kind="dt", key="row_key", maxDepth=2) for n in (1, 9)]
    p = [sorted(PL.predict(m, data, queries_process.FINAL_SPEC)
                .select("row_key", MT.class_probability("probability", 1)).collect()) for m in made]
    assert p[0] == p[1]


def test_pointer_moves_only_to_whole_models(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    assert model_store.current(spark, root) is None
    with pytest.raises(ValueError, match="no model"):
        model_store.load_current(spark, root)
    data, spec = queries_process._memory_loads(spark, SF_SMALL), queries_process.FINAL_SPEC
    fit = lambda depth: PL.final_model(data, spec, kind="dt", key="row_key", maxDepth=depth)
    assert model_store.save_version(fit(1), spark, root) == 1

    class Broken:
        def write(self):
            raise OSError("disk full")

    with pytest.raises(OSError):
        model_store.save_version(Broken(), spark, root)
    (tmp_path / "store" / "pointer" / "version=9" / "_temporary" / "0").mkdir(parents=True)  # a pointer being written
    assert model_store.load_current(spark, root)[0] == 1
    assert model_store.save_version(fit(2), spark, root) == 2
    version, model = model_store.load_current(spark, root)
    assert version == 2 and model.stages[-1].getMaxDepth() == 2
    assert [r.version for r in model_store.versions(spark, root).orderBy("version").collect()] == [1, 2]


def test_refit_of_both_tables(spark, tmp_path):
    root = f"file://{tmp_path}/both"
    process = queries_models._model_input(spark, SF_SMALL)
    tables = {"process": (process, queries_models.PROC_SPEC, "sequence"),
              "memory": (queries_models._memory_input(spark, SF_SMALL), queries_models.MEM_SPEC, "row_key")}
    assert model_store.refit(spark, tables, root, kind="dt") == {"process": 1, "memory": 1}
    assert model_store.refit(spark, {"memory": tables["memory"]}, root, kind="dt") == {"memory": 2}
    for name, (df, spec, _) in tables.items():
        version, model = model_store.load_current(spark, f"{root}/{name}")
        assert version == {"process": 1, "memory": 2}[name]
        assert PL.predict(model, df, spec).where("probability IS NULL").count() == 0


def test_stream_takes_the_newest_version(spark, tmp_path):
    """Each batch is scored whole with the version that is newest when it starts."""
    data, spec = queries_process._memory_loads(spark, SF_SMALL), queries_process.FINAL_SPEC
    root, src, out = (f"file://{tmp_path}/{x}" for x in ("models", "in", "out"))
    rows = data.select("row_key", "load").where("row_key % 50 = 0")
    for i, depth in enumerate((1, 3)):
        model_store.save_version(PL.final_model(data, spec, kind="dt", key="row_key", maxDepth=depth), spark, root)
        rows.where(F.col("row_key") % 100 == 50 * i).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(rows.schema).parquet(src)
        q = score.write_scored(stream, root, ["row_key"], out, f"{tmp_path}/chk", available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.parquet(out)
    assert got.count() == rows.count()
    assert {(r.odd, r.model_version) for r in got.select((F.col("row_key") % 100 == 50).alias("odd"), "model_version")
            .distinct().collect()} == {(False, 1), (True, 2)}
    newest = PL.predict(model_store.load_current(spark, root)[1], rows.withColumn("attack", F.lit(0)), spec)
    want = newest.where("row_key % 100 = 50").select("row_key", MT.class_probability("probability", 1)).collect()
    assert sorted(got.where("model_version = 2").select("row_key", "p_attack").collect()) == sorted(want)
