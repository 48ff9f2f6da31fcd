"""Operators against brute force on small inputs and against edge rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hosttel.operators import audit, messages as M, metrics as MT, profile, sample as S
from hosttel.operators.ordinal import ordinal, prefix_sums
from hosttel.plans import pipelines as PL
from hosttel.sources.fixtures import proc

from conftest import SF_MID, SF_SMALL


def test_ordinal_matches_row_number(spark):
    p = proc(spark, SF_MID)
    got = ordinal(p, ["sequence"], ["machine"], name="rn", group_size="n").select("sequence", "rn", "n")
    w = Window.partitionBy("machine").orderBy("sequence")
    ref = p.select("sequence", F.row_number().over(w).alias("rn"),
                   F.count("*").over(Window.partitionBy("machine")).alias("n"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_ordinal_hot_group_spans_partitions(spark):
    # one group holds every row: the ordinal must still be 1..n, computed over many partitions
    df = spark.range(5000).select(F.lit(1).alias("g"), (F.col("id") * 7 % 5000).alias("o"))
    got = ordinal(df, ["o"], ["g"], name="rn", partitions=16)
    assert got.where(F.col("rn") != F.col("o") + 1).count() == 0
    assert got.count() == 5000


def test_ordinal_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "g string, o int")
    got = {(r.g, r.o, r.rn) for r in ordinal(df, ["o"], ["g"], name="rn").collect()}
    assert got == {(None, 1, 1), (None, 2, 2), ("a", 1, 1)}


def test_prefix_sums_match_window(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = prefix_sums(df, [F.desc("k")], ["v"], ["cv"], rank="r", partitions=8)
    w = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("k", "v", F.sum("v").over(w).alias("cv"), F.row_number().over(Window.orderBy(F.desc("k"))).alias("r"))
    assert got.exceptAll(ref).count() == 0 and got.count() == 3000


def test_missing_audit_kinds(spark):
    df = spark.createDataFrame([(None, None, 1), (float("nan"), "NaN", 2), (1.0, "x", None)],
                               "d double, s string, i int")
    row = audit.missing_counts(df).first()
    assert (row.d, row.s, row.i) == (2, 2, 1)


def test_class_counts_null_label(spark):
    df = spark.createDataFrame([(None,), (1,), (1,)], "attack int")
    got = {r[0]: r[1] for r in profile.class_counts(df).collect()}
    assert got == {None: 0, 1: 2}


def test_arg_extremes_first_on_tie(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 1.0), (5, 1.0)], "pos int, y double")
    r = profile.arg_extremes(df, "pos", "y", "pos").first()
    assert (r.argmax_pos, r.argmin_pos, r.max_y, r.min_y) == (2, 4, 9.0, 1.0)


def test_balance_clamps_and_errors(spark):
    many_attacks = spark.createDataFrame([(1,)] * 50 + [(0,)] * 5, "attack int")
    f = S.balance_fractions(many_attacks).first()
    assert f.ratio > 1 and f.fraction_normal == 1.0
    no_attack = spark.createDataFrame([(0,)] * 5, "attack int").withColumn("k", F.monotonically_increasing_id())
    with pytest.raises(Exception, match="no attack rows"):
        S.balance(no_attack).count()
    no_normal = spark.createDataFrame([(1,)] * 5, "attack int")
    with pytest.raises(Exception, match="no normal rows"):
        S.balance(no_normal).count()


def test_hash_split_is_partition_independent(spark):
    p = proc(spark, SF_SMALL).select("sequence", "attack")
    a = S.hash_split(p.repartition(1), "sequence").where("split = 'train'").select("sequence")
    b = S.hash_split(p.repartition(7), "sequence").where("split = 'train'").select("sequence")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_string_index_matches_stringindexer(spark):
    from pyspark.ml.feature import StringIndexer
    p = proc(spark, SF_MID).select("state")
    ours = {r["state"]: r["state_index"] for r in S.string_index(p, "state").collect()}
    model = StringIndexer(inputCol="state", outputCol="i").fit(p)
    assert {v: float(i) for i, v in enumerate(model.labels)} == ours


def test_message_rows_brute_force(spark):
    rows = [(m, s) for m in (1, 2) for s in range(23)]
    df = spark.createDataFrame(rows, "machine int, sequence long")
    framed = M.frame_ticks(df, main=4, late=2)
    got = sorted((r.offset_id, r.machine, r.sequence, r.resent) for r in M.message_rows(framed).collect())
    # brute force: slices of 6 per machine; positions 4, 5 are late and re-sent in every later tick
    exp = []
    last = max((s // 6) for _, s in rows)
    for m, s in rows:
        t, pos = s // 6, s % 6
        if pos < 4:
            exp.append((t, m, s, False))
        else:
            exp += [(o, m, s, True) for o in range(t + 1, last + 1)]
    assert got == sorted(exp)


def test_counts_intervals_and_start_equal_all_copies(spark):
    """The closed forms against every re-sent copy, machines of unequal length."""
    sizes = {1: 47, 2: 6, 3: 4, 4: 0, 5: 13}
    df = spark.createDataFrame([(m, m * 100 + s, 1000 * s + m) for m, n in sizes.items() for s in range(n)],
                               "machine int, sequence long, ts long")
    framed, last = M.frame_ticks(df, main=4, late=2), M.last_tick(df, main=4, late=2)
    rows = M.message_rows(framed, last=last)
    for chunk in (2, 4096):
        counts = M.message_counts_sized(df, last, main=4, late=2, chunk=chunk)
        want = M.message_counts(rows)
        assert counts.exceptAll(want).count() == 0 and want.exceptAll(counts).count() == 0
    spans = M.message_intervals(framed, last).select("machine", "sequence", "first_offset", "last_offset")
    want = rows.groupBy("machine", "sequence").agg(F.min("offset_id"), F.max("offset_id"))
    assert spans.exceptAll(want).count() == 0 and want.exceptAll(spans).count() == 0
    start = M.message_start(framed).select("offset_id", "ts")
    want = rows.groupBy("offset_id").agg(F.min_by("ts", F.struct("machine", "sequence")))
    assert start.exceptAll(want).count() == 0 and want.exceptAll(start).count() == 0


def test_message_rows_horizon(spark):
    df = spark.createDataFrame([(1, s) for s in range(30)], "machine int, sequence long")
    rows = M.message_rows(M.frame_ticks(df, main=2, late=1), horizon=2)
    per = rows.where("resent").groupBy("machine", "sequence").count().select("count").distinct().collect()
    assert {r[0] for r in per} <= {1, 2}


def test_wide_counts_zero_for_absent_machine(spark):
    counts = spark.createDataFrame([(0, 1, 3), (0, 2, 4), (1, 1, 5)], "offset_id long, machine int, n long")
    got = {r.offset_id: (r.machine_1, r.machine_2) for r in M.message_counts_wide(counts, [1, 2]).collect()}
    assert got == {0: (3, 4), 1: (5, 0)}


def test_pack_unpack_roundtrip(spark):
    from hosttel.plans.queries_messages import ROW_COLS, ROW_SCHEMA
    p = proc(spark, SF_SMALL)
    rows = M.message_rows(M.frame_ticks(p), backlog=False)
    back = M.unpack_messages(M.pack_messages(rows, ROW_COLS), ROW_SCHEMA).select(*ROW_COLS)
    assert back.exceptAll(p.select(*ROW_COLS)).count() == 0
    assert back.count() == p.count()


def test_trailing_window_matches_rows_frame(spark):
    counts = spark.createDataFrame([(o, m, (o * 3 + m) % 7) for o in range(40) for m in (1, 2)],
                                   "offset_id long, machine int, n long")
    got = M.trailing_window(counts, 5)
    w = Window.partitionBy("machine").orderBy("offset_id").rowsBetween(-4, 0)
    ref = counts.select("offset_id", "machine", F.sum("n").over(w).alias("window_sum"),
                        F.count("n").over(w).alias("window_len"))
    assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0


def test_roc_all_scores_equal_is_two_points(spark):
    df = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.5, 1)], "score double, label int")
    pts = [(r.fpr, r.tpr) for r in MT.roc_points(df).orderBy("point").collect()]
    assert pts == [(0.0, 0.0), (1.0, 1.0)]
    assert MT.auc(df).first().auc == pytest.approx(0.5)


def test_roc_one_class_errors(spark):
    df = spark.createDataFrame([(0.1, 1), (0.7, 1)], "score double, label int")
    with pytest.raises(Exception, match="one class"):
        MT.roc_points(df).collect()


def test_auc_equals_binary_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    p = proc(spark, SF_MID).select(F.col("tslpi").cast("double").alias("score"),
                                   F.col("attack").cast("double").alias("label"))
    ours = MT.auc(p).first().auc
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                           numBins=0).evaluate(p)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_metrics_equal_multiclass_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    p = proc(spark, SF_MID).select(F.col("attack").cast("double").alias("label"),
                                   F.when(F.col("cpu") > 50, 1.0).otherwise(0.0).alias("prediction"))
    ours = MT.classification_metrics(p).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for ours_name, metric in [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                              ("weighted_recall", "weightedRecall"), ("weighted_f1", "f1")]:
        assert ours[ours_name] == pytest.approx(ev.evaluate(p, {ev.metricName: metric}), abs=1e-12)


def test_exact_quantiles_match_percentile(spark):
    p = proc(spark, SF_MID)
    ours = profile.exact_quantiles(p.select("cpu"), "cpu", [0.25, 0.5, 0.75]).first()
    ref = p.agg(F.percentile("cpu", [0.25, 0.5, 0.75]).alias("q")).first().q
    assert [ours.q25, ours.q50, ours.q75] == pytest.approx(ref, abs=1e-9)


def test_ordinal_shuffle_join_path(spark):
    # broadcast_rows=0: no broadcast hint; the planner picks the join from the
    # checkpointed table's real size. Results must not depend on the choice.
    p = proc(spark, SF_SMALL)
    a = ordinal(p, ["sequence"], ["machine"], name="rn", broadcast_rows=0).select("sequence", "rn")
    b = ordinal(p, ["sequence"], ["machine"], name="rn").select("sequence", "rn")
    assert a.exceptAll(b).count() == 0 and a.count() == p.count()


def test_hash_unit_large_keys_do_not_overflow(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000 // 1000 * 1000,), (123,)], "k long")
    got = [r[0] for r in df.select(S.hash_unit("k")).collect()]
    exp = [pow((k * 7919 + 1) % 1000037, 3, 1000037) / 1000037 for k in (9_000_000_000_000_000_000 // 1000 * 1000, 123)]
    assert got == pytest.approx(exp)
    s = S.hash_split(spark.createDataFrame([("a",), ("b",)], "k string"), "k")
    assert s.count() == 2


def test_correlation_pairwise_complete_like_pandas(spark):
    import pandas as pd
    rows = [(1.0, 2.0, 5.0), (2.0, float("nan"), 3.0), (3.0, 7.0, None), (4.0, 8.5, 1.0), (5.0, 9.0, 0.5)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.x, r.y): r.r for r in profile.correlation_pairs(df, ["a", "b", "c"], digits=None).collect()}
    ref = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for x in "abc":
        for y in "abc":
            assert got[(x, y)] == pytest.approx(ref.loc[x, y], abs=1e-12)


@pytest.mark.parametrize("rpb", [1_000_000, 700, 53])
def test_bucketed_ordinal_matches_ranged(spark, rpb):
    p = proc(spark, SF_MID)
    a = ordinal(p, ["sequence"], ["machine"], name="rn", group_size="n", method="bucket",
                rows_per_bucket=rpb).select("sequence", "rn", "n")
    b = ordinal(p, ["sequence"], ["machine"], name="rn", group_size="n", method="ranged") \
        .select("sequence", "rn", "n")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_bucketed_ordinal_global_and_nulls(spark):
    df = spark.createDataFrame([(None,), (5,), (1,), (None,), (3,)] * 3, "o int")
    got = sorted(r.rn for r in ordinal(df, ["o"], [], name="rn", method="bucket", rows_per_bucket=2)
                 .collect())
    assert got == list(range(1, 16))
    first = ordinal(df, ["o"], [], name="rn", method="bucket", rows_per_bucket=2).where("rn <= 6")
    assert first.where("o IS NOT NULL").count() == 0      # nulls first
    hot = spark.range(3000).select(F.lit(7).alias("g"), ((F.col("id") * 37) % 3000).alias("o"))
    r = ordinal(hot, ["o"], ["g"], name="rn", method="bucket", rows_per_bucket=100)
    assert r.where(F.col("rn") != F.col("o") + 1).count() == 0


def test_numeric_profile_rounding_modes(spark):
    df = spark.createDataFrame([(0.125,), (0.125,)], "x double")
    up = profile.numeric_profile(df, ["x"], digits=2).first()
    even = profile.numeric_profile(df, ["x"], digits=2, half_even=True).first()
    assert (up.mean, even.mean) == (0.13, 0.12)
    assert up["count"] == 2 and up.std == 0.0


def test_scatter_sample_is_bounded_subset(spark):
    p = proc(spark, SF_MID)
    s = profile.scatter_sample(p, ["cpu", "ts"], "attack", fraction=0.05)
    n = s.count()
    assert 0 < n < 2000 and s.columns == ["cpu", "ts", "attack"]
    assert s.exceptAll(p.select("cpu", "ts", "attack")).count() == 0


def test_stamp_rows_uses_one_time(spark):
    p = proc(spark, SF_SMALL).select("sequence")
    stamped = M.stamp_rows(p)
    row = stamped.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    import time
    assert row.lo == row.hi and abs(row.lo - time.time()) < 600


def test_auto_ordinal_heavy_tailed_values(spark):
    # 99 % of values tiny, a few huge: auto picks the range method for doubles
    df = spark.range(4000).select(F.lit(1).alias("g"),
                                  F.when(F.col("id") % 100 == 0, F.col("id") * 1e9)
                                  .otherwise(F.col("id") * 1e-3).alias("v"), "id")
    got = ordinal(df, ["v"], ["g"], name="rn")
    w = Window.partitionBy("g").orderBy("v")
    ref = df.select("id", F.row_number().over(w).alias("rn"))
    assert got.select("id", "rn").exceptAll(ref).count() == 0


@pytest.mark.parametrize("grouped", [False, True])
def test_exact_quantiles_with_coarse_sketch(spark, grouped):
    # accuracy 50 on 10 000 rows: brackets hold hundreds of candidates, and the
    # answer must still be exact
    p = proc(spark, SF_MID).select("machine", "cpu")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    g = ["machine"] if grouped else []
    ours = profile.exact_quantiles(p, "cpu", probs, g, accuracy=50)
    ref = (p.groupBy(*g) if g else p.groupBy()).agg(F.percentile("cpu", probs).alias("q"))
    key = (lambda r: r["machine"]) if grouped else (lambda r: 0)
    ref_map = {key(r): r.q for r in ref.collect()}
    for r in ours.collect():
        got = [r[f"q{int(x * 100)}"] for x in probs]
        assert got == pytest.approx(ref_map[key(r)], abs=1e-9)
    assert ours.count() == len(ref_map)


def test_exact_quantiles_many_groups_fallback(spark):
    p = proc(spark, SF_MID).select("machine", "cpu")
    probs = [0.25, 0.5, 0.75]
    a = profile.exact_quantiles(p, "cpu", probs, ["machine"], broadcast_rows=0)  # forces the fallback
    b = profile.exact_quantiles(p, "cpu", probs, ["machine"])
    ra = {r.machine: (r.q25, r.q50, r.q75) for r in a.collect()}
    rb = {r.machine: (r.q25, r.q50, r.q75) for r in b.collect()}
    assert ra.keys() == rb.keys()
    for m in ra:
        assert ra[m] == pytest.approx(rb[m], abs=1e-9)


def test_hot_machine_is_spread_over_tasks(spark):
    # one machine holds every row; measure rows per task where numbering happens
    df = spark.range(20000).select(F.lit(1).alias("machine"), F.col("id").alias("sequence"))
    def rows_per_task(numbered):
        # consume rn so the numbering is not pruned away, and tag each row
        # with the task that produced it
        tagged = numbered.select(F.col("rn"), F.spark_partition_id().alias("p"))
        out = tagged.groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.sum("rn").alias("s"))
        return [r["c"] for r in out.collect()]

    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")     # tiny data: AQE would merge every partition into one
    try:
        ours = ordinal(df, ["sequence"], ["machine"], name="rn", rows_per_bucket=500)
        counts = rows_per_task(ours)
        assert max(counts) <= 0.5 * 20000 and len(counts) >= 4
        plain = df.withColumn("rn", F.row_number().over(Window.partitionBy("machine")
                                                        .orderBy("sequence")))
        assert max(rows_per_task(plain)) == 20000      # the pattern we avoid: one task
    finally:
        spark.conf.set(key, old)
    assert ours.where(F.col("rn") != F.col("sequence") + 1).count() == 0


@pytest.mark.parametrize("strict", [False, True])
def test_last_tick_equals_framed_max(spark, strict):
    for n in (1, 52, 53, 54, 106, 107, 500):
        df = spark.createDataFrame([(1, s) for s in range(n)] + [(2, s) for s in range(n // 2)],
                                   "machine int, sequence long")
        framed = M.frame_ticks(df, strict=strict)
        exp = framed.agg(F.max("offset_id")).first()[0]
        assert M.last_tick(df, strict=strict) == (-1 if exp is None else exp), n


def test_bucketed_ordinal_ntz_across_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 02:00-03:00 does not exist in New York; NTZ values do
        df = spark.sql("""SELECT 1 AS g, t FROM VALUES
            (TIMESTAMP_NTZ '2024-03-10 01:50:00'), (TIMESTAMP_NTZ '2024-03-10 02:30:00'),
            (TIMESTAMP_NTZ '2024-03-10 03:10:00'), (TIMESTAMP_NTZ '2024-03-10 04:00:00') AS v(t)""")
        got = [r.t.hour * 60 + r.t.minute for r in
               ordinal(df, ["t"], ["g"], name="rn", method="bucket", rows_per_bucket=1)
               .orderBy("rn").collect()]
        assert got == sorted(got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("horizon", [None, 1, 3])
def test_direct_counts_equal_counted_copies(spark, horizon):
    df = spark.createDataFrame([(m, s) for m in (1, 2) for s in range(40 if m == 1 else 17)],
                               "machine int, sequence long")
    framed = M.frame_ticks(df, main=4, late=2)
    last = M.last_tick(df, main=4, late=2)
    a = M.message_counts_direct(framed, last, horizon)
    b = M.message_counts(M.message_rows(framed, horizon=horizon, last=last))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ranged_ordinal_spreads_hot_group(spark):
    df = spark.range(20000).select(F.lit("m").alias("g"), (F.col("id") * 0.5).alias("v"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        ours = ordinal(df, ["v"], ["g"], name="rn", method="ranged")
        tagged = ours.select("rn", F.spark_partition_id().alias("p"))
        counts = [r["c"] for r in tagged.groupBy("p").agg(F.count(F.lit(1)).alias("c"),
                                                          F.sum("rn").alias("s")).collect()]
        assert max(counts) <= 0.5 * 20000 and len(counts) >= 4
        assert ours.where(F.col("rn") != F.col("v") * 2 + 1).count() == 0
    finally:
        spark.conf.set(key, old)


def test_sample_is_independent_of_split(spark):
    """Rates of the sample inside the training part, and of the split, for several seeds."""
    df = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("attack"))
    tests = []
    for seed in (0, 1, 2):
        train, test = PL.train_test(df, PL.FeatureSpec([], []), key="k", seed=seed)
        n_test = test.count()
        assert abs(n_test / 40_000 - 0.2) < 0.01
        whole = S.hash_split(df, "k", seed=seed, name="s").where("s = 'train'")
        got = train.groupBy("attack").count().collect()
        base = {r.attack: r["count"] for r in whole.groupBy("attack").count().collect()}
        kept = {r.attack: r["count"] for r in got}
        assert abs(kept[1] / base[1] - 0.2) < 0.02 and abs(kept[0] / kept[1] - 2) < 0.2
        tests.append({r.k for r in test.collect()})
    for a, b in ((0, 1), (0, 2), (1, 2)):  # other seeds, other rows: 4 % in common, not 20
        assert abs(len(tests[a] & tests[b]) / 40_000 - 0.04) < 0.01


def test_models_keep_every_row(spark):
    rows = [(i, ["a", "b", None][i % 3], None if i % 4 == 0 else float("nan") if i % 4 == 1 else float(i), i % 2)
            for i in range(200)]
    df = spark.createDataFrame(rows, "k long, cmd string, size double, attack int")
    spec = PL.FeatureSpec(["cmd"], ["size"])
    model = PL.fit_models(df, spec, ("dt",))["dt"]
    live = df.unionByName(spark.createDataFrame([(999, "unseen", None, 0)], df.schema))
    pred = PL.predict(model, live, spec)
    assert pred.count() == 201 and pred.where("prediction IS NULL").count() == 0


def test_checkpoint_folder_falls_back_on_local_masters_only():
    from hosttel import session
    assert session.fallback_checkpoint_dir("local[8]") and session.fallback_checkpoint_dir("local")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.fallback_checkpoint_dir(master)


@pytest.mark.parametrize("values", ["outlier", "equal", "two"])
def test_uneven_values_do_not_meet_in_one_task(spark, values):
    """A hot group with one outlier, one value or two: numbered right, by tasks of like size."""
    from hosttel.operators import ordinal as O
    v = {"outlier": F.when(F.col("id") == 7, F.lit(10 ** 12)).otherwise(F.col("id")),
         "equal": F.lit(5).cast("long"), "two": (F.col("id") % 2)}[values]
    df = spark.range(20_000).select("id", F.lit("m").alias("g"), v.alias("v"))
    got = ordinal(df, ["v"], ["g"], name="rn", rows_per_bucket=500)
    assert got.agg(F.min("rn"), F.max("rn"), F.count_distinct("rn")).first() == (1, 20_000, 20_000)
    assert got.orderBy("rn").select("v").agg(F.max("v")).first()[0] is not None
    best = got.groupBy("v").agg(F.min("rn").alias("a"), F.max("rn").alias("b"), F.count("*").alias("c"))
    assert best.where("b - a + 1 != c").count() == 0          # equal values hold consecutive numbers
    if values == "outlier":
        assert got.where("v = 1000000000000").first().rn == 20_000
    ranged = (df.withColumn(O._T, F.rand(0)).repartitionByRange(16, "g", "v", O._T)
              .groupBy(F.spark_partition_id().alias("p")).count())
    assert ranged.agg(F.max("count")).first()[0] <= 2 * 20_000 / 16


def test_quantiles_of_few_values(spark):
    """Two values in one hot column: candidates collapse by value."""
    df = spark.range(40_000).select((F.col("id") % 4 == 0).cast("double").alias("v"))
    q = profile.exact_quantiles(df, "v", [0.25, 0.5, 0.75, 0.8]).first()
    assert list(q) == [0.0, 0.0, 0.25, 1.0]
