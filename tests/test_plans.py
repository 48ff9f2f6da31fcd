"""Plan properties: pruning, pushdown, codegen, and no plan shapes that
gather a hot group or pair rows."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from hosttel.sources.fixtures import proc

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_reads_one_column(spark):
    plan = _plan(E.queries()["attacks_by_type"](spark, SF_SMALL))
    assert "ReadSchema: struct<event_type:string>" in plan or "struct<event_type:string>" in plan
    assert "HashAggregate" in plan and "partial_sum" in plan


def test_filter_pushes_through_fixture_view(spark):
    df = proc(spark, SF_SMALL).where(F.col("sequence") < 100).select("sequence", "cpu")
    plan = _plan(df)
    assert "PushedFilters" in plan and "LessThan(event_id,100)" in plan
    assert "struct<event_id:bigint,value:double>" in plan


def test_cleaning_is_codegen_without_python(spark):
    plan = _plan(E.queries()["mem_clean"](spark, SF_SMALL))
    assert "WholeStageCodegen" in plan or "*(" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_no_pairs_or_gathered_groups(spark):
    import re
    # a window whose partition spec is the machine alone (a hot group in one task)
    by_machine = re.compile(r"Window \[[^\n]*\], \[machine#\d+\], \[")
    for name in ["late_backlog", "message_counts", "trailing_window", "ticks", "model_metrics",
                 "roc_points", "auc", "dedup_backlog"]:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        assert not by_machine.search(plan), name       # no window partitioned by machine
        assert "collect_list" not in plan, name
        if "row_number()" in plan and "machine#" in plan and name != "trailing_window":
            # numbering within machines is split by bucket (the skew-safe ordinal)
            assert "_ob_b#" in plan or "_ord_p#" in plan or "_ord_m#" in plan, name


def test_trailing_window_has_no_window_operator(spark):
    from hosttel.operators import messages as M
    counts = spark.range(200).select((F.col("id") % 40).alias("offset_id"),
                                     (F.col("id") % 5).cast("int").alias("machine"),
                                     F.lit(3).cast("long").alias("n"))
    plan = _plan(M.trailing_window(counts, 16))
    assert "Window " not in plan and "WindowGroupLimit" not in plan
