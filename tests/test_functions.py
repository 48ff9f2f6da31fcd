"""Edge rows for the scalar functions (FIXTURES §4)."""

import math

from pyspark.sql import functions as F

from hosttel.functions import (SCALED, parse_int, parse_int_of_float, register_sql_functions,
                               size_to_double, size_to_long, strip_brackets)


def _one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {typ}")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_size_to_double_compat(spark):
    got = _one(spark, ["12", "3K", "2M", "4G", "K", " 7 8", "1.5K", "5k", "", None], size_to_double)
    assert got[:7] == [12.0, 3000.0, 2000000.0, 4000000000.0, 0.0, 78.0, 1.5]
    assert got[7:] == [None, None, None]


def test_size_scaled(spark):
    got = _one(spark, ["1.5K", "2M", "7", "3 G"], lambda c: size_to_double(c, SCALED))
    assert got == [1500.0, 2000000.0, 7.0, 3e9]


def test_size_to_long(spark):
    assert _one(spark, ["4G", "1.5K", "12"], size_to_long) == [4000000000, None, 12]
    assert _one(spark, ["1.5K"], lambda c: size_to_long(c, SCALED)) == [1500]


def test_strip_brackets(spark):
    assert _one(spark, ["<<a>b>>", ">x<", None, "plain"], strip_brackets) == ["a>b", ">x<", None, "plain"]


def test_parse_ints(spark):
    assert _one(spark, ["12", "12.7", "x"], parse_int) == [12, None, None]
    assert _one(spark, ["12.7", "-3.9", "x"], parse_int_of_float) == [12, -3, None]


def test_sql_functions_are_inlined(spark):
    register_sql_functions(spark)
    row = spark.sql("SELECT size_num('3K') a, size_int('4G') b, strip_brackets('<<a>b>>') c, "
                    "clock_text(3661) d").first()
    assert (row.a, row.b, row.c, row.d) == (3000.0, 4000000000, "a>b", "01:01:01")
    plan = spark.sql("SELECT size_num(s) FROM VALUES ('1K') AS t(s)")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_float32_parity(spark):
    v = _one(spark, ["1.1K"], lambda c: size_to_double(c).cast("float"))[0]
    assert math.isclose(v, 1.1, rel_tol=1e-6)


def test_time_functions_ignore_session_zone(spark):
    from hosttel.functions import clock_text, ntz_epoch_seconds
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            row = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.9' AS t, 86400 + 3661 AS e") \
                .select(ntz_epoch_seconds("t").alias("s"), clock_text("e").alias("c")).first()
            assert (row.s, row.c) == (1704164645, "01:01:01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_size_for_sets_partitions(spark):
    from hosttel.session import size_for
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        assert size_for(spark, 10 * 1024 ** 4) == 40960           # 10 TiB / 256 MiB
        assert size_for(spark, 1024) == 40960                     # never fewer than configured
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
