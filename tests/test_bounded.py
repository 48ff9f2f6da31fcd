"""Operators whose memory or output is bounded: exact samples, heavy hitters,
messages of a limited size, streams without state."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hosttel.operators import messages as M
from hosttel.operators import profile
from hosttel.operators import sample as S
from hosttel.streaming import decode, late, repeats, sinks


# --- samples of an exact size -------------------------------------------------

def plain_sample(rows, k):
    """The k rows of each class with the lowest priority, by (priority, key)."""
    out = []
    for g in {r[1] for r in rows}:
        mine = [r for r in rows if r[1] == g]
        out += sorted(mine, key=lambda r: (r[2], r[0]))[:k]
    return sorted((r[0], str(r[1])) for r in out)


@pytest.mark.parametrize("k", [0, 1, 7, 100, 5000])
def test_exact_sample(spark, k):
    df = spark.range(3000).selectExpr("id AS key", "CASE WHEN id % 100 = 0 THEN NULL WHEN id % 7 = 0 THEN 'b' ELSE 'a' END AS c").repartition(9)
    rows = [tuple(r) for r in df.select("key", "c", S.key_unit(df, "key", 0, "sample")).collect()]
    got = S.exact_sample(df, k, "key", "c")
    assert got.columns == ["key", "c"]
    assert sorted((r.key, str(r.c)) for r in got.collect()) == plain_sample(rows, k)


def test_sample_merges_and_nests(spark):
    df = spark.range(4000).selectExpr("id AS key", "id % 3 AS c")
    whole = sorted(S.exact_sample(df, 50, "key", "c").collect())
    halves = [S.exact_sample(df.where(F.col("key") % 2 == h), 50, "key", "c") for h in (0, 1)]
    assert sorted(S.exact_sample(halves[0].unionByName(halves[1]), 50, "key", "c").collect()) == whole
    assert set(S.exact_sample(df, 20, "key", "c").collect()) <= set(whole)
    assert S.exact_sample(df, 30, "key").count() == 30
    assert S.exact_sample(df, 30, "key", seed=3).exceptAll(S.exact_sample(df, 30, "key")).count() > 0


def test_sample_edge_rows(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a"), (1, "a"), (2, None)], "key long, c string")
    assert S.exact_sample(df, 3, "key", "c").count() == 4
    assert {r.key for r in S.exact_sample(df, 2, "key", "c").where("c = 'a'").collect()} == {1}  # null keys last
    assert S.exact_sample(df.where("key = 9"), 3, "key", "c").collect() == []
    with pytest.raises(ValueError):
        S.exact_sample(df, -1, "key")
    with pytest.raises(ValueError):
        profile.scatter_sample(df, ["key"], "c", size=3)


def test_sample_of_coarse_priorities(spark):
    """Many rows share a priority when keys repeat modulo the hash's prime."""
    df = spark.range(5000).selectExpr("id * 1000037 AS key")
    assert S.exact_sample(df, 10, "key").count() == 10
    assert {r.key for r in S.exact_sample(df, 10, "key").collect()} == {i * 1000037 for i in range(10)}


# --- heavy hitters --------------------------------------------------------------

@pytest.mark.parametrize("cells, first", [(1 << 16, None), (64, 1), (3, 1), (1, 1)])
def test_heavy_hitters_are_exact(spark, cells, first):
    """However the values share cells, and however few cells a round takes."""
    values = [i for i in range(400) for _ in range(1 + (i * 7919) % 40)] + [None] * 500
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    for k in (1, 10, 500):
        want = sorted(Counter(v for v in values if v is not None).items(), key=lambda x: (-x[1], x[0]))[:k]
        assert [tuple(r) for r in profile.heavy_hitters(df, "v", k, "n", cells, first).collect()] == want


def test_heavy_hitters_edge_rows(spark):
    none = spark.createDataFrame([(None,), (None,)], "v string")
    assert profile.heavy_hitters(none, "v").collect() == [] == profile.heavy_hitters(none.limit(0), "v").collect()
    flat = spark.range(3000).selectExpr("CAST(id AS STRING) AS v")  # all as frequent: ties by value
    assert [r.v for r in profile.heavy_hitters(flat, "v", 5, cells=128).collect()] == sorted(map(str, range(3000)))[:5]


# --- messages bounded in bytes ------------------------------------------------

@pytest.mark.parametrize("limit", [120, 500, 100_000])
def test_bounded_messages(spark, limit):
    rows = [(i % 2, 1 + i % 3, i, "é" * (i * 13 % 40), None if i % 5 else i) for i in range(600)]
    df = spark.createDataFrame(rows, "offset_id long, machine int, sequence long, cmd string, cpu long").repartition(6)
    got = M.pack_bounded(df, ["sequence", "cmd", "cpu"], limit).collect()
    assert all(len(r.value.encode()) <= limit and r.n_rows == len(json.loads(r.value)) for r in got)
    seen = sorted((r.offset_id, r.machine, r.part, x["sequence"]) for r in got for x in json.loads(r.value))
    assert sorted(x[3] for x in seen) == list(range(600))
    for g in {x[:2] for x in seen}:  # parts follow the order of the rows
        assert [x[3] for x in seen if x[:2] == g] == sorted(x[3] for x in seen if x[:2] == g)
    least = sum(len(r.value.encode()) for r in got) / limit
    biggest = max(len(json.dumps(x, ensure_ascii=False, separators=(",", ":")).encode()) + 1 for r in got for x in json.loads(r.value))
    assert len(got) <= 6 + least * limit / (limit - biggest)  # few more than needed
    with pytest.raises(ValueError, match="a row needs"):
        M.pack_bounded(df, ["sequence", "cmd", "cpu"], 60)


# --- repeated rows without state ------------------------------------------------

KEYS = ["machine", "sequence"]


def drain(q):
    q.awaitTermination()
    assert q.exception() is None
    return q


@pytest.mark.parametrize("blocks, buckets", [(4096, 64), (1, 1), (8, 4)])
def test_unique_rows_over_batches(spark, tmp_path, blocks, buckets):
    """Copies in the same batch, the next one and much later; null keys; a
    filter that is full (one block for all keys) still loses no row."""
    schema = "machine int, sequence long, v string"
    for i in range(6):
        rows = [(m, s, "x") for m in (1, 2, None) for s in [*range(i * 100, i * 100 + 150), None]] + [(1, 3, "x")] * 5
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = drain(repeats.write_unique(stream, KEYS, f"{tmp_path}/out", f"{tmp_path}/chk", buckets, blocks, available_now=True))
    assert all(not p["stateOperators"] for p in q.recentProgress) and len(q.recentProgress) >= 6
    got = repeats.read_unique(spark, f"{tmp_path}/out")
    assert got.columns == ["machine", "sequence", "v"]
    want = {(m, s) for m in (1, 2, None) for s in [*range(650), None]}
    assert Counter((r.machine, r.sequence) for r in got.collect()) == dict.fromkeys(want, 1)


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    """The last batch runs again after its tables were written but not committed."""
    import os

    for i in range(3):
        spark.range(i * 10, i * 10 + 20).selectExpr("1 AS machine", "id AS sequence").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("machine int, sequence long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = lambda: drain(repeats.write_unique(stream, KEYS, f"{tmp_path}/out", f"{tmp_path}/chk", available_now=True))
    run()
    for name in ("2", ".2.crc"):
        os.unlink(tmp_path / "chk" / "commits" / name)
    run()
    got = [r.sequence for r in repeats.read_unique(spark, f"{tmp_path}/out").collect()]
    assert sorted(got) == list(range(40))


def test_filter_is_written_by_many_tasks(spark, tmp_path):
    """No task merges the whole filter, and a batch's table holds each block once."""
    for i in range(3):
        spark.range(i * 900, i * 900 + 1000).selectExpr("1 AS machine", "id AS sequence").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("machine int, sequence long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so little data is one task otherwise
    try:
        drain(repeats.write_unique(stream, KEYS, f"{tmp_path}/out", f"{tmp_path}/chk", 4, 512, available_now=True))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert repeats.read_unique(spark, f"{tmp_path}/out").count() == 2800
    for batch in range(3):
        files = list((tmp_path / "out" / "filter" / f"batch={batch}").glob("*.parquet"))
        table = spark.read.parquet(str(files[0].parent))
        assert len(files) > 1 and table.count() == table.select("block").distinct().count() > 400


def test_filter_rules_out_most_new_keys(spark):
    """At the sizes of the defaults the filter passes few keys that were never seen, and all that were."""
    seen = spark.range(200_000).selectExpr("id AS k")
    blocks = repeats.bloom_blocks(seen, ["k"])
    assert blocks.count() <= repeats.BLOCKS
    both = repeats.split_by_filter(spark.range(300_000).selectExpr("id AS k"), blocks, ["k"])
    n = both.groupBy((F.col("k") < 200_000).alias("old"), "__maybe_seen").count().collect()
    counts = {(r.old, r["__maybe_seen"]): r["count"] for r in n}
    assert counts.get((True, False), 0) == 0 and counts.get((False, True), 0) < 100


# --- late rows ------------------------------------------------------------------

def test_late_rows_are_counted(spark, tmp_path):
    hour = 3600
    steps = [[(1, t) for t in range(0, 10 * hour, 600)], [(1, 20 * hour), (2, 20 * hour)], [(1, 21 * hour)],
             [(1, 5), (1, 6), (2, 7), (1, 20 * hour + 1)]]
    for rows in steps:
        spark.createDataFrame(rows, "machine int, ts long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("machine int, ts long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    rows = late.with_event_time(stream, "ts")
    drain(late.write_window_revisions(rows, f"{tmp_path}/r", f"{tmp_path}/c1", delay="1 hour", width="1 hour", available_now=True))
    drain(late.write_window_counts(rows, f"{tmp_path}/n", f"{tmp_path}/c2", width="1 hour", available_now=True))
    got = {(r.window_start // hour, r.machine): (r.n, r.dropped)
           for r in late.read_window_revisions(spark, f"{tmp_path}/r", f"{tmp_path}/n").collect()}
    assert got[0, 1] == (6, 2) and got[0, 2] == (0, 1) and got[20, 1] == (2, 0) and got[20, 2] == (1, 0)
    assert sum(n + d for n, d in got.values()) == sum(map(len, steps))
    alone = {(r.window_start // hour, r.machine): r.n for r in late.read_window_revisions(spark, f"{tmp_path}/r").collect()}
    assert alone == {k: n for k, (n, _) in got.items() if n}


# --- unreadable messages ----------------------------------------------------------

def test_no_message_is_lost(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    values = ['[{"a": 1}, {"a": 2, "b": "x"}]', "[]", None, "", "[", '{"a": 1}', "17", "null", '[{"a": 1}, 17, null, {"a": 3}]',
              '[{"a": "no number", "b": "y"}]', ' [{"a": 5}] ', "[[1]]"]
    env = spark.createDataFrame([(i, None if v is None else bytearray(v.encode())) for i, v in enumerate(values)], "offset long, value binary")
    got = {r.offset_id: r for r in decode.checked_messages(env, schema).collect()}
    assert sorted(got) == list(range(len(values)))
    assert all(r.n_received == r.n_decoded + r.n_refused and r.n_decoded == len(r.rows) for r in got.values())
    assert [got[i].reason for i in range(len(values))] == [
        None, None, "no value", "not JSON", "not JSON", "not an array", "not an array", "not an array",
        "rows are not objects", None, None, "rows are not objects"]
    assert [x.a for x in got[8].rows] == [1, 3] and got[8].n_refused == 2 and got[10].rows[0].a == 5
    assert got[9].rows[0].b == "y"


def test_one_file_is_decoded_by_many_tasks(spark, tmp_path, monkeypatch):
    """What a task decodes and keeps is bounded by the text, not by the split of the file."""
    from hosttel.sources import kafka as K

    rows = spark.range(20_000).selectExpr("id DIV 100 AS offset_id", "id AS sequence", "CAST(id % 3 AS INT) AS machine", "CAST(NULL AS STRING) AS cmd")
    K.write_envelope_files(K.to_envelope(M.pack_messages(rows, ["sequence", "machine", "cmd"], tasks=5), "t").coalesce(1), f"{tmp_path}/in")
    monkeypatch.setattr(K, "TASK_BYTES", 100_000)
    written = spark.read.parquet(f"{tmp_path}/in")
    assert written.count() == 600 and K.message_tasks(written) > 5 and K.message_tasks(written.limit(0)) == 1
    schema = rows.select("sequence", "machine", "cmd").schema
    drain(decode.write_decoded(K.read_envelope_stream(spark, f"{tmp_path}/in"), schema, f"{tmp_path}/out", f"{tmp_path}/chk", available_now=True))
    assert len(list((tmp_path / "out" / "rows" / "batch=0").glob("*.parquet"))) > 5
    got = spark.read.parquet(f"{tmp_path}/out/rows").drop("pos", "batch")
    assert got.exceptAll(rows.select(*got.columns)).count() == 0 and got.count() == 20_000
    assert spark.read.parquet(f"{tmp_path}/out/counts").agg(F.sum("n_received"), F.count("offset_id")).first()[:] == (20_000, 600)


# --- SQL over a live table ----------------------------------------------------------

def test_live_table_grows_while_the_stream_runs(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
    try:
        for upto in (20, 30):
            q = sinks.to_table(stream, "live_rows", f"{tmp_path}/chk", trigger="100 milliseconds", path=f"{tmp_path}/table")
            q.processAllAvailable()
            assert sinks.query_live(spark, "live_rows", "SELECT count(*) AS n FROM {table}").first()["n"] == upto - 10
            spark.range(upto - 10, upto).write.mode("append").parquet(f"{tmp_path}/in")
            q.processAllAvailable()
            assert q.isActive
            assert sinks.query_live(spark, "live_rows", "SELECT count(DISTINCT id) AS n FROM {table}").first()["n"] == upto
            q.stop()
        assert sinks.query_live(spark, "live_rows", "SELECT count(*) AS n FROM {table}").first()["n"] == 30
    finally:
        sinks.stop_all(spark)
        spark.sql("DROP TABLE IF EXISTS live_rows")
