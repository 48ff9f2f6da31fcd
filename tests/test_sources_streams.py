"""Sources, envelope, streaming behaviour and the ML round trip."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hosttel.operators import messages as M
from hosttel.plans.queries_messages import ROW_COLS, ROW_SCHEMA
from hosttel.schemas import KAFKA_ENVELOPE, PROCESS_SCHEMA
from hosttel.sources import csv as C
from hosttel.sources import kafka as K
from hosttel.sources.fixtures import proc
from hosttel.streaming import decode as D
from hosttel.streaming import late as L
from hosttel.streaming import sinks

from conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="hosttel-test-")


def test_process_csv_by_position_and_permissive(spark):
    d = _tmp()
    path = os.path.join(d, "process_part1.csv")
    with open(path, "w") as f:
        f.write("a,b,c,d,e,f,g,h,i,j,k,l,m,n,o,p,q\n")  # header names ignored: schema by position
        f.write("10,1,0,2,0,0,0,120,0,1,S,0,S,0.5,<bash>,0,normal\n")
        f.write("oops,2,0,2,0,0,0,120,0,1,S,0,S,1.5,<sh>,1,ddos\n")
    df = C.read_telemetry_csv(spark, os.path.join(d, "process_*.csv"), PROCESS_SCHEMA)
    rows = df.orderBy("PID").collect()
    assert [r.ts for r in rows] == [10, None] and rows[1].type == "ddos"


def test_replay_csv_by_name(spark):
    d = _tmp()
    path = os.path.join(d, "replay.csv")
    with open(path, "w") as f:
        f.write("CMD,MEM,RGROW,VGROW,RSIZE,VSIZE,VSTEXT,MAJFLT,MINFLT,PID,machine,sequence\n")
        f.write("bash,1.9,0.0,2.7,4096.0,8192.5,12,0,33,77,3,5\n")
    r = C.read_memory_replay(spark, path).first()
    assert (r.sequence, r.machine, r.PID, r.MINFLT, r.VSIZE, r.MEM, r.CMD) == (5, 3, 77, 33, 8192, 1, "bash")


def test_envelope_has_kafka_shape(spark):
    p = proc(spark, SF_SMALL)
    packed = M.pack_messages(M.deliveries(M.frame_ticks(p)), ROW_COLS)
    env = K.to_envelope(packed, "t")
    assert [(f.name, f.dataType) for f in env.schema] == [(f.name, f.dataType) for f in KAFKA_ENVELOPE]


def _write_stream_input(spark, files):
    p = proc(spark, SF_SMALL)
    packed = M.pack_messages(M.deliveries(M.frame_ticks(p)), ROW_COLS)
    path = os.path.join(_tmp(), "in")
    K.write_envelope_files(K.to_envelope(packed, "t"), path, files)
    return path


def test_batch_stream_equivalence(spark):
    path = _write_stream_input(spark, 4)
    batch = D.decode_rows(spark.read.schema(KAFKA_ENVELOPE).parquet(path), ROW_SCHEMA)
    base = _tmp()
    stream = sinks.run_to_parquet(D.decode_rows(K.read_envelope_stream(spark, path), ROW_SCHEMA),
                                  f"{base}/out", f"{base}/chk")
    cols = ["offset", "pos"] + ROW_COLS
    assert batch.select(cols).exceptAll(stream.select(cols)).count() == 0
    assert stream.count() == batch.count()


def test_watermark_drops_late_copies(spark):
    # one file per message, one file per micro-batch: re-sent rows fall behind the watermark
    path = _write_stream_input(spark, None)
    env = spark.read.schema(KAFKA_ENVELOPE).parquet(path)
    # one Parquet file per message, appended in offset order
    stream_in = os.path.join(_tmp(), "ordered")
    for o in sorted(r[0] for r in env.select("offset").distinct().collect()):
        env.where(F.col("offset") == o).coalesce(1).write.mode("append").parquet(stream_in)
    rows = L.with_event_time(D.decode_rows(K.read_envelope_stream(spark, stream_in, 1), ROW_SCHEMA), "ts")
    q = sinks.to_memory(L.drop_repeats(rows, ["machine", "sequence"], delay="1 hour"), "dedup_t",
                        available_now=True)
    q.awaitTermination()
    out = spark.table("dedup_t")
    # no key is emitted twice; late copies were dropped, never duplicated
    assert out.groupBy("machine", "sequence").count().where("count > 1").count() == 0
    assert L.dropped_by_watermark(q) > 0


def test_stream_counts_equal_batch_counts(spark):
    path = _write_stream_input(spark, 3)
    base = _tmp()
    stream = sinks.run_to_parquet(D.message_counts_long(K.read_envelope_stream(spark, path), ROW_SCHEMA),
                                  f"{base}/out", f"{base}/chk")
    p = proc(spark, SF_SMALL)
    batch = M.message_counts(M.deliveries(M.frame_ticks(p)))
    assert stream.select("offset_id", "machine", "n").exceptAll(batch).count() == 0
    assert batch.count() == stream.count()


def test_kafka_reader_options(spark, monkeypatch):
    """The option map handed to the connector (absent here)."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "frame"

    class Session:
        readStream = Reader()

    K.read_kafka(Session(), "broker:9092", "topic_a", starting_offsets="earliest")
    assert seen["format"] == "kafka" and seen["kafka.bootstrap.servers"] == "broker:9092"
    assert seen["subscribe"] == "topic_a" and seen["startingOffsets"] == "earliest"


@pytest.mark.parametrize("name", ["stream_decode_counts", "stream_counts_batched", "stream_counts_wide",
                                  "stream_dedup", "stream_window", "stream_trailing"])
def test_streams_do_not_depend_on_batches(spark, name, monkeypatch):
    """One file per micro-batch gives the result of a single batch."""
    from hosttel.plans import queries_streams as Q
    from hosttel.plans.registry import QUERIES
    whole = QUERIES[name](spark, SF_SMALL)
    monkeypatch.setattr(Q, "FILES_PER_TRIGGER", 1)
    pieces = QUERIES[name](spark, SF_SMALL).select(*whole.columns)
    assert whole.exceptAll(pieces).count() == 0 and pieces.exceptAll(whole).count() == 0
    assert whole.count() > 0


def test_model_save_load_same_predictions(spark):
    from hosttel.plans import pipelines as PL
    from hosttel.plans.queries_models import PROC_SPEC, _model_input
    data = _model_input(spark, SF_SMALL)
    path = os.path.join(_tmp(), "m")
    model = PL.final_model(data, PROC_SPEC, path, kind="dt")
    a = PL.predict(model, data, PROC_SPEC).select("sequence", "prediction")
    b = PL.predict(PL.load_model(path), data, PROC_SPEC).select("sequence", "prediction")
    assert a.exceptAll(b).count() == 0 and a.count() > 0


def test_stream_to_table_is_sql_readable(spark):
    path = _write_stream_input(spark, 2)
    counts = D.message_counts_long(K.read_envelope_stream(spark, path), ROW_SCHEMA)
    q = sinks.to_table(counts, "stream_counts_t", os.path.join(_tmp(), "chk"), available_now=True)
    q.awaitTermination()
    n = spark.sql("SELECT count(*) AS c, sum(n) AS s FROM stream_counts_t").first()
    p = proc(spark, SF_SMALL)
    exp = M.message_counts(M.deliveries(M.frame_ticks(p))).agg(F.count("*"), F.sum("n")).first()
    assert (n.c, n.s) == (exp[0], exp[1])
    spark.sql("DROP TABLE stream_counts_t")


def test_memory_sink_query_by_name_and_settings(spark):
    from hosttel.session import REFERENCE_SPLIT_BYTES, apply_reference_settings
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        apply_reference_settings(spark)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") in (str(REFERENCE_SPLIT_BYTES),
                                                                        f"{REFERENCE_SPLIT_BYTES}b")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    path = _write_stream_input(spark, 2)
    q = sinks.to_memory(D.message_counts_long(K.read_envelope_stream(spark, path), ROW_SCHEMA),
                        "counts_by_name", available_now=True)
    q.awaitTermination()
    assert sinks.query_by_name(spark, "counts_by_name").count() > 0
    sinks.stop_all(spark)
    assert not spark.streams.active


def test_trailing_counts_across_many_batches_equal_batch(spark):
    from hosttel.streaming import trailing as TR
    p = proc(spark, SF_SMALL)
    env = K.to_envelope(M.pack_messages(M.deliveries(M.frame_ticks(p)), ROW_COLS), "t")
    stream_in = os.path.join(_tmp(), "reversed")
    # newest messages first: late counts have to revise windows
    for o in sorted((r[0] for r in env.select("offset").distinct().collect()), reverse=True):
        env.where(F.col("offset") == o).coalesce(1).write.mode("append").parquet(stream_in)
    counts = D.message_counts_long(K.read_envelope_stream(spark, stream_in, 1), ROW_SCHEMA)
    base = _tmp()
    q = TR.write_trailing_counts(counts, 5, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3          # really ran as several micro-batches
    got = TR.read_trailing_counts(spark, f"{base}/out")
    exp = M.trailing_window(M.message_counts(M.deliveries(M.frame_ticks(p))), 5)
    cols = ["offset_id", "machine", "window_sum", "window_len"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert exp.count() == got.count()


def test_console_sink_processing_time_trigger(spark, capsys):
    path = _write_stream_input(spark, 2)
    counts = D.message_counts_long(K.read_envelope_stream(spark, path), ROW_SCHEMA)
    q = sinks.to_console(counts, "console_counts", trigger="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive and q.name == "console_counts"
        assert q.lastProgress is not None and q.lastProgress["numInputRows"] >= 0
    finally:
        q.stop()
    assert not q.isActive


def test_process_replay_reads_tslpu_from_its_column(spark):
    d = _tmp()
    path = os.path.join(d, "proc_replay.csv")
    with open(path, "w") as f:
        f.write("sequence,machine,PID,TRUN,TSLPI,TSLPU,POLI,NICE,PRI,RTPR,CPUNR,Status,EXC,State,CPU,CMD\n")
        f.write("41,2,900,1,3,7,norm,0,120,0,1,N,0,S,12.9,<sshd>\n")
        f.write("42,2,901,x,3,8,norm,0,120,0,1,N,0,S,-0.5,<sh>\n")
    rows = C.read_process_replay(spark, path).orderBy("sequence").collect()
    assert [r.TSLPU for r in rows] == [7, 8]            # not the sequence number
    assert [r.CPU for r in rows] == [12, 0]             # int(float(x)) truncates toward zero
    assert rows[1].TRUN is None and rows[0].CMD == "<sshd>"


def test_watermark_on_ntz_events_stream(spark):
    # events.ts is TIMESTAMP_NTZ: a watermark needs TIMESTAMP, which with_event_time provides
    src = os.path.join(_tmp(), "events")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.parquet(src)   # a file stream reads folders
    schema = spark.read.parquet(src).schema
    stream = spark.readStream.schema(schema).parquet(src)
    rows = L.with_event_time(stream.withColumn("machine", (F.col("user_id") % 5 + 1).cast("int")), "ts")
    base = _tmp()
    out = sinks.run_to_parquet(L.windowed_counts(rows, "event_time", "1 day", "1 day"),
                               f"{base}/out", f"{base}/chk")
    batch = spark.read.parquet(src).withColumn("machine", (F.col("user_id") % 5 + 1).cast("int"))
    exp = M.tumbling_counts(batch.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day")
    last = batch.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    cutoff = int(last.replace(tzinfo=__import__("datetime").timezone.utc).timestamp()) - 86400
    exp = exp.where(F.col("window_end") <= cutoff)
    assert out.exceptAll(exp).count() == 0 and exp.exceptAll(out).count() == 0
    assert out.count() > 0


def test_kafka_batch_reads_a_bounded_range():
    """The finite drain of a topic (S5): both ends are named, nothing is streamed."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, k, v):
            seen[k] = v
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    assert K.read_kafka_batch(Session(), "broker:9092", "topic_a") == "rows"
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "broker:9092", "subscribe": "topic_a",
                    "startingOffsets": "earliest", "endingOffsets": "latest"}


def test_machine_list_is_bounded(spark):
    df = spark.range(30).selectExpr("id % 7 AS machine")
    assert M.machine_values(df) == list(range(7))
    with pytest.raises(ValueError, match="long form"):
        M.machine_values(df, limit=6)
