"""Catalogue entries for Structured Streaming (ST1–ST8, S4–S9).

Input: the messages of ``queries_messages`` (derived by Spark from the
driver tables) written as Parquet files with the Kafka record envelope; a
file stream reads them like a Kafka topic. Each query drains the stream
with ``availableNow`` into an exactly-once Parquet sink under the shared
checkpoint folder and returns that table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import size_to_long, strip_brackets
from ..operators import messages as M
from ..operators import metrics as MT
from ..sources import kafka as K
from ..schemas import MEMORY_STREAM_ROW
from ..sources.fixtures import MEM_SQL, PROC_SQL, mem, proc
from ..session import scratch_path
from ..streaming import decode as D
from ..streaming import late as L
from ..streaming import repeats as RP
from ..streaming import score as SC
from ..streaming import sinks
from ..streaming import trailing as TR
from . import pipelines as PL
from .queries_batch import _ZERO
from .registry import register, with_views
from .queries_messages import (DELIVERED_COUNTS_SQL, DELIVERED_SQL, ROW_COLS, ROW_SCHEMA, TRAIL,
                               _delivered, _packed, _wide_sql)
from .queries_models import PROC_SPEC, _model_input

TOPIC = "telemetry_process"
PROC = with_views(PROC_SQL)


def _run_dir(spark, name: str) -> str:
    return scratch_path(spark, f"streams/{name}-{uuid.uuid4().hex[:12]}")


#: Files a micro-batch reads; None: all there are. No result depends on it.
FILES_PER_TRIGGER: int | None = None


def _dealt_stream(spark, path: str, files_per_trigger: int | None):
    """The written messages as a stream, over as many tasks as their text needs."""
    env = K.read_envelope_stream(spark, path, files_per_trigger)
    return K.deal_messages(env, K.message_tasks(spark.read.parquet(path)))


def _envelope_stream(spark, sf, base: str):
    path = f"{base}/in"
    K.write_envelope_files(K.to_envelope(_packed(spark, sf), TOPIC), path)
    return _dealt_stream(spark, path, FILES_PER_TRIGGER)


def _replay_delay(spark, sf) -> str:
    """Watermark delay under which no row of a replay is late: files come in
    no order, so the time span of the whole table."""
    low, high = proc(spark, sf).agg(F.min("ts"), F.max("ts")).first()
    return f"{(high or 0) - (low or 0) + 1} seconds"


def _rows(spark, sf, base: str):
    return L.with_event_time(D.decode_rows(_envelope_stream(spark, sf, base), ROW_SCHEMA), "ts")


def _unique_rows(spark, sf, base: str):
    return L.drop_repeats(_rows(spark, sf, base), ["machine", "sequence"], delay=_replay_delay(spark, sf))


def _each_unique(spark, sf, base: str, each) -> None:
    """Drain the stream without its repeats, without state, into ``each``."""
    q = RP.write_unique(_rows(spark, sf, base), ["machine", "sequence"], f"{base}/unique", f"{base}/chk", available_now=True, each=each)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _drain(df, base: str, name: str):
    return sinks.run_to_parquet(df, f"{base}/out", f"{base}/chk", name)


@register("stream_decode_counts", with_views(PROC_SQL, DELIVERED_COUNTS_SQL) + "SELECT * FROM counts")
def q_stream_decode_counts(spark, sf):
    """Decode each message and count rows per machine inside it (ST2, ST3)."""
    base = _run_dir(spark, "decode_counts")
    env = _envelope_stream(spark, sf, base)
    return _drain(D.message_counts_long(env, ROW_SCHEMA), base, None)


@register("stream_counts_batched", with_views(PROC_SQL, DELIVERED_COUNTS_SQL) + "SELECT * FROM counts")
def q_stream_counts_batched(spark, sf):
    """Per-message counts by a batch aggregation inside ``foreachBatch``,
    idempotent per batch id (ST3, wide-fleet form)."""
    base = _run_dir(spark, "counts_batched")
    env = _envelope_stream(spark, sf, base)
    q = D.write_message_counts(env, ROW_SCHEMA, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("offset_id", "machine", "n")


@register("stream_counts_wide", _wide_sql(DELIVERED_SQL))
def q_stream_counts_wide(spark, sf):
    """Per-message counts, one column per machine, 0 when absent (ST3, A11)."""
    base = _run_dir(spark, "counts_wide")
    machines = M.machine_values(proc(spark, sf))
    env = _envelope_stream(spark, sf, base)
    per_record = _drain(D.message_counts_wide(env, machines, ROW_SCHEMA), base, None)
    return per_record.groupBy("offset_id").agg(*[F.sum(f"machine_{m}").alias(f"machine_{m}") for m in machines])


@register("stream_dedup", PROC + f"SELECT {', '.join(ROW_COLS)} FROM proc")
def q_stream_dedup(spark, sf):
    """Repeated rows removed within the watermark: every row once (ST5)."""
    base = _run_dir(spark, "dedup")
    return _drain(_unique_rows(spark, sf, base).select(*ROW_COLS), base, None)


@register("stream_window", PROC + """
SELECT CAST(floor(ts / 86400) * 86400 AS BIGINT) AS window_start,
       CAST(floor(ts / 86400) * 86400 AS BIGINT) + 86400 AS window_end, machine, count(*) AS n
FROM proc GROUP BY ALL""")
def q_stream_window(spark, sf):
    """De-duplicated rows per machine per day, all windows (ST4)."""
    base = _run_dir(spark, "window")
    _each_unique(spark, sf, base, lambda new, batch: L.window_parts(new).write.mode("overwrite").parquet(f"{base}/out/batch={batch}"))
    return L.read_window_counts(spark, f"{base}/out")


@register("stream_trailing", with_views(PROC_SQL, DELIVERED_COUNTS_SQL) + f"""
SELECT offset_id, machine,
       CAST(sum(n) OVER w AS BIGINT) AS window_sum, count(*) OVER w AS window_len
FROM counts
WINDOW w AS (PARTITION BY machine ORDER BY offset_id RANGE BETWEEN {TRAIL - 1} PRECEDING AND CURRENT ROW)""")
def q_stream_trailing(spark, sf):
    """Sum of the last 16 counts per machine, batch by batch (ST6)."""
    base = _run_dir(spark, "trailing")
    counts = D.message_counts_long(_envelope_stream(spark, sf, base), ROW_SCHEMA)
    q = TR.write_trailing_counts(counts, TRAIL, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    return TR.read_trailing_counts(spark, f"{base}/out")


@register("stream_score", with_views(PROC_SQL) + "SELECT machine, sequence, true AS same FROM proc")
def q_stream_score(spark, sf):
    """Live rows scored with a saved model (ST7, S11): every row gets the
    probability that batch scoring gives it."""
    base = _run_dir(spark, "score")
    model_path = f"{base}/model"
    data = _model_input(spark, sf)
    model = PL.final_model(data, PROC_SPEC, model_path, kind="dt", key="sequence")
    saved = PL.load_model(model_path)

    def score(new, batch):
        rows = new.withColumn("cmd", strip_brackets("cmd"))
        SC.score_stream(rows, saved, ["machine", "sequence"]).write.mode("overwrite").parquet(f"{base}/out/batch={batch}")

    _each_unique(spark, sf, base, score)
    scored = spark.read.parquet(f"{base}/out")
    batch = PL.predict(model, data, PROC_SPEC).select(
        "machine", "sequence", MT.class_probability("probability", 1).alias("p_batch"))
    live = scored.select("machine", "sequence", F.col("p_attack").alias("p_live"))
    return live.join(batch, ["machine", "sequence"], "left").select(
        "machine", "sequence", (F.col("p_live") == F.col("p_batch")).alias("same"))


# --- bounded state, late rows, unreadable messages, live tables ----------------

@register("stream_unique", PROC + f"SELECT {', '.join(ROW_COLS)} FROM proc")
def q_stream_unique(spark, sf):
    """Repeated rows removed without streaming state, over several batches:
    key tables behind a Bloom filter (ST5). Every row once."""
    base = _run_dir(spark, "unique")
    K.write_envelope_files(K.to_envelope(_packed(spark, sf), TOPIC), f"{base}/in", files=6)
    rows = D.decode_rows(_dealt_stream(spark, f"{base}/in", 2), ROW_SCHEMA).select(*ROW_COLS)
    q = RP.write_unique(rows, ["machine", "sequence"], f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    return RP.read_unique(spark, f"{base}/out")


# Rows arrive in four steps: thirds of the time span, then every tenth row, held back until the end.
STEPS, STEP_FILES, DELAY_SECONDS = 4, 4, 86_400
_STEP_SQL = """steps AS (
  SELECT p.*, CASE WHEN sequence % 10 = 3 THEN 3 ELSE least(2, 3 * (ts - low) // (high - low + 1)) END AS step
  FROM proc AS p, (SELECT min(ts) AS low, max(ts) AS high FROM proc))"""


def _stepped(spark, sf, path: str):
    """The steps as files that a stream reads one step after the other."""
    rows = proc(spark, sf).select(*ROW_COLS)
    span = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    third = F.floor(3 * (F.col("ts") - span["low"]) / (span["high"] - span["low"] + 1))
    step = F.when(F.col("sequence") % 10 == 3, 3).otherwise(F.least(F.lit(2), third))
    for i in range(STEPS):
        rows.where(step == i).repartition(STEP_FILES).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", STEP_FILES).parquet(path)


@register("stream_window_late", with_views(PROC_SQL, _STEP_SQL) + f""",
mark AS (SELECT max(ts) - {DELAY_SECONDS} AS watermark FROM steps WHERE step <= 1),
windows AS (SELECT CAST(ts // 86400 * 86400 AS BIGINT) AS window_start, machine, step FROM steps)
SELECT window_start, window_start + 86400 AS window_end, machine,
       count_if(step < 3 OR window_start + 86400 > watermark) AS n,
       count_if(step = 3 AND window_start + 86400 <= watermark) AS dropped
FROM windows, mark GROUP BY window_start, machine""")
def q_stream_window_late(spark, sf):
    """Window totals in update mode, revised batch by batch under a watermark,
    with the rows that came too late counted beside them (ST4)."""
    base = _run_dir(spark, "window_late")
    rows = L.with_event_time(_stepped(spark, sf, f"{base}/in"), "ts")
    for q in (L.write_window_revisions(rows, f"{base}/revisions", f"{base}/chk1", delay=f"{DELAY_SECONDS} seconds", available_now=True),
              L.write_window_counts(rows, f"{base}/received", f"{base}/chk2", available_now=True)):
        q.awaitTermination()
    return L.read_window_revisions(spark, f"{base}/revisions", f"{base}/received")


@register("stream_refused", with_views(PROC_SQL, DELIVERED_SQL) + """,
packed AS (SELECT offset_id, machine, count(*) AS n FROM msg GROUP BY offset_id, machine),
kinds AS (SELECT offset_id, n, (offset_id * 5 + machine) % 11 AS kind FROM packed)
SELECT offset_id, CAST(sum(CASE WHEN kind IN (1, 2, 3) THEN 0 WHEN kind = 4 THEN n + 1 ELSE n END) AS BIGINT) AS n_received,
       CAST(sum(CASE WHEN kind IN (1, 2, 3) THEN 0 ELSE n END) AS BIGINT) AS n_decoded,
       count_if(kind = 4) AS n_refused, count_if(kind = 1) AS no_value, count_if(kind = 2) AS not_json,
       count_if(kind = 3) AS not_array, count_if(kind = 4) AS not_objects, count(*) AS messages
FROM kinds GROUP BY offset_id""")
def q_stream_refused(spark, sf):
    """Messages that cannot be read go to a table of their own, with the
    reason; rows decoded and refused add up to rows received (ST2)."""
    base = _run_dir(spark, "refused")
    kind = (F.col("offset_id") * 5 + F.col("machine")) % 11
    value = F.col("value")
    broken = (F.when(kind == 1, F.lit(None).cast("string")).when(kind == 2, F.expr("left(value, length(value) - 5)"))
              .when(kind == 3, F.lit('{"error": "agent down"}')).when(kind == 4, F.concat(F.lit("[17,"), F.substring(value, 2, 1 << 30)))
              .otherwise(value))
    packed = M.pack_messages(_delivered(spark, sf), ROW_COLS, by=["machine"], keep_by=True)
    K.write_envelope_files(K.to_envelope(packed.withColumn("value", broken), TOPIC), f"{base}/in")
    env = K.read_envelope_stream(spark, f"{base}/in", FILES_PER_TRIGGER)
    q = D.write_decoded(env, ROW_SCHEMA, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/out/rows").groupBy("offset_id").agg(F.count(F.lit(1)).alias("n_decoded"))
    counts = spark.read.parquet(f"{base}/out/counts").groupBy("offset_id").agg(
        F.sum("n_received").alias("n_received"), F.sum("n_refused").alias("n_refused"), F.count(F.lit(1)).alias("messages"))
    reasons = {"no_value": "no value", "not_json": "not JSON", "not_array": "not an array", "not_objects": "rows are not objects"}
    refused = spark.read.parquet(f"{base}/out/refused").groupBy("offset_id").agg(
        *[F.count_if(F.col("reason") == r).alias(c) for c, r in reasons.items()])
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return (counts.join(rows, "offset_id", "left").join(refused, "offset_id", "left")
            .select("offset_id", "n_received", zero("n_decoded"), "n_refused", *[zero(c) for c in reasons], "messages"))


@register("stream_live_sql", with_views(PROC_SQL, _STEP_SQL) + """
SELECT s.phase, machine, count(*) AS n, max(cpu) AS peak_cpu
FROM (VALUES ('running', 1), ('restarted', 3)) AS s(phase, upto) JOIN steps ON step <= upto GROUP BY s.phase, machine""")
def q_stream_live_sql(spark, sf):
    """SQL over a table that a stream is writing: once while it runs, half of
    the rows in, and again after a restart from its checkpoint (S8, ST8)."""
    base = _run_dir(spark, "live")
    name = f"live_{uuid.uuid4().hex[:12]}"
    rows = proc(spark, sf).select("sequence", "machine", "ts", "cpu")
    span = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    third = F.floor(3 * (F.col("ts") - span["low"]) / (span["high"] - span["low"] + 1))
    early = (F.col("sequence") % 10 != 3) & (third <= 1)
    found = []
    for phase, part in (("running", rows.where(early)), ("restarted", rows.where(~early))):
        part.write.mode("append").parquet(f"{base}/in")
        query = sinks.to_table(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), name, f"{base}/chk", path=f"{base}/table")
        try:
            query.processAllAvailable()
            live = sinks.query_live(spark, name, "SELECT machine, count(*) AS n, max(cpu) AS peak_cpu FROM {table} GROUP BY machine")
            snapshot = f"{base}/{phase}"
            live.select(F.lit(phase).alias("phase"), "*").write.parquet(snapshot)  # the table grows on
            if not query.isActive:
                raise query.exception() or RuntimeError("the stream ended")
        finally:
            query.stop()
        found.append(spark.read.parquet(snapshot))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return found[0].unionByName(found[1])


MEM_TOPIC = "telemetry_memory"
PACK_ROWS = 500_000  # that one task packs, about
_MEMORY_SQL = f"""rows_m AS (
  SELECT CAST(pid * 8 + seq AS BIGINT) AS sequence, CAST(pid % 5 + 1 AS INTEGER) AS machine, CAST(pid AS INTEGER) AS "PID",
         CAST(minflt AS BIGINT) AS "MINFLT", CASE WHEN regexp_full_match({_ZERO.format(c='rsize')}, '[0-9]+') THEN CAST({_ZERO.format(c='rsize')} AS BIGINT) END AS "RSIZE",
         rtrim(ltrim(cmd, '<'), '>') AS "CMD", CAST(pid * 8 + seq AS BIGINT) AS ts
  FROM mem)"""


def _memory_rows(spark, sf):
    """Rows as the memory topic carries them, all columns of its schema."""
    m = mem(spark, sf)
    own = {"sequence": F.expr("CAST(pid * 8 + seq AS BIGINT)"), "machine": F.expr("CAST(pid % 5 + 1 AS INT)"),
           "PID": F.col("pid").cast("int"), "MINFLT": F.col("minflt").cast("bigint"),
           "RSIZE": size_to_long("rsize"), "VSIZE": size_to_long("vsize"), "CMD": strip_brackets("cmd"),
           "ts": F.expr("CAST(pid * 8 + seq AS BIGINT)")}
    return m.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MEMORY_STREAM_ROW.fields])


@register("stream_memory_rows", with_views(MEM_SQL, _MEMORY_SQL) + """
SELECT sequence // 4096 AS offset_id, machine, count(*) AS n, CAST(sum("MINFLT") AS BIGINT) AS minflt, count("RSIZE") AS readable,
       count(DISTINCT "CMD") AS commands
FROM rows_m GROUP BY 1, 2""")
def q_stream_memory_rows(spark, sf):
    """The memory topic's stream: rows of its full schema packed, decoded and
    counted per machine and message (ST2, ST3 for the second topic)."""
    base = _run_dir(spark, "memory_rows")
    rows = _memory_rows(spark, sf).withColumn("offset_id", F.expr("sequence DIV 4096"))
    names = [f.name for f in MEMORY_STREAM_ROW.fields]
    tasks = -(-rows.count() // PACK_ROWS)
    if tasks <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        tasks = None
    K.write_envelope_files(K.to_envelope(M.pack_messages(rows, names, tasks=tasks), MEM_TOPIC), f"{base}/in")
    env = K.read_envelope_stream(spark, f"{base}/in", FILES_PER_TRIGGER)
    q = D.write_decoded(env, MEMORY_STREAM_ROW, f"{base}/out", f"{base}/chk", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out/rows").groupBy("offset_id", "machine").agg(
        F.count(F.lit(1)).alias("n"), F.sum("MINFLT").alias("minflt"), F.count("RSIZE").alias("readable"),
        F.count_distinct("CMD").alias("commands"))
