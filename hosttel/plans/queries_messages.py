"""Catalogue entries for message framing, backlog, envelope and counts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock_text
from ..operators import messages as M
from ..sources.fixtures import PROC_SQL, proc
from .registry import register, with_views

K = M.MAIN_ROWS + M.LATE_ROWS
TRAIL = M.MEMORY_TRAIL

# process-like stream row carried in messages
ROW_COLS = ["sequence", "machine", "pid", "ts", "cmd", "state", "cpu", "tslpi"]
ROW_SCHEMA = T.StructType([
    T.StructField("sequence", T.LongType()), T.StructField("machine", T.IntegerType()),
    T.StructField("pid", T.LongType()), T.StructField("ts", T.LongType()),
    T.StructField("cmd", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("cpu", T.DoubleType()), T.StructField("tslpi", T.IntegerType()),
])

# DuckDB: framing, then the rows each message carries (on time + re-sent)
FRAMED_SQL = f"""framed AS (
  SELECT *, (row_number() OVER (PARTITION BY machine ORDER BY sequence) - 1) AS p FROM proc),
ticks AS (
  SELECT * EXCLUDE (p), CAST(p // {K} AS BIGINT) AS offset_id, (p % {K}) >= {M.MAIN_ROWS} AS is_late
  FROM framed)"""


def msg_sql(horizon: int | None = None) -> str:
    """CTEs ``ticks``, ``last_tick`` and ``msg``: the rows each message carries."""
    upto = "l.last" if horizon is None else f"least(l.last, t.offset_id + {int(horizon)})"
    return FRAMED_SQL + f""",
last_tick AS (SELECT max(offset_id) AS last FROM ticks),
msg AS (
  SELECT * EXCLUDE (is_late), offset_id AS origin_offset, false AS resent FROM ticks WHERE NOT is_late
  UNION ALL
  SELECT t.* EXCLUDE (is_late, offset_id), CAST(o.o AS BIGINT) AS offset_id, t.offset_id AS origin_offset,
         true AS resent
  FROM ticks t, last_tick l, unnest(range(t.offset_id + 1, {upto} + 1)) AS o(o)
  WHERE t.is_late)"""


def counts_sql(horizon: int | None = None) -> str:
    return msg_sql(horizon) + """,
counts AS (SELECT offset_id, machine, count(*) AS n FROM msg GROUP BY offset_id, machine)"""


MSG_SQL = msg_sql()
COUNTS_SQL = counts_sql()

# What the consumers' input fixture delivers: on-time rows once, held-back
# rows in each of the two messages after their own tick.
DELIVERED = 2
DELIVERED_SQL = FRAMED_SQL + f""",
msg AS (
  SELECT * EXCLUDE (is_late), offset_id AS origin_offset, false AS resent FROM ticks WHERE NOT is_late
  UNION ALL
  SELECT t.* EXCLUDE (is_late, offset_id), CAST(t.offset_id + o.o AS BIGINT) AS offset_id,
         t.offset_id AS origin_offset, true AS resent
  FROM ticks t, unnest(range(1, {DELIVERED} + 1)) AS o(o) WHERE t.is_late)"""
DELIVERED_COUNTS_SQL = DELIVERED_SQL + """,
counts AS (SELECT offset_id, machine, count(*) AS n FROM msg GROUP BY offset_id, machine)"""

PROC = with_views(PROC_SQL)


def _framed(spark, sf):
    return M.frame_ticks(proc(spark, sf), "machine", "sequence", M.MAIN_ROWS, M.LATE_ROWS)


def _last(spark, sf):
    return M.last_tick(proc(spark, sf), "machine", M.MAIN_ROWS, M.LATE_ROWS)


def _delivered(spark, sf):
    return M.deliveries(_framed(spark, sf), DELIVERED)


def _counts(spark, sf):
    return M.message_counts_sized(proc(spark, sf), _last(spark, sf))


@register("ticks", with_views(PROC_SQL, FRAMED_SQL) + """
SELECT machine, offset_id, count(*) AS n_rows, count_if(is_late) AS n_late,
       min(sequence) AS first_sequence, max(sequence) AS last_sequence
FROM ticks GROUP BY machine, offset_id""")
def q_ticks(spark, sf):
    """Per-machine slices of main + late rows."""
    return (_framed(spark, sf).groupBy("machine", "offset_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_late").alias("n_late"),
                 F.min("sequence").alias("first_sequence"), F.max("sequence").alias("last_sequence")))


@register("ticks_strict", with_views(PROC_SQL, FRAMED_SQL) + f""",
sized AS (SELECT *, count(*) OVER (PARTITION BY machine) AS n_m FROM ticks)
SELECT machine, offset_id, count(*) AS n_rows, count_if(is_late) AS n_late
FROM sized WHERE (offset_id + 1) * {K} < n_m GROUP BY machine, offset_id""")
def q_ticks_strict(spark, sf):
    """Slices kept only when rows remain after them, the replay's strict test."""
    f = M.frame_ticks(proc(spark, sf), "machine", "sequence", M.MAIN_ROWS, M.LATE_ROWS, strict=True)
    return (f.groupBy("machine", "offset_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("is_late").alias("n_late")))


@register("late_backlog", with_views(PROC_SQL, MSG_SQL) + """
SELECT * EXCLUDE (offset_id), min(offset_id) AS first_offset, max(offset_id) AS last_offset
FROM msg GROUP BY ALL""")
def q_late_backlog(spark, sf):
    """Every row with the first and the last message that carries it, held-back
    rows in all messages after their tick (J1, U1)."""
    return M.message_intervals(_framed(spark, sf), _last(spark, sf))


@register("message_counts", with_views(PROC_SQL, COUNTS_SQL) + "SELECT * FROM counts")
def q_message_counts(spark, sf):
    """Rows per machine per message (A10)."""
    return _counts(spark, sf)


def _wide_sql(msg: str) -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE machine = {m}) AS machine_{m}" for m in range(1, 6))
    return with_views(PROC_SQL, msg) + f"SELECT offset_id, {cols} FROM msg GROUP BY offset_id"


@register("message_counts_wide", _wide_sql(MSG_SQL))
def q_message_counts_wide(spark, sf):
    """One count column per machine, 0 when absent."""
    return M.message_counts_wide(_counts(spark, sf), M.machine_values(proc(spark, sf)))


def _packed(spark, sf):
    return M.pack_messages(_delivered(spark, sf), ROW_COLS)


@register("json_roundtrip", with_views(PROC_SQL, DELIVERED_SQL) + f"""
SELECT offset_id, CAST(row_number() OVER (PARTITION BY offset_id, machine ORDER BY sequence) - 1 AS INTEGER) AS pos,
       {", ".join(ROW_COLS)}
FROM msg""")
def q_json_roundtrip(spark, sf):
    """Messages packed as JSON arrays and decoded again."""
    return M.unpack_messages(_packed(spark, sf), ROW_SCHEMA)


@register("packed_counts_wide", _wide_sql(DELIVERED_SQL))
def q_packed_counts_wide(spark, sf):
    """Machine counts computed inside each packed record, then added up by message."""
    machines = M.machine_values(proc(spark, sf))
    per_record = M.packed_counts_wide(_packed(spark, sf), machines, ROW_SCHEMA)
    return per_record.groupBy("offset_id").agg(*[F.sum(f"machine_{m}").alias(f"machine_{m}") for m in machines])


@register("message_time", with_views(PROC_SQL, MSG_SQL) + """
SELECT offset_id, arg_min(ts, (machine, sequence)) AS ts,
       strftime(make_timestamp(arg_min(ts, (machine, sequence)) * 1000000), '%H:%M:%S') AS clock
FROM msg GROUP BY offset_id""")
def q_message_time(spark, sf):
    """Time of each message as clock text."""
    return M.message_start(_framed(spark, sf))


@register("clock_text", PROC + """
SELECT sequence, ts, strftime(make_timestamp(ts * 1000000), '%H:%M:%S') AS clock FROM proc""")
def q_clock_text(spark, sf):
    """Epoch seconds to HH:mm:ss in UTC for every row."""
    return proc(spark, sf).select("sequence", "ts", clock_text("ts").alias("clock"))


@register("trailing_counts", with_views(PROC_SQL, COUNTS_SQL) + f"""
SELECT * FROM counts WHERE offset_id > (SELECT max(offset_id) FROM counts) - {TRAIL}""")
def q_trailing_counts(spark, sf):
    """The last 16 messages of every machine's series."""
    return M.last_points(_counts(spark, sf), TRAIL, last=_last(spark, sf))


@register("trailing_window", with_views(PROC_SQL, COUNTS_SQL) + f"""
SELECT offset_id, machine,
       CAST(sum(n) OVER w AS BIGINT) AS window_sum, count(*) OVER w AS window_len
FROM counts
WINDOW w AS (PARTITION BY machine ORDER BY offset_id RANGE BETWEEN {TRAIL - 1} PRECEDING AND CURRENT ROW)""")
def q_trailing_window(spark, sf):
    """Running sum over the last 16 messages per machine, skew-safe."""
    return M.trailing_window(_counts(spark, sf), TRAIL)


@register("dedup_backlog", with_views(PROC_SQL, MSG_SQL) + """
SELECT machine, sequence, min(offset_id) AS first_offset, count(*) AS copies
FROM msg GROUP BY machine, sequence""")
def q_dedup_backlog(spark, sf):
    """One row per (machine, sequence) with first message and copies (ST5 twin)."""
    rows = M.message_intervals(_framed(spark, sf), _last(spark, sf))
    return rows.select("machine", "sequence", "first_offset",
                       (F.col("last_offset") - F.col("first_offset") + 1).alias("copies"))


@register("tumbling_counts", PROC + """
SELECT CAST(epoch(time_bucket(INTERVAL '1 day', make_timestamp(ts * 1000000))) AS BIGINT) AS window_start,
       CAST(epoch(time_bucket(INTERVAL '1 day', make_timestamp(ts * 1000000)) + INTERVAL '1 day') AS BIGINT) AS window_end,
       machine, count(*) AS n
FROM proc GROUP BY ALL""")
def q_tumbling_counts(spark, sf):
    """Rows per machine per one-day event-time window (ST4 twin)."""
    return M.tumbling_counts(proc(spark, sf), "ts", "1 day")


TIMES_SQL = """times AS (
  SELECT offset_id, strftime(make_timestamp(arg_min(ts, (machine, sequence)) * 1000000), '%H:%M:%S') AS clock
  FROM msg GROUP BY offset_id)"""
SERIES_SQL = f"""counts AS (SELECT offset_id, machine, count(*) AS n FROM msg GROUP BY offset_id, machine),
series AS (
  SELECT c.offset_id, t.clock, c.machine, c.n FROM counts c LEFT JOIN times t USING (offset_id)
  WHERE c.offset_id > (SELECT max(offset_id) FROM counts) - {TRAIL})"""


def _series(spark, sf):
    return M.count_series(_counts(spark, sf), M.message_start(_framed(spark, sf)), TRAIL, last=_last(spark, sf))


@register("count_series", with_views(PROC_SQL, MSG_SQL, TIMES_SQL, SERIES_SQL) + "SELECT * FROM series")
def q_count_series(spark, sf):
    """Chart data of the consumer: last 16 per-machine counts against message clock time (V6)."""
    return _series(spark, sf)


@register("series_extremes", with_views(PROC_SQL, MSG_SQL, TIMES_SQL, SERIES_SQL) + """
SELECT machine, max(n) AS max_n, min(n) AS min_n,
       format('Max: Time={}, Value={}', arg_max(clock, (n, -offset_id)), max(n)) AS max_label,
       format('Min: Time={}, Value={}', arg_min(clock, (n, offset_id)), min(n)) AS min_label
FROM series GROUP BY machine""")
def q_series_extremes(spark, sf):
    """Max/min annotations of each machine's series, first occurrence on ties."""
    return M.series_extremes(_series(spark, sf))


PROC_TRAIL = M.PROCESS_TRAIL
# process stream: every row on time (no held-back rows), 24-point series
PROC_TICKS_SQL = f"""pticks AS (
  SELECT *, CAST((row_number() OVER (PARTITION BY machine ORDER BY sequence) - 1) // {K} AS BIGINT) AS offset_id
  FROM proc),
pcounts AS (SELECT offset_id, machine, count(*) AS n FROM pticks GROUP BY offset_id, machine)"""


@register("process_trailing", with_views(PROC_SQL, PROC_TICKS_SQL) + f"""
SELECT offset_id, machine,
       CAST(sum(n) OVER w AS BIGINT) AS window_sum, count(*) OVER w AS window_len
FROM pcounts
WINDOW w AS (PARTITION BY machine ORDER BY offset_id RANGE BETWEEN {PROC_TRAIL - 1} PRECEDING AND CURRENT ROW)""")
def q_process_trailing(spark, sf):
    """Process-stream shape (no late rows, D20): per-message counts and the
    consumer's 24-point trailing window (A10, W1)."""
    rows = M.message_rows(_framed(spark, sf), backlog=False)
    return M.trailing_window(M.message_counts(rows), PROC_TRAIL)


# --- messages bounded in bytes ----------------------------------------------

MESSAGE_BYTES = 1500
TEXT_COLS = ["sequence", "machine", "pid", "ts", "cmd", "state", "tslpi"]
_TEXT_SQL = """concat('{"sequence":', sequence, ',"machine":', machine, CASE WHEN pid IS NULL THEN '' ELSE concat(',"pid":', pid) END,
         ',"ts":', ts, ',"cmd":"', cmd, '","state":"', state, '"', CASE WHEN tslpi IS NULL THEN '' ELSE concat(',"tslpi":', tslpi) END, '}')"""


@register("packed_bounded", with_views(PROC_SQL, DELIVERED_SQL) + f""",
texts AS (SELECT offset_id, machine, sequence, {_TEXT_SQL} AS t FROM msg),
placed AS (SELECT *, sum(strlen(t) + 1) OVER (PARTITION BY offset_id, machine ORDER BY sequence ROWS UNBOUNDED PRECEDING) - strlen(t) - 1 AS start,
                  max(strlen(t) + 1) OVER () AS biggest FROM texts),
parts AS (SELECT offset_id, machine, CAST(start // ({MESSAGE_BYTES} - biggest) AS BIGINT) AS part, sequence, t FROM placed)
SELECT offset_id, machine, part, count(*) AS n_rows, concat('[', string_agg(t, ',' ORDER BY sequence), ']') AS value, true AS fits
FROM parts GROUP BY offset_id, machine, part""")
def q_packed_bounded(spark, sf):
    """Messages of at most 1 500 bytes: a tick's rows of one machine over as many as they need."""
    packed = M.pack_bounded(_delivered(spark, sf), TEXT_COLS, MESSAGE_BYTES)
    return packed.select("*", (F.octet_length("value") <= MESSAGE_BYTES).alias("fits"))
