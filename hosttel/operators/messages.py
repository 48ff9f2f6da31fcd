"""Message framing and per-message counts.

The reference replays telemetry as timed messages: each tick sends, per
machine, the next slice of that machine's rows (W2), holds back a few more
rows of the slice (W3) and re-sends *every* held-back row of earlier ticks
in every later tick (J1). A consumer counts rows per machine per message
(A10/A11) and keeps the last N counts (W1).

Here the same shapes are relational:

* ``frame_ticks``   — per-machine position from the skew-safe ordinal, then
  ``offset_id = (rn-1) div k`` and a late flag for the held-back part.
* ``message_rows``  — the rows each message carries, long form: on-time rows
  of tick *t* plus late rows of earlier ticks, produced by exploding each
  late row over the ticks that re-send it (``sequence(tick+1, last)``); no
  join, no pairs. ``horizon`` bounds how long a row is re-sent.
* ``pack_messages`` / ``unpack_messages`` — JSON-array envelope and back.
* counts in long form (a shuffle on ``(offset_id, machine)``), wide form per
  message without a shuffle (``size(filter(rows, r -> r.machine = m))``).
* trailing windows by exploding each count to the ``N`` offsets whose
  window contains it, then aggregating on ``(machine, offset)`` — a hash
  aggregate with no hot partition, unlike a window partitioned by machine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import clock_text, max_label, min_label
from ..session import checkpointed
from .ordinal import ordinal, prefix_sums

# fixed framing defaults: rows per machine per tick sent on time, and rows
# held back per machine per tick (the reference draws 20–80 and 0–5 at
# random; these are the rounded midpoints)
MAIN_ROWS = 50
LATE_ROWS = 3
# trailing series length kept by the memory and process consumers
MEMORY_TRAIL = 16
PROCESS_TRAIL = 24


def frame_ticks(df: DataFrame, machine: str = "machine", order: str = "sequence",
                main: int = MAIN_ROWS, late: int = LATE_ROWS, strict: bool = False,
                offset: str = "offset_id") -> DataFrame:
    """Assign each row its tick (W2) and whether it is held back.

    Per machine, rows in ``order`` are cut into consecutive slices of
    ``main + late`` rows; slice *t* is tick ``offset``; the last ``late`` rows
    of a slice are flagged ``is_late``. With ``strict=True`` a slice is kept
    only if rows remain after it (the reference's ``start + n < len`` test);
    by default every row is framed.
    """
    k = main + late
    if k <= 0:
        raise ValueError("main + late must be positive")
    r = ordinal(df, [order], [machine], name="_rn", group_size="_n")
    pos = F.col("_rn") - 1
    out = (r.withColumn(offset, F.floor(pos / F.lit(k)).cast("bigint"))
           .withColumn("is_late", (pos % F.lit(k)) >= F.lit(main)))
    if strict:
        out = out.where((F.col(offset) + 1) * F.lit(k) < F.col("_n"))
    return out.drop("_rn", "_n")


def last_tick(df: DataFrame, machine: str = "machine", main: int = MAIN_ROWS,
              late: int = LATE_ROWS, strict: bool = False) -> int:
    """The last tick number ``frame_ticks`` will produce, from per-machine row
    counts alone (a partial aggregate over the machine column; no framing
    pass). -1 when there are no rows."""
    k = main + late
    n_max = df.groupBy(machine).count().agg(F.max("count")).first()[0]
    if not n_max:
        return -1
    if strict:                       # kept slices t satisfy (t + 1)·k < n
        return max(-(-n_max // k) - 2, -1)
    return (n_max - 1) // k


def message_rows(framed: DataFrame, offset: str = "offset_id", horizon: int | None = None,
                 backlog: bool = True, last: int | None = None) -> DataFrame:
    """Rows carried by each message, long form (J1 + U1).

    On-time rows travel in their own tick. A held-back row of tick *k* is
    first sent at tick *k+1* and re-sent in every later tick up to the last
    tick (or ``k + horizon``). Output columns: the row, ``offset`` = message
    id, ``origin_offset`` = the row's own tick, ``resent`` flag.
    ``backlog=False`` gives the process stream's shape (every row on time).

    Size: without a horizon (the reference) the copies grow with the square
    of the number of ticks; with ``horizon=H`` each held-back row has at most
    ``H`` copies, so the output is linear in the input.

    ``last`` is the last tick; pass ``last_tick(...)`` of the unframed rows to
    avoid a second framing pass (otherwise it is read from ``framed``).
    """
    if not backlog:
        return (framed.withColumn("origin_offset", F.col(offset))
                .withColumn("resent", F.lit(False)).drop("is_late"))
    # one number: the last tick, computed once and inlined as a literal
    last_val = framed.agg(F.max(offset)).first()[0] if last is None else last
    last = F.lit(-1 if last_val is None else int(last_val)).cast("bigint")
    upto = last if horizon is None else F.least(last, F.col(offset) + F.lit(int(horizon)))
    # one pass: each row is exploded over the messages that carry it
    resent = F.when(F.col(offset) < upto, F.sequence(F.col(offset) + 1, upto)) \
        .otherwise(F.array().cast(T.ArrayType(T.LongType())))
    targets = F.when(F.col("is_late"), resent).otherwise(F.array(F.col(offset)))
    return (framed.withColumn("origin_offset", F.col(offset)).withColumn("resent", F.col("is_late"))
            .withColumn(offset, F.explode(targets)).drop("is_late"))


def message_intervals(framed: DataFrame, last: int, offset: str = "offset_id") -> DataFrame:
    """Rows of all messages in interval form (J1 + U1): ``first_offset`` and
    ``last_offset`` of the messages that carry a row, one output row per row.

    An on-time row travels in its own tick only; a held-back row of tick *t*
    in every message from *t + 1* to the last. Rows held back in the last tick
    are never sent and have no interval. Same information as
    ``message_rows(horizon=None)``, whose copies grow with the square of the
    stream length.
    """
    late = F.col("is_late")
    return (framed.withColumn("first_offset", F.when(late, F.col(offset) + 1).otherwise(F.col(offset)))
            .withColumn("last_offset", F.when(late, F.lit(int(last)).cast("bigint")).otherwise(F.col(offset)))
            .where(F.col("first_offset") <= F.col("last_offset"))
            .withColumnRenamed(offset, "origin_offset").withColumnRenamed("is_late", "resent"))


def message_counts_sized(df: DataFrame, last: int, machine: str = "machine", main: int = MAIN_ROWS,
                         late: int = LATE_ROWS, offset: str = "offset_id", name: str = "n",
                         chunk: int = 4096) -> DataFrame:
    """Rows per machine per message with unbounded re-sending (A10), exact,
    from the machines' row counts alone.

    Framing cuts a machine's ``n`` rows into slices of ``main + late``, all
    full but the last. So message *t* carries ``min(main, n - t·k)`` on-time
    rows of the slice and ``late`` held-back rows of each earlier slice; after
    a machine's last slice all its held-back rows stay. One partial aggregate,
    then one output row per (machine, message); ticks are spread in chunks, so
    a hot machine's series is made by many tasks.
    """
    k = main + late
    n, t = F.col("_n"), F.col(offset)
    sized = (df.groupBy(machine).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_own", F.floor((n - 1) / F.lit(k)).cast("bigint")))
    if last < 0:
        return sized.select(F.lit(0).cast("bigint").alias(offset), machine, n.alias(name)).where(F.lit(False))
    chunks = sized.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(int(last) // chunk))))
    if last >= chunk:
        chunks = chunks.repartition("_c", machine)
    ticks = chunks.withColumn(offset, F.explode(F.sequence(
        F.col("_c").cast("bigint") * chunk,
        F.least(F.lit(int(last)).cast("bigint"), (F.col("_c").cast("bigint") + 1) * chunk - 1))))
    rest = F.greatest(F.lit(0), F.least(F.lit(late), n - F.col("_own") * k - main))
    on_time = F.when(t <= F.col("_own"), F.least(F.lit(main), n - t * k)).otherwise(0)
    held = F.when(t <= F.col("_own"), t * late).otherwise(F.col("_own") * late + rest)
    return ticks.select(offset, machine, (on_time + held).cast("bigint").alias(name)).where(F.col(name) > 0)


def message_start(framed: DataFrame, offset: str = "offset_id", machine: str = "machine",
                  order: str = "sequence", ts: str = "ts") -> DataFrame:
    """Time of each message with unbounded re-sending (A12, F11): ``ts`` of the
    first row, by ``order``, of the lowest machine in it.

    Of the held-back rows only the first one of each machine can be first in
    a message; it comes from the machine's first slice, so the lowest
    machine's is the same candidate for every message after tick 0: one
    scalar beside one partial aggregate of the on-time rows.
    """
    first = F.min(F.struct(machine, order, ts))
    on_time = framed.where(~F.col("is_late")).groupBy(offset).agg(first.alias("_on"))
    held = framed.where(F.col("is_late") & (F.col(offset) == 0)).agg(first.alias("_held")).scalar()
    return (on_time.withColumn("_first", F.when(F.col(offset) > 0, F.least("_on", held)).otherwise(F.col("_on")))
            .select(offset, F.col(f"_first.{ts}").alias("ts")).withColumn("clock", clock_text("ts")))


def deliveries(framed: DataFrame, times: int = 2, offset: str = "offset_id") -> DataFrame:
    """Input fixture for the consumers: rows as a broker delivers them, on-time
    rows once, held-back rows in each of the ``times`` messages after their
    own tick (so they arrive late and repeatedly). A property of this fixture;
    no consumer depends on it."""
    targets = F.when(F.col("is_late"), F.sequence(F.col(offset) + 1, F.col(offset) + F.lit(int(times)))) \
        .otherwise(F.array(F.col(offset)))
    return (framed.withColumn("origin_offset", F.col(offset)).withColumn("resent", F.col("is_late"))
            .withColumn(offset, F.explode(targets)).drop("is_late"))


def pack_messages(rows: DataFrame, row_cols: list[str], offset: str = "offset_id",
                  by: list[str] = ("machine",), order: list[str] = ("sequence",), keep_by: bool = False,
                  tasks: int | None = None) -> DataFrame:
    """Rows → JSON-array values (E1, F7): one record per (message, machine),
    so a record is bounded by one machine's rows in one tick however many
    machines there are (``pack_bounded`` bounds it in bytes). Rows inside are
    ordered by ``order``; ``keep_by`` keeps the columns ``by``. ``tasks``: how
    many pack (else the session's shuffle partitions).
    """
    if tasks:
        rows = rows.repartition(tasks, offset, *by)
    key = [F.col(c) for c in order]
    rec = F.struct(*key, F.struct(*[F.col(c) for c in row_cols]).alias("r"))
    return (rows.groupBy(offset, *by)
            .agg(F.array_sort(F.collect_list(rec)).alias("_rs"))
            .select(F.col(offset), *(by if keep_by else ()),
                    F.to_json(F.transform("_rs", lambda x: x["r"])).alias("value")))


def pack_bounded(rows: DataFrame, row_cols: list[str], max_bytes: int, offset: str = "offset_id",
                 by: list[str] = ("machine",), order: list[str] = ("sequence",)) -> DataFrame:
    """Rows → JSON-array values of at most ``max_bytes`` bytes.

    ``(offset, *by, part, n_rows, value)``: the rows of a message follow one
    another in ``order`` over as many parts as they need. A row's place in its
    message is the running sum of the rows' sizes before it (``prefix_sums``,
    so a message may be larger than a task), and a part takes the rows that
    begin within a stride of the bound less the largest row. So no part passes
    the bound, and only one part's rows ever meet. A row that does not fit the
    bound by itself is an error.
    """
    group = [offset, *by]
    texts = rows.select(*group, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                        F.to_json(F.struct(*row_cols)).alias("_t"))
    sized = checkpointed(texts.withColumn("_size", F.octet_length("_t").cast("bigint") + 1))  # with a comma or bracket
    biggest = sized.agg(F.max("_size")).first()[0] or 0
    if biggest + 1 > max_bytes:
        raise ValueError(f"a row needs {biggest + 1} bytes, a message has {max_bytes}")
    keys = [f"_o{i}" for i in range(len(order))]
    placed = prefix_sums(sized, keys, ["_size"], ["_upto"], group_by=group)
    part = F.floor((F.col("_upto") - F.col("_size")) / F.lit(max_bytes - biggest)).cast("bigint")
    rec = F.struct(*keys, "_t")
    return (placed.withColumn("part", part).groupBy(*group, "part")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.array_sort(F.collect_list(rec)).alias("_rs"))
            .select(*group, "part", "n_rows",
                    F.concat(F.lit("["), F.array_join(F.transform("_rs", lambda x: x["_t"]), ","), F.lit("]")).alias("value")))


def unpack_messages(messages: DataFrame, row_schema: T.StructType, value: str = "value",
                    keep: list[str] = ("offset_id",), pos: str = "pos") -> DataFrame:
    """JSON-array value → one row per element, with its position."""
    v = F.col(value)
    if isinstance(messages.schema[value].dataType, T.BinaryType):
        v = v.cast("string")
    arr = F.from_json(v, T.ArrayType(row_schema))
    return (messages.select(*keep, F.posexplode(arr).alias(pos, "_r"))
            .select(*keep, pos, "_r.*"))


def message_counts(rows: DataFrame, offset: str = "offset_id", machine: str = "machine",
                   name: str = "n") -> DataFrame:
    """Rows per machine per message, long form (A10)."""
    return rows.groupBy(offset, machine).agg(F.count(F.lit(1)).alias(name))


def message_counts_direct(framed: DataFrame, last: int, horizon: int | None = None,
                          offset: str = "offset_id", machine: str = "machine",
                          name: str = "n") -> DataFrame:
    """``message_counts(message_rows(framed, horizon))`` without materialising
    any re-sent copy (A10).

    One partial aggregate gives, per tick and machine, the on-time and
    held-back row counts; only these count rows are spread over the ticks
    that carry them (their own tick for on-time rows, the next ``horizon``
    ticks for held-back rows) and summed per ``(offset, machine)``.
    """
    per_tick = framed.groupBy(offset, machine).agg(
        F.count_if(~F.col("is_late")).alias("_on"), F.count_if(F.col("is_late")).alias("_hb"))
    last_c = F.lit(int(last)).cast("bigint")
    upto = last_c if horizon is None else F.least(last_c, F.col(offset) + F.lit(int(horizon)))
    spread = per_tick.select(machine, F.col(offset).alias("_t"), "_on", "_hb",
                             F.explode(F.sequence(F.col(offset), F.greatest(upto, F.col(offset))))
                             .alias(offset))
    part = F.when(F.col(offset) == F.col("_t"), F.col("_on")).otherwise(F.col("_hb"))
    return (spread.groupBy(offset, machine).agg(F.sum(part).cast("bigint").alias(name))
            .where(F.col(name) > 0))


def message_counts_wide(counts: DataFrame, machines: list, offset: str = "offset_id",
                        machine: str = "machine", name: str = "n",
                        prefix: str = "machine_") -> DataFrame:
    """One column per machine, 0 when absent (A11; the reference shifts series instead)."""
    wide = (counts.groupBy(offset).pivot(machine, list(machines)).agg(F.sum(name)))
    wide = wide.fillna(0, subset=[str(m) for m in machines])
    return wide.select(offset, *[F.col(str(m)).cast("bigint").alias(f"{prefix}{m}") for m in machines])


def packed_counts_wide(messages: DataFrame, machines: list, row_schema: T.StructType,
                       value: str = "value", keep: list[str] = ("offset_id",),
                       machine: str = "machine", prefix: str = "machine_") -> DataFrame:
    """Per-message machine counts straight from packed messages, no shuffle
    (A11 stateless form; works unchanged on a stream)."""
    v = F.col(value)
    if isinstance(messages.schema[value].dataType, T.BinaryType):
        v = v.cast("string")
    arr = F.from_json(v, T.ArrayType(row_schema))
    def of(m):
        return lambda r: r[machine] == F.lit(m)

    cols = [F.size(F.filter(arr, of(m))).cast("bigint").alias(f"{prefix}{m}") for m in machines]
    return messages.select(*keep, *cols)


def message_time(rows: DataFrame, offset: str = "offset_id", machine: str = "machine",
                 pos: str = "pos", ts: str = "ts") -> DataFrame:
    """Time of each message: ``ts`` of the first row of the lowest machine."""
    return (rows.groupBy(offset)
            .agg(F.min_by(ts, F.struct(F.col(machine), F.col(pos))).alias("ts"))
            .withColumn("clock", clock_text("ts")))


def last_points(counts: DataFrame, n: int = MEMORY_TRAIL, offset: str = "offset_id",
                last: int | None = None) -> DataFrame:
    """The last ``n`` messages of every series (W1, what the consumer draws).
    ``last`` = the last message id if known (e.g. ``last_tick``)."""
    cut = counts.agg(F.max(offset)).scalar() if last is None else F.lit(int(last))
    return counts.where(F.col(offset) > cut - F.lit(n))


def trailing_window(counts: DataFrame, n: int = MEMORY_TRAIL, offset: str = "offset_id",
                    machine: str = "machine", value: str = "n") -> DataFrame:
    """For every count, sum and number of the machine's counts with offsets in
    ``[offset - n + 1, offset]`` (W1 running frame; a RANGE frame over offsets).

    Each count contributes to offsets ``o .. o+n-1``; exploding and grouping
    by ``(machine, target)`` spreads a hot machine over all tasks.
    """
    # d = distance from the contributing count; d = 0 marks the count itself,
    # so windows are emitted only where the machine has a count (as a SQL
    # window over the counts, or the streaming processor, would)
    spread = counts.select(machine, F.col(value), F.col(offset).alias("_o"),
                           F.posexplode(F.sequence(F.col(offset), F.col(offset) + F.lit(n - 1)))
                           .alias("_d", offset))
    return (spread.groupBy(offset, machine)
            .agg(F.sum(value).cast("bigint").alias("window_sum"),
                 F.count(F.lit(1)).alias("window_len"),
                 F.max((F.col("_d") == 0).cast("int")).alias("_own"))
            .where(F.col("_own") == 1).drop("_own"))


def tumbling_counts(rows: DataFrame, ts: str = "ts", width: str = "1 day",
                    machine: str = "machine") -> DataFrame:
    """Rows per machine per event-time window (ST4 batch twin); window bounds
    as epoch seconds."""
    t = F.timestamp_seconds(F.col(ts)) if not isinstance(rows.schema[ts].dataType,
                                                          (T.TimestampType, T.TimestampNTZType)) \
        else F.col(ts)
    return (rows.groupBy(F.window(t, width).alias("w"), F.col(machine))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                    F.unix_seconds(F.col("w.end")).alias("window_end"), machine, "n"))


def stamp_rows(rows: DataFrame, name: str = "ts") -> DataFrame:
    """Stamp rows with the ingest time in epoch seconds (P10, F12), fixed
    once per query (the reference re-stamps shared row objects, D15)."""
    return rows.withColumn(name, F.unix_timestamp(F.current_timestamp()))


def count_series(counts: DataFrame, times: DataFrame, n: int = MEMORY_TRAIL,
                 offset: str = "offset_id", machine: str = "machine", value: str = "n",
                 last: int | None = None) -> DataFrame:
    """The consumer's chart data (V6): for the last ``n`` messages, the count
    of every machine against the message's clock time (long form)."""
    recent = last_points(counts, n, offset, last)
    return recent.join(times.select(offset, "clock"), offset, "left") \
        .select(offset, "clock", machine, value)


def series_extremes(series: DataFrame, offset: str = "offset_id", machine: str = "machine",
                    value: str = "n", clock: str = "clock") -> DataFrame:
    """Arg-max / arg-min annotation of each machine's count series (A13, A14,
    F13): first occurrence on ties, labelled ``Max: Time=…, Value=…``."""
    agg = series.groupBy(machine).agg(
        F.max(value).alias("max_n"),
        F.max_by(F.col(clock), F.struct(F.col(value), -F.col(offset))).alias("max_clock"),
        F.min(value).alias("min_n"),
        F.min_by(F.col(clock), F.struct(F.col(value), F.col(offset))).alias("min_clock"))
    return agg.select(machine, "max_n", "min_n",
                      max_label("max_clock", "max_n").alias("max_label"),
                      min_label("min_clock", "min_n").alias("min_label"))


def distinct_machines(df: DataFrame, machine: str = "machine") -> DataFrame:
    """Distinct machines."""
    return df.select(machine).distinct()


def machine_values(df: DataFrame, machine: str = "machine", limit: int = 10_000) -> list:
    """Machine ids as a driver list, one value per column of a wide table;
    more than ``limit`` are an error, because such a table could not be planned.
    Callers that know their machines pass the list themselves; the long form
    needs none."""
    found = distinct_machines(df, machine).limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} machines: use the long form")
    return sorted(r[0] for r in found)
