"""Late and repeated rows on a stream (ST4, ST5).

The memory producer stamps rows when they are drawn and re-sends held-back
rows in every later message, so a consumer sees both late rows (event time
behind the stream) and repeated rows. Watermarks bound the state both need.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def with_event_time(rows: DataFrame, ts: str = "ts", name: str = "event_time") -> DataFrame:
    """Epoch seconds (or ``TIMESTAMP_NTZ``) → ``TIMESTAMP`` event time.

    Streaming watermarks require ``TIMESTAMP``; an NTZ column is read in the
    session zone (UTC here).
    """
    dt = rows.schema[ts].dataType
    if isinstance(dt, T.TimestampType):
        return rows.withColumn(name, F.col(ts))
    if isinstance(dt, T.TimestampNTZType):
        return rows.withColumn(name, F.col(ts).cast("timestamp"))
    return rows.withColumn(name, F.timestamp_seconds(F.col(ts)))


def windowed_counts(rows: DataFrame, event_time: str = "event_time", delay: str = "1 day",
                    width: str = "1 day", machine: str = "machine") -> DataFrame:
    """Rows per machine per tumbling event-time window with a watermark (ST4).

    Append mode emits a window once the watermark passes its end; rows older
    than the watermark are dropped and reported as
    ``numRowsDroppedByWatermark`` in the query progress.
    """
    return (rows.withWatermark(event_time, delay)
            .groupBy(F.window(event_time, width).alias("w"), F.col(machine))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                    F.unix_seconds(F.col("w.end")).alias("window_end"), machine, "n"))


def window_parts(rows: DataFrame, event_time: str = "event_time", width: str = "1 day", machine: str = "machine") -> DataFrame:
    """Rows per machine and tumbling window, without a watermark: counts of one batch, to be added up."""
    return (rows.groupBy(F.window(event_time, width).alias("w"), F.col(machine))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("w.start")).alias("window_start"),
                    F.unix_seconds(F.col("w.end")).alias("window_end"), machine, "n"))


def write_window_counts(rows: DataFrame, path: str, checkpoint: str, event_time: str = "event_time",
                        width: str = "1 day", machine: str = "machine", available_now: bool = False,
                        trigger: str = "5 seconds"):
    """Complete window counts without waiting for a watermark (ST4).

    Each micro-batch writes its partial counts under its own id (a replayed
    batch replaces them); ``read_window_counts`` adds them up. Every row
    counts, however late, and the result does not depend on the batches.
    Feed it de-duplicated rows if rows are re-sent. Returns the
    ``StreamingQuery``.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        window_parts(batch, event_time, width, machine).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_window_counts(spark: SparkSession, path: str, machine: str = "machine") -> DataFrame:
    """Window counts over all batches written so far."""
    return (spark.read.parquet(path).groupBy("window_start", "window_end", machine)
            .agg(F.sum("n").alias("n")))


def write_window_revisions(rows: DataFrame, path: str, checkpoint: str, event_time: str = "event_time",
                           delay: str = "1 day", width: str = "1 day", machine: str = "machine",
                           available_now: bool = False, trigger: str = "5 seconds"):
    """Window totals under a watermark, in update mode (ST4).

    A window's total is out at once and is revised by every micro-batch that
    adds to it, until the watermark passes its end; state holds only windows
    that are still open. A batch's revisions are written under its id, so a
    replayed batch replaces them; ``read_window_revisions`` merges them.
    Returns the ``StreamingQuery``.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    w = (windowed_counts(rows, event_time, delay, width, machine).writeStream.outputMode("update")
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_window_revisions(spark: SparkSession, path: str, received: str | None = None, machine: str = "machine") -> DataFrame:
    """``(window_start, window_end, machine, n)``: the last revision of every
    window and machine, in whatever order the tables are read.

    With ``received``, the folder of a ``write_window_counts`` of the same
    stream, also ``dropped``: the rows of the window that came too late. Windows
    all of whose rows were dropped are there with ``n`` = 0.
    """
    key = ["window_start", "window_end", machine]
    last = spark.read.parquet(path).groupBy(*key).agg(F.max_by("n", "batch").alias("n"))
    if received is None:
        return last
    came = read_window_counts(spark, received, machine).withColumnRenamed("n", "came")
    n = F.coalesce("n", F.lit(0))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    return came.alias("l").join(last.alias("r"), reduce(lambda a, b: a & b, on), "left").select(
        *[F.col(f"l.{c}").alias(c) for c in key], n.alias("n"), (F.col("came") - n).alias("dropped"))


def drop_repeats(rows: DataFrame, keys: list[str] = ("machine", "sequence"),
                 event_time: str = "event_time", delay: str = "3 days") -> DataFrame:
    """Drop repeated rows within the watermark delay (ST5).

    State per key lives until the watermark passes the row's event time plus
    the delay, so choose ``delay`` at least as long as a row can be re-sent. Copies arriving after that are older than the
    watermark and are dropped as late, so they are never emitted twice.
    """
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dropped_by_watermark(query) -> int:
    """Rows dropped as too late, summed over the query's recent progress
    (``numRowsDroppedByWatermark`` of every stateful operator). Counted after
    partial aggregation, so it need not equal raw input rows."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) or []:
            total += int(op.get("numRowsDroppedByWatermark", 0) or 0)
    return total
