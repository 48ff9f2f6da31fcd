"""Decode messages and count rows per machine per message (ST2, ST3).

All stateless: each Kafka record is one message, so per-message counts are
computed inside the record with higher-order functions — no shuffle, no
state, any output mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import kafka as K


def _rows(value_col: str, row_schema: T.StructType):
    return F.from_json(F.col(value_col).cast("string"), T.ArrayType(row_schema))


def decode_rows(env: DataFrame, row_schema: T.StructType, value: str = "value",
                keep: tuple = ("offset", "timestamp")) -> DataFrame:
    """Envelope → one row per array element with its position (ST2, E2)."""
    return (env.select(*keep, F.posexplode(_rows(value, row_schema)).alias("pos", "_r"))
            .select(*keep, "pos", "_r.*"))


def message_counts_long(env: DataFrame, row_schema: T.StructType, value: str = "value",
                        offset: str = "offset", machine: str = "machine") -> DataFrame:
    """``(offset, machine, n)`` per message, computed within each record (ST3).

    Machines present in the message come from ``array_distinct``; each count
    is ``size(filter(rows, r -> r.machine = m))``. A machine absent from a
    message has no row here (the wide form gives it 0). Cost per message is
    rows × machines in it: right for a handful of machines per message; for
    wide fleets use ``write_message_counts``.
    """
    arr = _rows(value, row_schema)
    with_rows = env.select(F.col(offset).alias("offset_id"), arr.alias("_rows"))
    per = with_rows.select(
        "offset_id", "_rows",
        F.explode(F.array_distinct(F.transform("_rows", lambda r: r[machine]))).alias(machine))
    return per.select("offset_id", machine,
                      F.size(F.filter("_rows", lambda r: r[machine] == F.col(machine)))
                      .cast("bigint").alias("n"))


def message_counts_wide(env: DataFrame, machines: list, row_schema: T.StructType,
                        value: str = "value", offset: str = "offset", machine: str = "machine",
                        prefix: str = "machine_") -> DataFrame:
    """One count column per listed machine, 0 when absent (ST3 wide form)."""
    arr = _rows(value, row_schema)

    def of(m):
        return lambda r: r[machine] == F.lit(m)

    return env.select(F.col(offset).alias("offset_id"),
                      *[F.size(F.filter(arr, of(m))).cast("bigint").alias(f"{prefix}{m}")
                        for m in machines])


def write_message_counts(env: DataFrame, row_schema: T.StructType, path: str, checkpoint: str,
                         available_now: bool = False, trigger: str = "5 seconds"):
    """Per-message machine counts for messages carrying many machines (ST3).

    A message is one record, so it never spans micro-batches: each batch is
    counted with an ordinary ``groupBy(offset_id, machine)`` (a shuffle on
    that pair; a hot machine spreads over offsets) and written to
    ``path/batch=<id>`` with overwrite, so a replayed batch replaces its own
    output (idempotent). Returns the ``StreamingQuery``.
    """
    rows = decode_rows(env, row_schema, keep=("offset",))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(F.col("offset").alias("offset_id"), "machine")
         .agg(F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}"))

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def checked_messages(env: DataFrame, row_schema: T.StructType, value: str = "value", offset: str = "offset") -> DataFrame:
    """One row per message with its outcome (ST2): ``(offset_id, value, rows,
    n_received, n_decoded, n_refused, reason)``.

    ``reason`` is null for a message all of whose rows can be read, else why
    not: ``no value``, ``not JSON``, ``not an array`` (then the number of rows
    is not known and 0 counts as received), or ``rows are not objects`` (the
    others are decoded). ``n_received = n_decoded + n_refused`` always holds,
    and no message is without a row here.
    """
    text = F.col("value").cast("string")
    size = F.json_array_length(text)
    base = env.select(F.col(offset).alias("offset_id"), F.col(value).alias("value"))
    read = base.withColumns({"_n": F.coalesce(size, F.lit(0)).cast("bigint"),
                             "_read": F.from_json(text, T.ArrayType(row_schema))})
    # one element that is no object spoils the array as a whole: then each is read by itself
    single = F.transform(F.from_json(text, T.ArrayType(T.StringType())),
                         lambda e: F.when(F.startswith(F.ltrim(e), F.lit("{")), F.from_json(e, row_schema)))
    some = F.when(size.isNotNull(), F.filter(F.coalesce(F.col("_read"), single), lambda r: r.isNotNull()))
    read = read.withColumn("rows", F.coalesce(some, F.array().cast(T.ArrayType(row_schema))))
    decoded = F.size("rows").cast("bigint")
    reason = (F.when(F.col("value").isNull(), "no value").when(F.try_parse_json(text).isNull(), "not JSON")
              .when(size.isNull(), "not an array").when(decoded < F.col("_n"), "rows are not objects"))
    return read.select("offset_id", "value", "rows", F.col("_n").alias("n_received"), decoded.alias("n_decoded"),
                       (F.col("_n") - decoded).alias("n_refused"), reason.alias("reason"))


def write_decoded(env: DataFrame, row_schema: T.StructType, path: str, checkpoint: str, value: str = "value",
                  offset: str = "offset", available_now: bool = False, trigger: str = "5 seconds"):
    """Decode a stream of messages and lose none without a word (ST2).

    Three tables per micro-batch, under its id (a replayed batch replaces
    them): ``path/rows`` (offset_id, pos and the row's columns), ``path/refused``
    (offset_id, reason, n_refused and the message's bytes, to be read again
    when the reader is mended), ``path/counts`` (what each message held).
    A batch is dealt over as many tasks as its text needs (``K.deal_messages``),
    so what a task decodes and keeps for the three does not grow with the batch.
    Returns the ``StreamingQuery``.
    """
    path = path.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        dealt = K.deal_messages(batch, K.message_tasks(batch, value), value, offset)
        checked = checked_messages(dealt, row_schema, value, offset).persist()
        try:
            tables = {
                "rows": checked.select("offset_id", F.posexplode("rows").alias("pos", "_r")).select("offset_id", "pos", "_r.*"),
                "refused": checked.where("reason IS NOT NULL").select("offset_id", "reason", "n_refused", "value"),
                "counts": checked.select("offset_id", "n_received", "n_decoded", "n_refused", "reason")}
            for name, df in tables.items():
                df.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            checked.unpersist()

    w = env.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
