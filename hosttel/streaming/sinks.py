"""Stream sinks and query handles (S7–S9, ST1, ST8).

The reference builds console writers, never keeps the started query, and
queries a console sink by name (which has no table). Here every writer
returns its ``StreamingQuery``; results go to a Parquet/table sink that any
SQL can read, or to the in-memory sink for interactive inspection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

# fixed value: the reference's micro-batch interval
TRIGGER_INTERVAL = "5 seconds"


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or TRIGGER_INTERVAL)


def to_console(df: DataFrame, name: str, trigger: str | None = None, mode: str = "append",
               available_now: bool = False) -> StreamingQuery:
    """Console sink, named, 5-second micro-batches by default (S7, ST1)."""
    w = df.writeStream.format("console").outputMode(mode).queryName(name)
    return _trigger(w, trigger, available_now).start()


def to_memory(df: DataFrame, name: str, trigger: str | None = None, mode: str = "append",
              available_now: bool = False) -> StreamingQuery:
    """In-memory table named ``name`` for ``spark.sql`` (S8, ST8). The table
    lives in the driver: for inspection of small results only."""
    w = df.writeStream.format("memory").outputMode(mode).queryName(name)
    return _trigger(w, trigger, available_now).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, name: str | None = None,
               trigger: str | None = None, available_now: bool = False,
               partition_by: list[str] | None = None) -> StreamingQuery:
    """Exactly-once Parquet sink (append) with its own checkpoint (S8 at scale)."""
    w = (df.writeStream.format("parquet").outputMode("append").option("path", path)
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger, available_now).start()


def to_table(df: DataFrame, table: str, checkpoint: str, trigger: str | None = None,
             available_now: bool = False, path: str | None = None) -> StreamingQuery:
    """Append a stream to a catalog table readable by any SQL (S8), also while
    the stream runs and after it was stopped and started again. ``path`` says
    where a new table's files lie (else in the warehouse)."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if path:
        w = w.option("path", path)
    w = _trigger(w, trigger, available_now)
    return w.toTable(table)


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> DataFrame:
    """Drain all available input into a Parquet sink and return it as a batch
    ``DataFrame`` (start → wait → stop, S9)."""
    q = to_parquet(df, path, checkpoint, name, available_now=True)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return df.sparkSession.read.parquet(path)


def query_by_name(spark: SparkSession, name: str) -> DataFrame:
    """``select * from <queryName>`` over a memory sink."""
    return spark.sql(f"SELECT * FROM `{name}`")


def query_live(spark: SparkSession, table: str, sql: str) -> DataFrame:
    """SQL over a table that a stream is writing (S8, ST8): ``{table}`` in
    ``sql`` stands for its name. The files are listed anew, so the rows of all
    micro-batches that are complete now are seen, and of none that is not."""
    spark.catalog.refreshTable(table)
    return spark.sql(sql.format(table=f"`{table}`"))


def stop_all(spark: SparkSession) -> None:
    """Stop every active query of the session."""
    for q in spark.streams.active:
        q.stop()
