"""Kafka sources and sinks (S4–S6) and a file stand-in with the same envelope.

The Kafka connector (``spark-sql-kafka``) is not on this machine's classpath
and there is no broker, so ``read_kafka``/``write_kafka`` are written against
the connector's documented options but cannot be exercised here. Tests and
the query catalogue use ``read_envelope_stream``: Parquet files carrying the
connector's exact record envelope, so every downstream operator sees the
same columns it would see from Kafka.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import KAFKA_ENVELOPE

#: Bytes of message text that one task decodes, about.
TASK_BYTES = 16 << 20


def read_kafka(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest",
               options: dict | None = None) -> DataFrame:
    """Streaming Kafka source, one topic (S4). ``starting_offsets="earliest"``
    replays the topic from the start (S5)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def read_kafka_batch(spark: SparkSession, servers: str, topic: str,
                     starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of a topic as a batch ``DataFrame`` (S5, finite drain)."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets).load())


def write_kafka(messages: DataFrame, servers: str, topic: str, value: str = "value",
                key: str | None = None) -> None:
    """Publish packed messages to a topic (S6), batch."""
    cols = [F.col(value).cast("binary").alias("value")]
    if key:
        cols.append(F.col(key).cast("string").cast("binary").alias("key"))
    (messages.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def write_kafka_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str,
                       value: str = "value"):
    """Publish a stream of packed messages (S6); returns the ``StreamingQuery``."""
    return (messages.select(F.col(value).cast("binary").alias("value")).writeStream
            .format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def to_envelope(messages: DataFrame, topic: str, offset: str = "offset_id",
                value: str = "value", partition: int = 0, ts: str | None = None) -> DataFrame:
    """Packed messages → Kafka record envelope (key, value, topic, partition,
    offset, timestamp, timestampType). The message id becomes the offset."""
    stamp = F.timestamp_seconds(F.col(ts)) if ts else F.current_timestamp()
    return messages.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(value).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(partition).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        stamp.cast("timestamp").alias("timestamp"),
        F.lit(0).cast("int").alias("timestampType"),
    )


def write_envelope_files(envelope: DataFrame, path: str, files: int | None = None) -> None:
    """Write envelope rows as Parquet, ordered by offset, for a file stream."""
    out = envelope.repartitionByRange(files, "offset") if files else envelope
    out.sortWithinPartitions("offset").write.mode("overwrite").parquet(path)


def read_envelope_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream with the Kafka envelope schema (stand-in for S4/S5)."""
    r = spark.readStream.schema(KAFKA_ENVELOPE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def message_tasks(messages: DataFrame, value: str = "value", task_bytes: int | None = None) -> int:
    """Tasks that decode ``messages`` at ``task_bytes`` of text each (``TASK_BYTES``), from their sizes alone."""
    total = messages.agg(F.sum(F.octet_length(value).cast("bigint"))).first()[0] or 0
    return max(1, -(-total // (task_bytes or TASK_BYTES)))


def deal_messages(messages: DataFrame, tasks: int, value: str = "value", offset: str = "offset") -> DataFrame:
    """``messages`` dealt over ``tasks`` by offset and text, batch or stream. A
    split of a compressed file, or a backlog of one topic partition, may hold
    many times the text that a task should decode; one task's worth is left as it is."""
    return messages if tasks <= 1 else messages.repartition(tasks, offset, value)
