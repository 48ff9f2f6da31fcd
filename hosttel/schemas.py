"""Fixed telemetry schemas (never inferred).

Column names and orders are fixed values that must equal the reference's
for its files to be read correctly.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: batch process table, declared order -------------------
PROCESS_COLUMNS = [
    ("ts", T.IntegerType()), ("PID", T.IntegerType()), ("TRUN", T.IntegerType()),
    ("TSLPI", T.IntegerType()), ("TSLPU", T.IntegerType()), ("POLI", T.StringType()),
    ("NICE", T.IntegerType()), ("PRI", T.IntegerType()), ("RTPR", T.IntegerType()),
    ("CPUNR", T.IntegerType()), ("Status", T.StringType()), ("EXC", T.IntegerType()),
    ("State", T.StringType()), ("CPU", T.DoubleType()), ("CMD", T.StringType()),
    ("attack", T.IntegerType()), ("type", T.StringType()),
]

# --- fixed values: batch memory table (raw, sizes as unit text) -----------
MEMORY_COLUMNS = [
    ("ts", T.IntegerType()), ("PID", T.IntegerType()), ("MINFLT", T.StringType()),
    ("MAJFLT", T.StringType()), ("VSTEXT", T.StringType()), ("VSIZE", T.StringType()),
    ("RSIZE", T.StringType()), ("VGROW", T.StringType()), ("RGROW", T.StringType()),
    ("MEM", T.StringType()), ("CMD", T.StringType()), ("attack", T.IntegerType()),
    ("type", T.StringType()),
]

# Size columns of the memory table and their cleaned numeric kind.
MEMORY_INT_SIZE_COLUMNS = ["MINFLT"]
MEMORY_FLOAT_SIZE_COLUMNS = ["MAJFLT", "VSTEXT", "VSIZE", "RSIZE", "VGROW", "RGROW", "MEM"]

# --- fixed values: stream rows (one JSON object each; no label columns) ---
MEMORY_STREAM_COLUMNS = [
    ("sequence", T.LongType()), ("machine", T.IntegerType()), ("PID", T.IntegerType()),
    ("MINFLT", T.LongType()), ("MAJFLT", T.LongType()), ("VSTEXT", T.LongType()),
    ("VSIZE", T.LongType()), ("RSIZE", T.LongType()), ("VGROW", T.LongType()),
    ("RGROW", T.LongType()), ("MEM", T.LongType()), ("CMD", T.StringType()),
    ("ts", T.LongType()),
]

PROCESS_STREAM_COLUMNS = [
    ("sequence", T.LongType()), ("machine", T.IntegerType()), ("PID", T.IntegerType()),
    ("TRUN", T.IntegerType()), ("TSLPI", T.IntegerType()), ("TSLPU", T.IntegerType()),
    ("POLI", T.StringType()), ("NICE", T.IntegerType()), ("PRI", T.IntegerType()),
    ("RTPR", T.IntegerType()), ("CPUNR", T.IntegerType()), ("Status", T.StringType()),
    ("EXC", T.IntegerType()), ("State", T.StringType()), ("CPU", T.IntegerType()),
    ("CMD", T.StringType()), ("ts", T.LongType()),
]

# Kafka record envelope as delivered by the Structured Streaming connector.
KAFKA_ENVELOPE_COLUMNS = [
    ("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", T.StringType()),
    ("partition", T.IntegerType()), ("offset", T.LongType()),
    ("timestamp", T.TimestampType()), ("timestampType", T.IntegerType()),
]


def struct_of(columns) -> T.StructType:
    """Nullable ``StructType`` from ``(name, type)`` pairs."""
    return T.StructType([T.StructField(n, t, True) for n, t in columns])


PROCESS_SCHEMA = struct_of(PROCESS_COLUMNS)
MEMORY_SCHEMA = struct_of(MEMORY_COLUMNS)
MEMORY_STREAM_ROW = struct_of(MEMORY_STREAM_COLUMNS)
PROCESS_STREAM_ROW = struct_of(PROCESS_STREAM_COLUMNS)
KAFKA_ENVELOPE = struct_of(KAFKA_ENVELOPE_COLUMNS)
