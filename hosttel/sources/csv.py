"""Telemetry CSV readers.

S1 reads batch telemetry with the fixed schema, applied by position, with a
header line; bad fields become null (``PERMISSIVE``). S2/S3 read replay files
*by column name* and cast each field the way the replay producer does
(``int(x)`` or ``int(float(x))``), with ``try_cast`` so bad text is null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_int, parse_int_of_float
from ..schemas import MEMORY_SCHEMA, PROCESS_SCHEMA

# fixed values: how each replay column is parsed (name → rule)
# "int" = int(x); "int_float" = int(float(x)); "text" = kept as is
MEMORY_REPLAY_FIELDS = [
    ("sequence", "int"), ("machine", "int"), ("PID", "int"), ("MINFLT", "int"),
    ("MAJFLT", "int"), ("VSTEXT", "int"), ("VSIZE", "int_float"), ("RSIZE", "int_float"),
    ("VGROW", "int_float"), ("RGROW", "int_float"), ("MEM", "int_float"), ("CMD", "text"),
]
PROCESS_REPLAY_FIELDS = [
    ("sequence", "int"), ("machine", "int"), ("PID", "int"), ("TRUN", "int"),
    ("TSLPI", "int"), ("TSLPU", "int"), ("POLI", "text"), ("NICE", "int"), ("PRI", "int"),
    ("RTPR", "int"), ("CPUNR", "int"), ("Status", "text"), ("EXC", "int"), ("State", "text"),
    ("CPU", "int_float"), ("CMD", "text"),
]

_NARROW = {"machine", "PID", "TRUN", "TSLPI", "TSLPU", "NICE", "PRI", "RTPR", "CPUNR",
           "EXC", "CPU"}


def read_telemetry_csv(spark: SparkSession, path: str, schema, mode: str = "PERMISSIVE") -> DataFrame:
    """Multi-file CSV scan with header and a fixed schema."""
    return (spark.read.schema(schema).option("header", True).option("mode", mode)
            .csv(path))


def read_process_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_telemetry_csv(spark, path, PROCESS_SCHEMA)


def read_memory_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_telemetry_csv(spark, path, MEMORY_SCHEMA)


def _replay(spark: SparkSession, path: str, fields) -> DataFrame:
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = []
    for name, rule in fields:
        c = F.col(name)
        if rule == "int":
            c = parse_int(c)
        elif rule == "int_float":
            c = parse_int_of_float(c)
        if rule != "text" and name in _NARROW:
            c = c.cast("int")
        cols.append(c.alias(name))
    return raw.select(*cols)


def read_memory_replay(spark: SparkSession, path: str) -> DataFrame:
    """Memory replay file read by column name."""
    return _replay(spark, path, MEMORY_REPLAY_FIELDS)


def read_process_replay(spark: SparkSession, path: str) -> DataFrame:
    """Process replay file read by column name (S3). ``TSLPU`` is read from its
    own column (the reference fills it from ``sequence``)."""
    return _replay(spark, path, PROCESS_REPLAY_FIELDS)
