"""Catalogue entries for the CSV sources (S1–S3) and the SQL functions (UD1).

Input: the telemetry views written as CSV files under the shared scratch
folder, in the layouts that the readers expect.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.sql import register_sql_functions
from ..schemas import MEMORY_SCHEMA, PROCESS_SCHEMA
from ..session import scratch_path
from ..sources import csv as C
from ..sources.fixtures import MEM_SQL, PROC_SQL, mem, proc
from .registry import register, with_views


def _written_csv(df, name: str) -> str:
    path = scratch_path(df.sparkSession, f"csv/{name}-{uuid.uuid4().hex}")
    (df.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def _in_layout(df, schema, **columns):
    """The file's columns in order; those not given are empty."""
    return df.select(*[columns.get(f.name, F.lit(None)).cast("string").alias(f.name) for f in schema.fields])


@register("csv_memory", with_views(MEM_SQL) + """
SELECT CAST(pid AS INTEGER) AS "PID", minflt AS "MINFLT", vsize AS "VSIZE", rsize AS "RSIZE", cmd AS "CMD", attack FROM mem""")
def q_csv_memory(spark, sf):
    """Batch memory CSV read with its fixed schema."""
    c = F.col
    rows = _in_layout(mem(spark, sf), MEMORY_SCHEMA, PID=c("pid"), MINFLT=c("minflt"), VSIZE=c("vsize"),
                      RSIZE=c("rsize"), CMD=c("cmd"), attack=c("attack"))
    return C.read_memory_csv(spark, _written_csv(rows, "memory")).select(
        "PID", "MINFLT", "VSIZE", "RSIZE", "CMD", "attack")


@register("csv_process", with_views(PROC_SQL) + """
SELECT CAST(ts AS INTEGER) AS ts, CAST(pid AS INTEGER) AS "PID", tslpi AS "TSLPI", state AS "State", cpu AS "CPU",
       cmd AS "CMD", attack, type FROM proc""")
def q_csv_process(spark, sf):
    """Batch process CSV read with its fixed schema."""
    c = F.col
    rows = _in_layout(proc(spark, sf), PROCESS_SCHEMA, ts=c("ts"), PID=c("pid"), TSLPI=c("tslpi"), State=c("state"),
                      CPU=c("cpu"), CMD=c("cmd"), attack=c("attack"), type=c("type"))
    return C.read_process_csv(spark, _written_csv(rows, "process")).select(
        "ts", "PID", "TSLPI", "State", "CPU", "CMD", "attack", "type")


@register("csv_memory_replay", with_views(MEM_SQL) + """
SELECT CAST(pid * 8 + seq AS BIGINT) AS sequence, CAST(seq AS INTEGER) AS machine, CAST(pid AS INTEGER) AS "PID",
       CAST(minflt AS BIGINT) AS "MINFLT", CAST(trunc(CAST(minflt AS DOUBLE) / 4) AS BIGINT) AS "VSIZE", cmd AS "CMD"
FROM mem""")
def q_csv_memory_replay(spark, sf):
    """Memory replay CSV read by column name, each field by its rule."""
    m = mem(spark, sf)
    rows = m.select("cmd", (F.col("minflt").cast("double") / 4).alias("VSIZE"), F.col("minflt").alias("MINFLT"),
                    F.col("pid").alias("PID"), F.col("seq").alias("machine"),
                    (F.col("pid") * 8 + F.col("seq")).alias("sequence"),
                    *[F.lit("0").alias(n) for n in ("MAJFLT", "VSTEXT", "RSIZE", "VGROW", "RGROW", "MEM")])
    rows = rows.withColumnRenamed("cmd", "CMD")
    return C.read_memory_replay(spark, _written_csv(rows, "memory-replay")).select(
        "sequence", "machine", "PID", "MINFLT", "VSIZE", "CMD")


@register("csv_process_replay", with_views(PROC_SQL) + """
SELECT sequence, machine, CAST(pid AS INTEGER) AS "PID", tslpi AS "TSLPI", tslpi + 1 AS "TSLPU", state AS "State",
       CAST(trunc(cpu) AS INTEGER) AS "CPU", cmd AS "CMD" FROM proc""")
def q_csv_process_replay(spark, sf):
    """Process replay CSV read by column name, each field by its rule (S3)."""
    p = proc(spark, sf)
    rows = p.select(F.col("cmd").alias("CMD"), F.col("cpu").alias("CPU"), F.col("state").alias("State"),
                    (F.col("tslpi") + 1).alias("TSLPU"), F.col("tslpi").alias("TSLPI"), F.col("pid").alias("PID"),
                    "machine", "sequence",
                    *[F.lit("0").alias(n) for n in ("TRUN", "POLI", "NICE", "PRI", "RTPR", "CPUNR", "Status", "EXC")])
    return C.read_process_replay(spark, _written_csv(rows, "process-replay")).select(
        "sequence", "machine", "PID", "TSLPI", "TSLPU", "State", "CPU", "CMD")


@register("sql_functions", with_views(MEM_SQL) + """
SELECT pid, seq,
       try_cast(replace(replace(replace(replace(vsize,'K','000'),'M','000000'),'G','000000000'),' ','') AS BIGINT) AS vsize_num,
       rtrim(ltrim(cmd, '<'), '>') AS cmd_clean
FROM mem WHERE rtrim(ltrim(cmd, '<'), '>') = 'O'""")
def q_sql_functions(spark, sf):
    """The registered functions called from SQL (UD1)."""
    register_sql_functions(spark)
    return spark.sql("SELECT pid, seq, size_int(vsize) AS vsize_num, strip_brackets(cmd) AS cmd_clean "
                     "FROM {m} WHERE strip_brackets(cmd) = 'O'", m=mem(spark, sf))
