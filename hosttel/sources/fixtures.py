"""Telemetry-shaped views over the driver tables.

The reference's own data files are absent, so the query catalogue runs on
views derived from the driver's parquet tables (``events``, ``lineitem``):
``proc`` is process-like, ``proc_dirty`` adds nulls and NaN, ``mem`` is
memory-like with unit text. They are plain projections: Catalyst prunes the
columns a query does not use down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import ntz_epoch_seconds
from ..operators.sample import SPLIT_WEIGHTS, hash_unit, unit_sql

# fixed values: number of machines in the process-like view, and the unit
# text appended to sizes in the memory-like view, chosen by l_partkey % 6
N_MACHINES = 5
MEM_UNIT_TEXT = ["K", "M", "", " ", ".5K", "k"]
POLICIES, STATUSES = ["norm", "btch", "idle", "norm", "fifo"], ["-", "N", "NE", "-", "NS", "C", "-"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def proc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process-like rows: one per event, five machines, errors are attacks."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("sequence"),
        (F.col("user_id") % N_MACHINES + 1).cast("int").alias("machine"),
        F.col("user_id").alias("pid"),
        ntz_epoch_seconds("ts").alias("ts"),
        F.concat(F.lit("<"), F.col("event_type"), F.lit(">")).alias("cmd"),
        F.upper(F.substring("event_type", 1, 1)).alias("state"),
        F.col("value").alias("cpu"),
        F.get_json_object("props", "$.k").cast("int").alias("tslpi"),
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("attack"),
    )


def proc_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``proc``-like rows with null and NaN ``cpu`` and null ``cmd``."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("sequence"),
        F.when(eid % 97 == 0, F.lit(None).cast("double"))
        .when(eid % 101 == 0, F.lit(float("nan")))
        .otherwise(F.col("value")).alias("cpu"),
        F.when(eid % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("<"), F.col("event_type"), F.lit(">"))).alias("cmd"),
    )


def proc_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process-like rows with the batch table's own column names, among them
    all model features. In the test part of the split every tenth row carries
    a state, a status and a command that no other part holds."""
    ev = table(spark, sf_dir, "events")
    key, user = F.col("event_id"), F.col("user_id")
    unseen = (hash_unit("event_id") >= SPLIT_WEIGHTS[0]) & (key % 10 == 0)

    def pick(names: list[str], number) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names) + 1).cast("int"))

    return ev.select(
        key.alias("sequence"), ntz_epoch_seconds("ts").alias("ts"), user.alias("PID"),
        F.get_json_object("props", "$.k").cast("int").alias("TSLPI"),
        pick(POLICIES, F.floor(user / 3)).alias("POLI"),
        (user % 8).cast("int").alias("CPUNR"),
        F.when(unseen, "NI").otherwise(pick(STATUSES, F.floor(key / 7))).alias("Status"),
        F.when(unseen, "Z").otherwise(F.upper(F.substring("event_type", 1, 1))).alias("State"),
        F.when(key % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("CPU"),
        F.when(unseen, "<unseen>").otherwise(F.concat(F.lit("<"), F.col("event_type"), F.lit(">"))).alias("CMD"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("attack"), F.col("event_type").alias("type"))


def mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Memory-like rows with sizes as unit text (one per line item)."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.element_at(F.array(*[F.lit(u) for u in MEM_UNIT_TEXT]),
                        (F.col("l_partkey") % len(MEM_UNIT_TEXT) + 1).cast("int"))
    return li.select(
        F.col("l_orderkey").alias("pid"),
        F.col("l_linenumber").alias("seq"),
        F.concat(F.floor("l_quantity").cast("int").cast("string"), unit).alias("rsize"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("G")).alias("vsize"),
        F.floor("l_extendedprice").cast("int").cast("string").alias("minflt"),
        F.concat(F.lit("<<"), F.col("l_linestatus"), F.lit(">")).alias("cmd"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("attack"),
    )


# DuckDB forms of the same views, inlined as CTEs by the oracle SQL.
PROC_SQL = """proc AS (
  SELECT event_id AS sequence, CAST(user_id % 5 + 1 AS INTEGER) AS machine, user_id AS pid,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         concat('<', event_type, '>') AS cmd, upper(substr(event_type, 1, 1)) AS state,
         value AS cpu, CAST(json_extract_string(props, '$.k') AS INTEGER) AS tslpi,
         event_type AS type, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS attack
  FROM events)"""



def _pick_sql(names: list[str], number: str) -> str:
    return f"([{', '.join(repr(n) for n in names)}])[CAST({number} % {len(names)} AS INTEGER) + 1]"


_UNSEEN_SQL = f"({unit_sql('event_id')} >= {SPLIT_WEIGHTS[0]} AND event_id % 10 = 0)"
PROC_FULL_SQL = f"""proc_full AS (
  SELECT event_id AS sequence, CAST(floor(epoch(ts)) AS BIGINT) AS ts, user_id AS "PID",
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS "TSLPI",
         {_pick_sql(POLICIES, 'user_id // 3')} AS "POLI", CAST(user_id % 8 AS INTEGER) AS "CPUNR",
         CASE WHEN {_UNSEEN_SQL} THEN 'NI' ELSE {_pick_sql(STATUSES, 'event_id // 7')} END AS "Status",
         CASE WHEN {_UNSEEN_SQL} THEN 'Z' ELSE upper(substr(event_type, 1, 1)) END AS "State",
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS "CPU",
         CASE WHEN {_UNSEEN_SQL} THEN '<unseen>' ELSE concat('<', event_type, '>') END AS "CMD",
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS attack, event_type AS type
  FROM events)"""

PROC_DIRTY_SQL = """proc_dirty AS (
  SELECT event_id AS sequence,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 101 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS cpu,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('<', event_type, '>') END AS cmd
  FROM events)"""

MEM_SQL = """mem AS (
  SELECT l_orderkey AS pid, l_linenumber AS seq,
         concat(CAST(CAST(floor(l_quantity) AS INTEGER) AS VARCHAR),
                CASE l_partkey % 6 WHEN 0 THEN 'K' WHEN 1 THEN 'M' WHEN 2 THEN ''
                                   WHEN 3 THEN ' ' WHEN 4 THEN '.5K' ELSE 'k' END) AS rsize,
         concat(CAST(l_linenumber AS VARCHAR), 'G') AS vsize,
         CAST(CAST(floor(l_extendedprice) AS INTEGER) AS VARCHAR) AS minflt,
         concat('<<', l_linestatus, '>') AS cmd,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS attack
  FROM lineitem)"""
