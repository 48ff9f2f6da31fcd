"""Session helpers.

The library never sets ``master``: it takes the caller's session. Helpers
here only fill settings that are *unset*, so a cluster's own values (shuffle
partitions, checkpoint directory, split size) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the reference applies to its sessions, as fixed values:
# input split size 31 000 000 bytes, session time zone UTC.
REFERENCE_SPLIT_BYTES = 31_000_000
SESSION_TIME_ZONE = "UTC"


def local_session(app_name: str = "hosttel", cores: int | str = "*",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench. Not used by library code."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_TIME_ZONE)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir",
                tempfile.mkdtemp(prefix="hosttel-wh-", dir=os.environ.get("TMPDIR", "/tmp")))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment to a shared folder and is read
    as is; without it there is a clear error, because a folder of one machine
    would not be seen by the others. Only a ``local`` session (tests) gets a
    fresh scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect sessions have no SparkContext)
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = fallback_checkpoint_dir(spark.conf.get("spark.master", ""))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def fallback_checkpoint_dir(master: str) -> str:
    """A scratch folder for a ``local`` master; an error for any other."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return tempfile.mkdtemp(prefix="hosttel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def apply_reference_settings(spark: SparkSession, split_bytes: int = REFERENCE_SPLIT_BYTES) -> None:
    """Apply the reference's session settings (split size, UTC) at runtime."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)


def size_for(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 * 1024 * 1024,
             split_bytes: int = 256 * 1024 * 1024) -> int:
    """Size shuffles for an input of ``input_bytes``: one shuffle partition
    per ``partition_bytes`` of input (at least the current setting), AQE on
    with the same advisory size so it can coalesce small ones and split
    skewed joins, and input splits of ``split_bytes``. Returns the shuffle
    partition count. Only runtime SQL settings are changed."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(current, -(-int(input_bytes) // int(partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return n
