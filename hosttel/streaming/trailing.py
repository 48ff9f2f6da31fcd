"""Trailing per-machine counts on a stream (ST6).

The reference's consumer keeps, per machine, the last N per-message counts
and redraws them. Here every micro-batch spreads its counts over the N
offsets whose window ``[offset - N + 1, offset]`` contains them and aggregates
on ``(machine, offset)``: native, no state, a hot machine is spread over its
offsets. A batch's partial sums are written under its own id, so a replayed
batch replaces them; reading adds the partial sums up. The result therefore
does not depend on how the input was cut into batches, and late counts revise
the windows they belong to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def partial_windows(counts: DataFrame, n_points: int, machine: str = "machine") -> DataFrame:
    """Sums and lengths that these counts add to each window (A10 → W1);
    ``own`` marks offsets at which the machine has a count itself."""
    spread = counts.select(machine, "n", F.posexplode(
        F.sequence(F.col("offset_id"), F.col("offset_id") + F.lit(n_points - 1))).alias("_d", "offset_id"))
    return spread.groupBy("offset_id", machine).agg(
        F.sum("n").cast("bigint").alias("window_sum"), F.count(F.lit(1)).alias("window_len"),
        F.max((F.col("_d") == 0).cast("int")).alias("own"))


def write_trailing_counts(counts: DataFrame, n_points: int, path: str, checkpoint: str,
                          machine: str = "machine", available_now: bool = False, trigger: str = "5 seconds"):
    """Start the stream of partial windows; returns the ``StreamingQuery``."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        partial_windows(batch, n_points, machine).write.mode("overwrite").parquet(
            f"{path.rstrip('/')}/batch={batch_id}")

    w = counts.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_trailing_counts(spark: SparkSession, path: str, machine: str = "machine") -> DataFrame:
    """``(offset_id, machine, window_sum, window_len)`` over all batches written so far."""
    return (spark.read.parquet(path).groupBy("offset_id", machine)
            .agg(F.sum("window_sum").alias("window_sum"), F.sum("window_len").alias("window_len"),
                 F.max("own").alias("own"))
            .where("own = 1").drop("own"))
