"""Uniform shuffle into shards of exact sizes by a communication matrix.

Rows lie in cells (logical partitions by a hash of their content). From the
cells' row counts and the shards' exact sizes a matrix of counts is drawn
whose law is that of a uniform shuffle: row by row multivariate
hypergeometric. Each cell permutes its rows and deals the counts of its matrix
row to the shards; each shard permutes what it got and numbers it.

DataFrame operations only; the driver sees one count per cell. Both
permutations order rows by seeded hashes of their content, so a task that is
run again deals alike. A shard is permuted in slices of the hash range, whose
counts give each slice its first slot; no shard has to fit into one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Cells and slices per shuffle partition, and the most there can be of each.
PER_PARTITION, MOST = 4, 1 << 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` from an urn are good. Beyond the library's range
    by inversion, from the mode outwards."""
    if draws == 0 or good == 0:
        return 0
    if bad == 0:
        return draws
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u, k_up, k_down, p_up, p_down = rng.random() - top, mode, mode, top, top
    while u > 0 and (k_up < high or k_down > low):
        if k_up < high:
            p_up *= (good - k_up) * (draws - k_up) / ((k_up + 1) * (bad - draws + k_up + 1))
            k_up += 1
            u -= p_up
            if u <= 0:
                return k_up
        if k_down > low:
            p_down *= k_down * (bad - draws + k_down) / ((good - k_down + 1) * (draws - k_down + 1))
            k_down -= 1
            u -= p_down
            if u <= 0:
                return k_down
    return mode


def communication_matrix(cells: Sequence[int], shards: Sequence[int], seed: int) -> list[list[int]]:
    """Counts from each cell to each shard; rows add up to ``cells``, columns to ``shards``."""
    rng = np.random.default_rng(seed)
    left, out = list(shards), []
    for size in cells:
        rest, need, row = sum(left), size, []
        for j, good in enumerate(left):
            k = hypergeometric(rng, good, rest - good, need)
            rest, need = rest - good, need - k
            left[j] -= k
            row.append(k)
        out.append(row)
    return out


def _log2_at_least(n: int) -> int:
    return max(0, (n - 1).bit_length())


def uniform_shards(df: DataFrame, shards: int = 16, seed: int = 1, cells: int | None = None) -> DataFrame:
    """Append ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in
    each shard): a uniform shuffle of all rows, with shard sizes at most one
    apart.

    Rows are told apart by all their columns (which must be hashable: no
    maps); fully equal rows are interchangeable and all kept. Nulls are
    values like any other. With fewer rows than shards some shards are empty;
    an empty table stays empty. Columns named ``shard`` or ``slot`` are
    replaced.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells or min(MOST, PER_PARTITION * partitions)
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    columns = [F.col(f"`{c}`") for c in names]
    hashed = lambda k: F.xxhash64(F.lit(seed * 4 + k), *columns)
    base = df.select(*columns, F.pmod(hashed(0), F.lit(cells)).cast("int").alias("__cell"),
                     hashed(1).alias("__first"), hashed(2).alias("__second"))
    counts = [0] * cells
    for r in base.groupBy("__cell").count().collect():  # one row for each cell
        counts[r["__cell"]] = r["count"]
    total = sum(counts)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    upto = [np.cumsum(row).tolist() for row in communication_matrix(counts, sizes, seed)]
    rows = json.dumps([{"c": i, "u": u} for i, u in enumerate(upto) if u[-1]])
    matrix = spark.range(1).select(F.explode(F.from_json(F.lit(rows), "array<struct<c:int,u:array<long>>>")).alias("m")
                                   ).select(F.col("m.c").alias("__cell"), F.col("m.u").alias("__upto"))
    rank = F.row_number().over(Window.partitionBy("__cell").orderBy("__first", "__second"))
    dealt = (base.withColumn("__rank", rank).join(F.broadcast(matrix), "__cell")
             .withColumn("shard", F.size(F.filter("__upto", lambda u: u < F.col("__rank"))).cast("int")))
    bits = _log2_at_least(min(MOST, max(1, -(-PER_PARTITION * partitions // shards))))
    slice_ = F.shiftrightunsigned("__second", 64 - bits).cast("int") if bits else F.lit(0)
    sliced = dealt.withColumn("__slice", slice_).select(*columns, "shard", "__slice", "__second", "__first")
    offset = (sliced.groupBy("shard", "__slice").count()
              .select("shard", "__slice", (F.sum("count").over(
                  Window.partitionBy("shard").orderBy("__slice")) - F.col("count")).alias("__before")))
    within = F.row_number().over(Window.partitionBy("shard", "__slice").orderBy("__second", "__first"))
    return (sliced.withColumn("__within", within)
            .join(F.broadcast(offset), ["shard", "__slice"])  # at most shards x slices rows
            .select(*columns, "shard", (F.col("__before") + F.col("__within") - 1).cast("long").alias("slot")))
