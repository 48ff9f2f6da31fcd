"""Profiling.

All of these are aggregates with partial (map-side) combine, so a hot key
costs one partial row per task, never a gathered group. Results are small
and stay distributed; callers ``show()`` them.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .ordinal import prefix_sums
from .sample import exact_sample

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """Total rows (A1)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def class_counts(df: DataFrame, label: str = "attack", name: str = "Total") -> DataFrame:
    """Rows per class with ``count(label)`` (A3, O3): a null class gets 0."""
    return df.groupBy(label).agg(F.count(label).alias(name)).orderBy(label)


def value_counts(df: DataFrame, col: str, name: str = "Total") -> DataFrame:
    """Frequency of each value of ``col`` (A4)."""
    return df.groupBy(col).agg(F.count(col).alias(name))


def top_values(df: DataFrame, col: str, k: int = 10, name: str = "Total") -> DataFrame:
    """Top ``k`` values by frequency, ties by value (A4 + O1).

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    ``k`` rows, so the final merge is ``k × tasks`` rows.
    """
    return value_counts(df, col, name).orderBy(F.desc(name), F.asc_nulls_first(col)).limit(k)


def top_values_many(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """Top ``k`` values of several categorical columns in one pass (A4, O1).

    Columns are stacked as ``(column, value)`` text pairs and counted by one
    partial aggregate. The rank filter is a window group limit: every task
    keeps ``k`` rows of a column before the shuffle, so a column with many
    distinct values is not sorted in one task. Nulls are not counted, as with
    ``count(col)``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    counts = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = Window.partitionBy("column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def count_cells(df: DataFrame, col: str, cells: int = 1 << 16) -> DataFrame:
    """``(cell, n)``: rows per hashed value, a sketch of at most ``cells`` rows.
    A value is in its cell at most as often as ``n`` says; sketches of parts of
    a table add up."""
    cell = F.pmod(F.xxhash64(F.col(col)), F.lit(cells)).cast("int")
    return df.where(F.col(col).isNotNull()).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))


def heavy_hitters(df: DataFrame, col: str, k: int = 10, name: str = "Total", cells: int = 1 << 16,
                  first: int | None = None) -> DataFrame:
    """The exact top ``k`` values of a column of any number of values, ties by
    value (A4, O1): ``(col, name)``, as ``top_values`` without nulls.

    A first pass counts cells of hashed values; a cell's count bounds that of
    every value in it. A second pass counts the values of the ``first``
    fullest cells exactly (only those rows meet in a shuffle). The ``k``-th
    best so far is a bound: fuller cells that were not looked at are counted
    too, until none is left. So the answer is exact, whatever the hash does.
    """
    sketch = checkpointed(count_cells(df, col, cells))
    first = 4 * k if first is None else first
    done: list[int] = []
    best = None
    while True:
        # the fullest cells not counted yet; each round takes more of them
        rest = sketch.where(~F.col("cell").isin(done)) if done else sketch
        bound = None
        if best is not None:
            last = best.agg(F.count(F.lit(1)).alias("k"), F.min(name).alias("n")).first()
            bound = last["n"] if last["k"] == k else 0
            rest = rest.where(F.col("n") >= bound)
        found = [r["cell"] for r in rest.orderBy(F.desc("n"), "cell").limit(first).collect()]  # ``first`` numbers
        if not found:
            break
        done += found
        cell = F.pmod(F.xxhash64(F.col(col)), F.lit(cells)).cast("int")
        picked = F.broadcast(df.sparkSession.createDataFrame([(c,) for c in found], "_cell int"))
        part = (df.where(F.col(col).isNotNull()).select(F.col(col), cell.alias("_cell")).join(picked, "_cell")
                .groupBy(col).agg(F.count(F.lit(1)).alias(name)))
        top = part if best is None else best.unionByName(part)
        best = checkpointed(top.orderBy(F.desc(name), F.asc(col)).limit(k))
        first *= 4
    if best is None:
        return df.select(col).where("false").groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return best.orderBy(F.desc(name), F.asc(col))


def sum_by(df: DataFrame, key: str = "type", value: str = "attack",
           name: str = "total_attacks") -> DataFrame:
    """Attacks per attack type, largest first (A5, O2, V1)."""
    return df.groupBy(key).agg(F.sum(value).alias(name)).orderBy(F.desc(name), F.asc(key))


def arg_extremes(df: DataFrame, x: str, y: str, pos: str, group_by=()) -> DataFrame:
    """Arg-max and arg-min of series ``y`` over ``x`` with first-occurrence
    tie-break on ``pos`` (A13, A14). One partial aggregate per group."""
    g = list(group_by)
    aggs = [
        F.max(y).alias(f"max_{y}"),
        F.max_by(x, F.struct(F.col(y), -F.col(pos))).alias(f"argmax_{x}"),
        F.min(y).alias(f"min_{y}"),
        F.min_by(x, F.struct(F.col(y), F.col(pos))).alias(f"argmin_{x}"),
    ]
    return df.groupBy(*g).agg(*aggs) if g else df.agg(*aggs)


PROFILE_STATS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Stack numeric columns into ``(column, value double)`` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return df.select(F.inline(pairs))


def numeric_profile(df: DataFrame, cols: list[str] | None = None, digits: int = 2,
                    method: str = "exact", accuracy: int = 10_000,
                    half_even: bool = False) -> DataFrame:
    """count, mean, sample std, min, quartiles, max per numeric column.

    One row per column. ``method="exact"`` gives linearly interpolated
    quartiles (like the reference's local ``describe``) from a distributed
    sort: the column values are ranked with the skew-safe ordinal, so no
    task ever holds a whole column. ``method="approx"`` uses
    ``percentile_approx`` sketches (one partial aggregate, cheapest).
    Null and NaN values are left out of every statistic. Values are rounded
    to ``digits`` half-up, or half-to-even (``bround``) with ``half_even``,
    which is how the reference's local rounding behaves.
    """
    cols = list(cols or numeric_columns(df))
    long = _long_values(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = [F.count("value").alias("count"), F.avg("value").alias("mean"),
               F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
               F.max("value").alias("max")]
    probs = [0.25, 0.5, 0.75]
    if method == "approx":
        q = long.groupBy("column").agg(*moments, F.percentile_approx("value", probs, accuracy).alias("q"))
        out = q.select("*", *[F.col("q")[i].alias(n) for i, n in enumerate(["p25", "p50", "p75"])])
    elif method == "exact":
        out = exact_quantiles(long, "value", probs, ["column"], ["p25", "p50", "p75"], accuracy, also=moments)
    else:
        raise ValueError(method)
    rnd = F.bround if half_even else F.round
    r = (lambda c: rnd(F.col(c), digits)) if digits is not None else F.col
    return out.select("column", F.col("count"), *[r(c).alias(c) for c in PROFILE_STATS[1:]])


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group_by=(),
                    names: list[str] | None = None, accuracy: int = 10_000,
                    broadcast_rows: int = 2_000_000, also: list | tuple = ()) -> DataFrame:
    """Exact linearly interpolated quantiles (``quantile_cont``) per group,
    without sorting all values; ``also`` are further aggregates per group.

    1. one pass: ``percentile_approx`` at ``p ∓ 2/accuracy`` brackets each
       exact quantile in ``[L, U]`` (the sketch's rank error is at most
       ``n/accuracy``), with the exact count ``n`` and ``also``;
    2. one pass over the rows with the brackets (a table of groups ×
       quantiles rows, broadcast up to ``broadcast_rows``): counts by value
       inside a bracket, and one count of all rows below it. Equal values
       collapse before the shuffle, so no value is hot;
    3. running sums of these counts within (group, quantile), by ranges that
       split a large group; the values whose ranks hold ``p·(n−1)`` are
       interpolated.
    """
    g = list(group_by)
    names = names or [f"q{int(p * 100)}" for p in probs]
    if not g:
        whole = df.withColumn("_one", F.lit(0))
        return exact_quantiles(whole, value, probs, ["_one"], names, accuracy, broadcast_rows, also).drop("_one")
    eps = 2.0 / accuracy
    ends = [max(0.0, p - eps) for p in probs] + [min(1.0, p + eps) for p in probs]
    data = df.withColumn("_qv", F.col(value).cast("double")).where(F.col("_qv").isNotNull())
    sketch = checkpointed(data.groupBy(*g).agg(
        F.percentile_approx("_qv", ends, accuracy).alias("_qs"), F.count(F.lit(1)).alias("_qn"), *also))
    k = len(probs)
    bounds = sketch.select(*[F.col(c).alias(f"_qg_{c}") for c in g], F.posexplode(F.arrays_zip(
        F.slice("_qs", 1, k).alias("lo"), F.slice("_qs", k + 1, k).alias("hi"))).alias("_qk", "_qb"))
    bounds = bounds.select(*[f"_qg_{c}" for c in g], "_qk", F.col("_qb.lo").alias("_qL"), F.col("_qb.hi").alias("_qU"))
    if bounds.count() <= broadcast_rows:
        bounds = F.broadcast(bounds)
    inside = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_qg_{c}")) for c in g],
                    F.col("_qv") <= F.col("_qU"))
    keys = [*g, "_qk"]
    counts = (data.select(*g, "_qv").join(bounds, inside)
              .groupBy(*keys, F.when(F.col("_qv") >= F.col("_qL"), F.col("_qv")).alias("_qv"))  # null: below
              .agg(F.count(F.lit(1)).alias("_qc")))
    summed = prefix_sums(counts, [F.asc_nulls_first("_qv")], ["_qc"], ["_qr"], group_by=keys)
    of = sketch.select(*[F.col(c).alias(f"_qg_{c}") for c in g], "_qn")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_qg_{c}")) for c in g])
    pos = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_qk")) * (F.col("_qn") - 1)

    def at(rank):  # the value that holds a 0-based rank
        return F.max(F.when((F.col("_qr") > rank) & (F.col("_qr") - F.col("_qc") <= rank), F.col("_qv")))

    per_q = summed.join(of, same).groupBy(*keys).agg(
        at(F.floor(pos)).alias("_lo"), at(F.ceil(pos)).alias("_hi"), F.first(pos - F.floor(pos)).alias("_f"))
    val = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")
    aggs = [F.max(F.when(F.col("_qk") == i, val)).alias(nm) for i, nm in enumerate(names)]
    return sketch.drop("_qs", "_qn").join(per_q.groupBy(*g).agg(*aggs), g, "left")


def correlation_pairs(df: DataFrame, cols: list[str] | None = None, digits: int | None = 6) -> DataFrame:
    """Pearson correlation of every column pair, long form ``(x, y, r)``.

    One aggregate with one ``corr`` per pair over the rows where both values
    are present (null and NaN skipped, like the reference's local ``corr``);
    the diagonal is 1. Both orders are emitted.
    """
    cols = list(cols or numeric_columns(df))
    pairs = list(combinations(cols, 2))

    def clean(c):
        # NaN → null, so a pair skips the row like pandas (corr ignores nulls)
        d = F.col(c).cast("double")
        return F.when(~F.isnan(d), d)

    row = df.agg(*[F.corr(clean(a), clean(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    items = []
    for i, (a, b) in enumerate(pairs):
        items.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{i}").alias("r")))
        items.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"{i}").alias("r")))
    for c in cols:
        items.append(F.struct(F.lit(c).alias("x"), F.lit(c).alias("y"), F.lit(1.0).alias("r")))
    out = row.select(F.inline(F.array(*items)))
    if digits is not None:
        # "+ 0.0" turns a rounded -0.0 into 0.0
        out = out.withColumn("r", F.round("r", digits) + F.lit(0.0))
    return out


def grid_density(df: DataFrame, x: str, y: str, x_width: float, y_width: float,
                 label: str = "attack", log_scale: bool = False) -> DataFrame:
    """Scatter-plot data as 2-D grid counts per class (V2, V3).

    Replaces pulling every point to the driver: the output size is bounded by
    the number of occupied cells, not the number of rows. ``log_scale`` bins
    ``log10(1 + v)`` instead of ``v`` (widths then count decades), for sizes
    whose unit suffixes make them heavy-tailed.
    """
    def axis(c, w):
        v = F.log10(F.lit(1.0) + F.col(c)) if log_scale else F.col(c)
        return F.floor(v / F.lit(float(w))).cast("bigint")

    return (df.groupBy(axis(x, x_width).alias("x_bin"), axis(y, y_width).alias("y_bin"),
                       F.col(label))
            .agg(F.count(F.lit(1)).alias("n")))


def scatter_sample(df: DataFrame, cols: list[str], label: str = "attack", fraction: float = 0.01,
                   seed: int = 0, size: int | None = None, key: str | None = None) -> DataFrame:
    """A uniform sample of points for drawing (V2, V3). With ``size`` and
    ``key`` exactly so many of each class, always the same ones
    (``exact_sample``); else every class keeps the same fraction."""
    if size is None:
        return df.select(*cols, label).sample(fraction=fraction, seed=seed)
    if key is None:
        raise ValueError("a sample of a fixed size needs a key column")
    return exact_sample(df.select(*dict.fromkeys([*cols, label, key])), size, key, label, seed).select(*cols, label)
