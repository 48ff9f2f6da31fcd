"""Skew-safe row numbers within groups.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends every row of a group
to one task. Telemetry has few machines, so one machine can hold a third of
all rows; that task would sort terabytes alone. ``ordinal`` computes the same
numbers without ever gathering a group, by one of two methods.

**bucket** (one ascending integer/date/timestamp order column — sequence
numbers, times; chosen automatically): hot groups are cut into
equal-width value buckets (if that leaves a bucket too large, the ranged
method is taken), rows are numbered by a window partitioned by
``(group, bucket)``, and counts of earlier buckets are added. No rows are
checkpointed; see ``_ordinal_bucketed``.

**ranged** (any order, e.g. ``[desc(n), value]``):

1. range-partition on ``(g, o)`` into ``n`` partitions and sort within each
   partition. Range bounds are sampled, so a hot group spans many
   partitions;
2. tag rows with ``spark_partition_id()`` and ``monotonically_increasing_id()``
   (consecutive inside a partition after the sort);
3. aggregate a small table of ``(partition, group) → count, first id``; a
   window over it (partitioned by group: at most ``n`` rows per group) turns
   counts into the number of rows of the group in earlier partitions;
4. join that table back on ``(partition, group)``; row number =
   earlier rows + position inside the partition.

The table in step 3 has at most ``n + G - 1`` rows (``G`` distinct groups):
each partition covers a contiguous key range. It is checkpointed (small)
and broadcast when its exact row count is under ``broadcast_rows``;
otherwise it is joined by a shuffle on ``(partition, group)``, which splits
hot groups too.

In the ranged method the tagged rows are written once with ``checkpoint()``
to the shared folder named by ``spark.checkpoint.dir``: both branches then
read the same ids (two separate range exchanges could sample different
bounds), and a lost executor re-reads them instead of recomputing.

Order keys should form a total order within a group; on ties the numbers are
a valid but arbitrary permutation of the tied rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefmt import ntz_epoch_seconds
from ..session import checkpointed

DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_ROWS_PER_BUCKET = 1_000_000

_T = "_ord_t"
_P, _M, _C, _M0, _OFF, _TOT = "_ord_p", "_ord_m", "_ord_c", "_ord_m0", "_ord_off", "_ord_tot"


def _sort_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _partitions(df: DataFrame, partitions: int | None) -> int:
    """Range partitions: explicit, else the session's shuffle partitions
    (scale them with the input, e.g. ``session.size_for``). The input's own
    partition count is not consulted: asking an adaptive plan for it would
    execute its shuffles."""
    if partitions:
        return int(partitions)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def ordinal(df: DataFrame, order_by: list, group_by: list[str] | tuple = (), name: str = "rn",
            group_size: str | None = None, partitions: int | None = None,
            broadcast_rows: int = DEFAULT_BROADCAST_ROWS, method: str = "auto",
            rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> DataFrame:
    """Add ``name`` = 1-based row number within ``group_by`` ordered by ``order_by``.

    ``group_size`` (optional) adds the number of rows in the row's group.
    ``order_by`` entries may be names or sort columns (``F.desc("x")``).

    ``method``: ``"bucket"`` (one ascending numeric or temporal order column;
    no row checkpoint, see ``_ordinal_bucketed``), ``"ranged"`` (any order;
    range partitioning + checkpoint), or ``"auto"``: bucket for integer, date
    and timestamp keys, ranged otherwise (doubles may be heavy-tailed).
    """
    group_by = list(group_by)
    if method == "auto":
        method = "bucket" if _numeric_single(df, order_by, spread_keys_only=True) else "ranged"
    if method == "bucket":
        return _ordinal_bucketed(df, order_by[0], group_by, name, group_size, broadcast_rows,
                                 rows_per_bucket)
    if method != "ranged":
        raise ValueError(method)
    return _ordinal_ranged(df, order_by, group_by, name, group_size, partitions, broadcast_rows)


def _numeric_single(df: DataFrame, order_by: list, spread_keys_only: bool = False) -> bool:
    """One ascending numeric/temporal order column. With ``spread_keys_only``,
    only integer, date and timestamp keys qualify: sequence numbers and times
    spread evenly enough for equal-width buckets, while measured values
    (doubles: sizes, scores) can be heavy-tailed and are left to the range
    partitioner, which samples quantiles."""
    if len(order_by) != 1 or not isinstance(order_by[0], str):
        return False
    dt = df.schema[order_by[0]].dataType
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampType,
             T.TimestampNTZType)
    if not spread_keys_only:
        kinds = kinds + (T.FloatType, T.DoubleType)
    return isinstance(dt, kinds)


def _order_number(df: DataFrame, order: str) -> Column:
    """A number that never decreases as the order value increases (all the
    bucketing needs). ``TIMESTAMP_NTZ`` is read as a UTC wall clock rather than
    through the session zone, whose DST gaps would break monotonicity."""
    dt = df.schema[order].dataType
    c = F.col(order)
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dt, T.TimestampNTZType):
        return ntz_epoch_seconds(c).cast("double")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c).cast("double")
    return c.cast("double")


def _ordinal_bucketed(df: DataFrame, order: str, group_by: list[str], name: str,
                      group_size: str | None, broadcast_rows: int, rows_per_bucket: int) -> DataFrame:
    """Row numbers for one ascending numeric order column, without checkpointing rows.

    1. *hot* groups — more than ``rows_per_bucket`` rows — get their order
       range cut into ``ceil(count / rows_per_bucket)`` equal-width buckets
       (bucket is monotone in the value). There are at most
       ``N / rows_per_bucket`` hot groups, so their ``(min, max, buckets)``
       table has a proven bound and is broadcast; every other group is
       bucket 0;
    2. ``row_number()`` over a window partitioned by ``(group, bucket)`` — the
       only shuffle of whole rows; a hot group is spread over its buckets;
    3. offsets = rows of the group in earlier buckets, from a key-only
       partial aggregate (at most ``G + N / rows_per_bucket`` rows), joined
       back on ``(group, bucket)``: broadcast under ``broadcast_rows``, else a
       shuffle join on that pair (hot groups stay split).

    Every step is a pure function of the data, so recomputation (lost
    executors, two branches) yields the same numbers. Null order values sort
    first, as in the ranged method. Ties get consecutive numbers in an
    arbitrary order.
    """
    gs = {g: f"_ob_g{i}" for i, g in enumerate(group_by)}
    keyed = df.withColumn("_ob_v", _order_number(df, order))
    per_group = keyed.groupBy(*group_by).agg(
        F.min("_ob_v").alias("_ob_lo"), F.max("_ob_v").alias("_ob_hi"),
        F.count(F.lit(1)).alias("_ob_n"))
    nb_expr = F.ceil(F.col("_ob_n") / F.lit(float(rows_per_bucket)))
    if group_by:
        hot = (per_group.where(F.col("_ob_n") > rows_per_bucket)
               .select(*[F.col(g).alias(a) for g, a in gs.items()], "_ob_lo", "_ob_hi",
                       nb_expr.alias("_ob_nb")))
        hot = F.broadcast(checkpointed(hot))   # ≤ N / rows_per_bucket rows
        with_stats = keyed.join(hot, _null_safe_on(group_by, gs), "left").drop(*gs.values())
    else:
        one = per_group.select("_ob_lo", "_ob_hi", nb_expr.alias("_ob_nb")).first()
        with_stats = keyed.select("*", *[F.lit(one[c]).cast("double" if c != "_ob_nb" else "bigint")
                                         .alias(c) for c in ("_ob_lo", "_ob_hi", "_ob_nb")])
    nb = F.coalesce(F.col("_ob_nb"), F.lit(1))
    width = (F.col("_ob_hi") - F.col("_ob_lo")) / nb
    bucket = (F.when(F.col("_ob_v").isNull(), F.lit(-1))
              .when(F.col("_ob_nb").isNull() | (width <= 0), F.lit(0))
              .otherwise(F.least(F.floor((F.col("_ob_v") - F.col("_ob_lo")) / width), nb - 1))
              ).cast("bigint")
    with_b = with_stats.withColumn("_ob_b", bucket).drop("_ob_lo", "_ob_hi", "_ob_nb")

    counts = with_b.groupBy(*group_by, "_ob_b").agg(F.count(F.lit(1)).alias("_ob_c"))
    earlier = Window.partitionBy(*group_by).orderBy("_ob_b").rowsBetween(Window.unboundedPreceding, -1)
    cols = [*[F.col(g).alias(a) for g, a in gs.items()], F.col("_ob_b").alias("_ob_sb"),
            F.coalesce(F.sum("_ob_c").over(earlier), F.lit(0)).alias("_ob_off")]
    if group_size:
        cols.append(F.sum("_ob_c").over(Window.partitionBy(*group_by)).alias("_ob_tot"))
    offs = checkpointed(counts.select(*cols, F.col("_ob_c")))
    if (offs.agg(F.max("_ob_c")).first()[0] or 0) > 2 * rows_per_bucket:
        # unevenly spread values (an outlier, many ties): sampled ranges split them
        return _ordinal_ranged(df, [order], group_by, name, group_size, None, broadcast_rows)
    offs = offs.drop("_ob_c")
    if offs.count() <= broadcast_rows:
        offs = F.broadcast(offs)
    local = Window.partitionBy(*group_by, "_ob_b").orderBy(F.col(order).asc_nulls_first())
    numbered = with_b.withColumn("_ob_r", F.row_number().over(local))
    cond = _null_safe_on(group_by, gs) & (F.col("_ob_b") == F.col("_ob_sb"))
    out = numbered.join(offs, cond, "inner").withColumn(name, F.col("_ob_off") + F.col("_ob_r"))
    if group_size:
        out = out.withColumnRenamed("_ob_tot", group_size)
    return out.drop("_ob_v", "_ob_b", "_ob_r", "_ob_sb", "_ob_off", *gs.values())


def _null_safe_on(group_by: list[str], gs: dict) -> Column:
    if not group_by:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(a)) for g, a in gs.items()])


def _ordinal_ranged(df: DataFrame, order_by: list, group_by: list[str], name: str,
                    group_size: str | None, partitions: int | None,
                    broadcast_rows: int) -> DataFrame:
    """Row numbers for any order: range partitioning + checkpoint (module doc)."""
    n = _partitions(df, partitions)
    keys = [F.col(g).asc_nulls_first() for g in group_by] + [_sort_col(o) for o in order_by]
    # a seeded random last key lets ties be split over partitions, too
    tagged = (df.withColumn(_T, F.rand(0)).repartitionByRange(n, *keys, _T).sortWithinPartitions(*keys, _T)
              .drop(_T)
              .withColumn(_P, F.spark_partition_id())
              .withColumn(_M, F.monotonically_increasing_id()))
    # Both branches below must see the same ids. Column pruning would give the
    # stats branch its own range exchange whose sampled bounds can differ, so
    # materialise once in the shared checkpoint folder (also cuts lineage, so
    # a lost executor re-reads ids instead of recomputing them).
    tagged = checkpointed(tagged)

    stats = tagged.groupBy(_P, *group_by).agg(F.count(F.lit(1)).alias(_C), F.min(_M).alias(_M0))
    earlier = Window.partitionBy(*group_by).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn(_OFF, F.coalesce(F.sum(_C).over(earlier), F.lit(0)))
    if group_size:
        stats = stats.withColumn(_TOT, F.sum(_C).over(Window.partitionBy(*group_by)))
    # distinct names on the small side so nothing is ambiguous after the join
    sg = {g: f"_ord_g{i}" for i, g in enumerate(group_by)}
    stats = stats.select(F.col(_P).alias("_ord_sp"), *[F.col(g).alias(a) for g, a in sg.items()],
                         _M0, _OFF, *([_TOT] if group_size else []))

    # The stats table has at most n + G - 1 rows. Materialise it (small) and
    # broadcast only if its exact size is under the bound; else shuffle-join
    # on (partition, group), which splits hot groups as well.
    stats = checkpointed(stats)
    if not group_by or stats.count() <= broadcast_rows:
        stats = F.broadcast(stats)
    cond = reduce(lambda a, b: a & b,
                  [F.col(g).eqNullSafe(F.col(a)) for g, a in sg.items()],
                  F.col(_P) == F.col("_ord_sp"))
    out = (tagged.join(stats, cond, "inner")
           .withColumn(name, F.col(_M) - F.col(_M0) + F.col(_OFF) + 1))
    if group_size:
        out = out.withColumnRenamed(_TOT, group_size)
    return out.drop(_P, _M, "_ord_sp", _M0, _OFF, *sg.values())


def prefix_sums(df: DataFrame, order_by: list, values: list[str], names: list[str] | None = None,
                rank: str | None = None, partitions: int | None = None, group_by: list[str] | tuple = (),
                broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Running sums of ``values`` in ``order_by`` order, over the whole table or
    within ``group_by``, without a single-task window.

    Rows are range-partitioned on the group and the order and sorted
    (checkpointed, as in ``ordinal``), so a hot group spans partitions; each
    (partition, group) gets its running sums from a window, and the group's
    totals in all earlier partitions are added: a table of at most
    ``n + G - 1`` rows, broadcast up to ``broadcast_rows``. ``rank`` optionally
    adds the 1-based position. Meant for pre-aggregated inputs (e.g. one row
    per distinct score); order keys should be unique for a deterministic order.
    """
    names = names or [f"cum_{v}" for v in values]
    group_by = list(group_by)
    n = _partitions(df, partitions)
    keys = [F.col(g).asc_nulls_first() for g in group_by] + [_sort_col(o) for o in order_by]
    tagged = checkpointed(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                          .withColumn(_P, F.spark_partition_id())
                          .withColumn(_M, F.monotonically_increasing_id()))

    totals = tagged.groupBy(_P, *group_by).agg(*[F.sum(v).alias(f"_pt{i}") for i, v in enumerate(values)],
                                               F.count(F.lit(1)).alias("_ptc"))
    before = Window.partitionBy(*group_by).orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    sg = {g: f"_ord_g{i}" for i, g in enumerate(group_by)}
    offsets = totals.select(
        F.col(_P).alias("_ord_sp"), *[F.col(g).alias(a) for g, a in sg.items()],
        *[F.coalesce(F.sum(f"_pt{i}").over(before), F.lit(0)).alias(f"_po{i}")
          for i in range(len(values))],
        F.coalesce(F.sum("_ptc").over(before), F.lit(0)).alias("_poc"))
    own = Window.partitionBy(_P, *group_by).orderBy(_M)
    within = own.rowsBetween(Window.unboundedPreceding, 0)
    local = tagged.select("*", *[F.sum(v).over(within).alias(f"_pl{i}") for i, v in enumerate(values)],
                          F.row_number().over(own).alias("_plc"))
    if group_by:
        offsets = checkpointed(offsets)
    if not group_by or offsets.count() <= broadcast_rows:  # without groups exactly ``n`` rows
        offsets = F.broadcast(offsets)
    cond = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(a)) for g, a in sg.items()],
                  F.col(_P) == F.col("_ord_sp"))
    out = local.join(offsets, cond)
    return out.select(*df.columns,
                      *[(F.col(f"_pl{i}") + F.col(f"_po{i}")).alias(nm) for i, nm in enumerate(names)],
                      *([(F.col("_plc") + F.col("_poc")).alias(rank)] if rank else []))
