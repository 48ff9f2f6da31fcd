"""Repeated rows without streaming state (ST5).

Keys that were seen are Parquet tables in the shared folder, one per
micro-batch and bucket; a Bloom filter in front of them, cut into blocks of
one bitmap each, tells most new rows without reading any key. A batch

1. keeps one row of each key among its own rows,
2. looks each key up in its block: a key that lacks a bit there is new,
3. joins only the others with the keys seen, of the same buckets,
4. writes the new rows, their keys and the blocks they change under its id.

Nothing is held between batches: no state store grows with the keys, and no
watermark has to span the stream. Every table is written under the batch's id
and only tables of earlier ids are read, so a replayed batch replaces its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Blocks of the filter (4 KB each, so 16 MB in all), bits set for a key, and buckets of the key tables.
BLOCKS, HASHES, BUCKETS = 4096, 5, 64
_BITS = 32768  # of a block: what one bitmap aggregate holds

_BLOCK_SCHEMA = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("bits", T.BinaryType()),
                              T.StructField("batch", T.IntegerType())])


def _block(keys: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), *keys), F.lit(blocks)).cast("int")


def _positions(keys: list[str]) -> Column:
    """The bits of a key in its block (from 0)."""
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(_BITS)).cast("int") for i in range(HASHES)])


def _has_all(bits: Column, positions: Column) -> Column:
    """Whether all ``positions`` are set in a bitmap."""
    def is_set(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, F.floor(p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, p % 8) == 1
    return F.forall(positions, is_set)


def bloom_blocks(keyed: DataFrame, keys: list[str], blocks: int = BLOCKS) -> DataFrame:
    """``(block, bits)``: the filter's blocks that hold the keys of ``keyed``, by one partial aggregate."""
    each = keyed.select(_block(keys, blocks).alias("block"), F.explode(_positions(keys)).alias("p"))
    return each.groupBy("block").agg(F.bitmap_construct_agg(F.col("p").cast("long")).alias("bits"))


def _earlier(spark: SparkSession, path: str, batch_id: int, schema: T.StructType | None = None) -> DataFrame | None:
    """The tables under ``path`` of batches before ``batch_id``; null when there are none."""
    if batch_id == 0:
        return None
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path).where(F.col("batch") < batch_id)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def split_by_filter(fresh: DataFrame, blocks: DataFrame, keys: list[str], n_blocks: int = BLOCKS) -> DataFrame:
    """``fresh`` with ``__maybe_seen``: false for a key that the filter's blocks rule out.
    The blocks are a table of proven size, so they are broadcast."""
    table = blocks.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    looked = fresh.withColumn("__block", _block(keys, n_blocks)).join(F.broadcast(table), "__block", "left")
    seen = F.col("__bits").isNotNull() & _has_all(F.col("__bits"), _positions(keys))
    return looked.withColumn("__maybe_seen", seen).drop("__block", "__bits")


def maybe_in(df: DataFrame, keyed: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with ``__maybe_seen``: false for a row whose key is surely not in ``keyed``, a written table.
    The filter has 16 bits for each of its rows, up to the size of ``BLOCKS``."""
    n_blocks = min(BLOCKS, 16 * keyed.count() // _BITS + 1)
    return split_by_filter(df, bloom_blocks(keyed, keys, n_blocks), keys, n_blocks)


def _is_known(keys: list[str]) -> Column:
    """Equal keys of equal buckets; null equals null, as for ``dropDuplicates``."""
    return reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys],
                  F.col("l.__bucket") == F.col("r.__bucket"))


def _newest(blocks: DataFrame) -> DataFrame:
    """The last table of each block, which holds all earlier ones."""
    return blocks.groupBy("block").agg(F.max_by("bits", "batch").alias("bits"))


def _new_rows(batch: DataFrame, keys: list[str], path: str, batch_id: int, buckets: int, n_blocks: int) -> DataFrame:
    """The batch's rows with ``__bucket`` whose key neither it nor an earlier batch held before."""
    spark = batch.sparkSession
    fresh = batch.dropDuplicates(keys).withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    blocks = _earlier(spark, f"{path}/filter", batch_id, _BLOCK_SCHEMA)
    key_schema = T.StructType([*[fresh.schema[k] for k in keys], T.StructField("batch", T.IntegerType()),
                               T.StructField("__bucket", T.IntegerType())])
    known = _earlier(spark, f"{path}/keys", batch_id, key_schema)
    if blocks is None or known is None:
        return fresh
    tested = split_by_filter(fresh, _newest(blocks), keys, n_blocks)
    again = tested.where("__maybe_seen").alias("l").join(known.alias("r"), _is_known(keys), "left_anti")
    return tested.where("NOT __maybe_seen").unionByName(again.select(*tested.columns)).drop("__maybe_seen")


def write_unique(rows: DataFrame, keys: list[str], path: str, checkpoint: str, buckets: int = BUCKETS,
                 blocks: int = BLOCKS, available_now: bool = False, trigger: str = "5 seconds",
                 each: Callable[[DataFrame, int], None] | None = None):
    """Write every row of a stream whose ``keys`` were not seen before (ST5).

    Rows go to ``path/rows``; read them with ``read_unique``. However late a
    copy comes, the first row of its key stays the only one: the key tables are
    the whole memory and lie in the shared folder. A null key is a key like any
    other. ``each`` is called with the new rows of every batch and its id, to
    count or score them; a replayed batch calls it again. Returns the
    ``StreamingQuery``.
    """
    path, keys = path.rstrip("/"), list(keys)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = _new_rows(batch, keys, path, batch_id, buckets, blocks)
        new.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        written = spark.read.schema(new.schema).parquet(f"{path}/rows/batch={batch_id}")
        if each is not None:
            each(written.drop("__bucket"), batch_id)
        written.select(*keys, "__bucket").write.mode("overwrite").partitionBy("__bucket").parquet(f"{path}/keys/batch={batch_id}")
        # by block first: a task then sorts its share of the keys, and no bitmap is made twice
        made = bloom_blocks(written.select(*keys).repartition(buckets, _block(keys, blocks)), keys, blocks)
        before = _earlier(spark, f"{path}/filter", batch_id, _BLOCK_SCHEMA)
        if before is not None:
            changed = _newest(before).join(made.select("block"), "block", "left_semi")
            made = changed.unionByName(made).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))
        made.write.mode("overwrite").parquet(f"{path}/filter/batch={batch_id}")

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def read_unique(spark: SparkSession, path: str) -> DataFrame:
    """All rows written so far, each key once."""
    return spark.read.parquet(f"{path.rstrip('/')}/rows").drop("batch", "__bucket")
