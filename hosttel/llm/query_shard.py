"""op2: all documents in sixteen shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import shard
from .registry import register, table

SHARDS = 16


@register("op2_communication_matrix")
def op2_communication_matrix(spark, sf_dir):
    """No SQL (random draws); sizes, slots and uniformity are tested."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return shard.uniform_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
