"""op13: whitened embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import whitening
from .registry import register, table


@register("op13_block_whitening")
def op13_block_whitening(spark, sf_dir):
    """No SQL (eigenvectors); tested against numpy. ``deviation`` is exact: an
    error where it does not fit a long."""
    return whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(
        "vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"),
        "whitened", "explained", "identity_error")
