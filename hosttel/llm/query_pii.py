"""op6: personal data in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import pii
from .registry import register, table


def listed(column: str):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register("op6_weak_supervision")
def op6_weak_supervision(spark, sf_dir):
    """No SQL (fitted classifier); the base is tested against plain regular expressions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.detect(docs, pii.fit(docs), keep_text=False)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"))
