"""op8: near-duplicate groups of all documents."""

from __future__ import annotations

from . import near_dup
from .registry import register, table

SHINGLE_WORDS, LIMIT = 4, 80


@register("op8_hyperminhash")
def op8_hyperminhash(spark, sf_dir):
    """No SQL (sketches); tested against brute force over all pairs."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=SHINGLE_WORDS, limit=LIMIT).select(
        "doc_id", "n_shingles", "component_id", "kept")
