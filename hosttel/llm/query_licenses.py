"""op11: licence scan of all documents."""

from __future__ import annotations

from . import licenses
from .registry import register, table


@register("op11_license_scan")
def op11_license_scan(spark, sf_dir):
    """No SQL (licence expressions); tested against plain patterns."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.license_scan(docs, keep_text=False)
