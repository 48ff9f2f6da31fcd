"""op7: verdicts on all pages' URLs."""

from __future__ import annotations

from . import url_lm
from .registry import register, table

RULES = [url_lm.Rule("allow", "com", "/"), url_lm.Rule("block", "example.com", "/en/"),
         url_lm.Rule("allow", "www.example.com", "/en/"), url_lm.Rule("block", "net", "/es/"),
         url_lm.Rule("block", "net", "/fr/")]


@register("op7_language_model_ratio")
def op7_language_model_ratio(spark, sf_dir):
    """No SQL (fitted models); rules are tested by brute force, the models on held-out URLs."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_lm.judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "score")
