"""Imports every query module of the subpackage."""

from __future__ import annotations

from . import (  # noqa: F401
    query_collocations,
    query_licenses,
    query_decontam,
    query_near_dup,
    query_pii,
    query_quality,
    query_revisit,
    query_shard,
    query_substring,
    query_tokens,
    query_url,
    query_whitening,
)
from .registry import ORACLE, QUERIES  # noqa: F401
