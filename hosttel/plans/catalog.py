"""Query catalogue: each entry is a Spark query over the driver tables and,
where one exists, the same query as DuckDB SQL (the correctness oracle).

Queries run over whole tables. Column names are aliased identically on both
sides; computed doubles are rounded to ``DIGITS`` places on both sides so
summation order cannot change the compared value.
"""

from __future__ import annotations

from . import (  # noqa: F401
    queries_batch,
    queries_messages,
    queries_models,
    queries_process,
    queries_sources,
    queries_streams,
    queries_trees,
)
from .registry import DIGITS, ORACLE, QUERIES, register, with_views  # noqa: F401
