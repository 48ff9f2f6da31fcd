"""Text-encoded sizes and command names as native column expressions.

All of these are Catalyst expressions: they stay inside whole-stage codegen,
push through projections and never leave the JVM. Bad text becomes null
(``try_cast``) instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# --- fixed values: unit suffixes and the text each one is replaced by ------
# The reference rewrites the suffix as literal zeros (text, not arithmetic),
# then removes spaces and parses the result.
UNIT_ZEROS = [("K", "000"), ("M", "000000"), ("G", "000000000")]
# Multipliers for the arithmetic ("scaled") reading of the same suffixes.
UNIT_FACTORS = {"K": 1e3, "M": 1e6, "G": 1e9}

COMPAT = "compat"
SCALED = "scaled"


def _zero_text(c: Column) -> Column:
    for suffix, zeros in UNIT_ZEROS:
        c = F.replace(c, F.lit(suffix), F.lit(zeros))
    return F.replace(c, F.lit(" "), F.lit(""))


def _scaled_number(c: Column) -> Column:
    """Number part times the factor of a trailing K/M/G (spaces removed)."""
    s = F.replace(c, F.lit(" "), F.lit(""))
    last = F.substring(s, -1, 1)
    factor = F.coalesce(
        *[F.when(last == F.lit(u), F.lit(f)) for u, f in UNIT_FACTORS.items()], F.lit(1.0)
    )
    has_unit = last.isin(*UNIT_FACTORS)
    # the text without its unit letter when one is present, else the whole text
    body = F.when(has_unit, F.left(s, F.length(s) - 1)).otherwise(s)
    return body.try_cast("double") * factor


def size_to_double(c, mode: str = COMPAT) -> Column:
    """Size text → double (F1).

    ``compat``: the suffix becomes literal zeros, so ``"3K"`` → 3000 and
    ``"1.5K"`` → ``"1.5000"`` → 1.5, as in the reference. ``scaled``: the
    suffix multiplies, so ``"1.5K"`` → 1500. Unparsable text → null.
    """
    c = as_col(c)
    if mode == COMPAT:
        return _zero_text(c).try_cast("double")
    if mode == SCALED:
        return _scaled_number(c)
    raise ValueError(f"unknown size mode {mode!r}")


def size_to_long(c, mode: str = COMPAT) -> Column:
    """Size text → bigint (F2). ``compat`` fails (null) on fractional text
    such as ``"1.5K"``; ``scaled`` rounds the scaled value toward zero."""
    c = as_col(c)
    if mode == COMPAT:
        return _zero_text(c).try_cast("bigint")
    if mode == SCALED:
        return _scaled_number(c).try_cast("bigint")
    raise ValueError(f"unknown size mode {mode!r}")


def strip_brackets(c, left: str = "<", right: str = ">") -> Column:
    """Remove every leading ``<`` and every trailing ``>``."""
    return F.rtrim(F.ltrim(as_col(c), F.lit(left)), F.lit(right))


def parse_int(c) -> Column:
    """``int(x)`` on text (F6): whole-number text → bigint, else null."""
    return as_col(c).try_cast("bigint")


def parse_int_of_float(c) -> Column:
    """``int(float(x))`` on text (F6): parse as double, truncate toward zero."""
    return as_col(c).try_cast("double").try_cast("bigint")
