"""Missing-value audit.

One aggregate computes a count per column in a single scan. What counts as
missing depends on the column type: null everywhere; NaN for float/double;
for text, null or text that parses as NaN (``isnan(try_cast(c as double))``,
which matches the reference's implicit cast without failing under ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def missing_flag(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    if isinstance(dt, T.StringType):
        # only texts that hold the letters can parse as NaN; all others skip the cast
        return col.isNull() | (F.contains(F.lower(col), F.lit("nan"))
                               & F.coalesce(F.isnan(col.try_cast("double")), F.lit(False)))
    return col.isNull()


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row; for each column the number of missing values (bigint)."""
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(missing_flag(df, c)).alias(c) for c in columns])
