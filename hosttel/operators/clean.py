"""Cleaning projections.

The reference cleans with row-at-a-time Python UDFs; here every cleaned
column is a native expression, so the whole projection is one codegen stage
and filters above it still push into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import COMPAT, size_to_double, size_to_long, strip_brackets
from ..schemas import MEMORY_FLOAT_SIZE_COLUMNS, MEMORY_INT_SIZE_COLUMNS


def clean_sizes(df: DataFrame, double_cols=(), long_cols=(), mode: str = COMPAT,
                float32: bool = False) -> DataFrame:
    """Replace unit-text columns by numbers in one projection."""
    repl = {}
    for c in double_cols:
        e = size_to_double(c, mode)
        repl[c] = e.cast("float") if float32 else e
    for c in long_cols:
        repl[c] = size_to_long(c, mode)
    return df.withColumns(repl) if repl else df


def clean_command(df: DataFrame, col: str = "CMD") -> DataFrame:
    """Strip ``<``/``>`` from the command name."""
    return df.withColumn(col, strip_brackets(col))


def clean_memory(df: DataFrame, mode: str = COMPAT, float32: bool = False,
                 cmd_col: str = "CMD") -> DataFrame:
    """The reference's memory cleaning: seven size columns to double, ``MINFLT``
    to bigint, ``CMD`` unbracketed — in a single projection."""
    out = clean_sizes(df, MEMORY_FLOAT_SIZE_COLUMNS, MEMORY_INT_SIZE_COLUMNS, mode, float32)
    return clean_command(out, cmd_col)


def clean_process(df: DataFrame, cmd_col: str = "CMD") -> DataFrame:
    return clean_command(df, cmd_col)


def with_label(df: DataFrame, source: str = "attack", name: str = "label") -> DataFrame:
    """Copy the class column as an int ``label``."""
    return df.withColumn(name, F.col(source).cast("int"))
