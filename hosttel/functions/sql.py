"""SQL-callable forms of the scalar functions (UD1).

The reference wraps its text helpers in Python UDFs, which are opaque to the
optimizer. Here they are SQL functions whose bodies are plain expressions:
``CREATE TEMPORARY FUNCTION ... RETURN expr`` is inlined by the analyzer, so
plans that call them still get pushdown and whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .units import UNIT_ZEROS


def _zero_text_sql(arg: str = "s") -> str:
    """The unit rule of ``units.UNIT_ZEROS`` as nested SQL ``replace`` calls."""
    expr = arg
    for suffix, zeros in UNIT_ZEROS:
        expr = f"replace({expr}, '{suffix}', '{zeros}')"
    return f"replace({expr}, ' ', '')"


_ZERO_TEXT = _zero_text_sql()

SQL_FUNCTIONS = {
    "size_num": f"(s STRING) RETURNS DOUBLE RETURN try_cast({_ZERO_TEXT} AS DOUBLE)",
    "size_int": f"(s STRING) RETURNS BIGINT RETURN try_cast({_ZERO_TEXT} AS BIGINT)",
    "strip_brackets": "(s STRING) RETURNS STRING RETURN rtrim('>', ltrim('<', s))",
    "clock_text": ("(t BIGINT) RETURNS STRING RETURN format_string('%02d:%02d:%02d', "
                   "pmod(floor(t / 3600), 24), pmod(floor(t / 60), 60), pmod(t, 60))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the functions above as session-scoped SQL functions."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(SQL_FUNCTIONS)
