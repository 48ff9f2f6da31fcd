"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def new_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it
    back: later steps depend on the files, not on executors that may go."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
