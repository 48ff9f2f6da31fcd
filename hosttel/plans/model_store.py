"""Versions of a fitted model behind one pointer.

A model is saved whole under a name of its own; then a pointer to it is
written: a one-row table under the next version number. A table without a
committed file has no rows, so whoever reads the pointer sees the version
before or the new one, never half a model. Older versions stay readable.
Everything goes through Spark's writers, so any store that Spark writes will do.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sample as S
from . import pipelines as PL


def versions(spark: SparkSession, root: str) -> DataFrame:
    """``(version, path)`` of all complete versions; no rows for a new folder."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/pointer").select(F.col("version").cast("int"), "path")
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "version int, path string")


def current(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """The newest version and its path. Of two that were saved at once under one number, always the same."""
    row = versions(spark, root).orderBy(F.desc("version"), F.desc("path")).first()
    return (row["version"], row["path"]) if row else None


def save_version(model: PipelineModel, spark: SparkSession, root: str) -> int:
    """Save ``model`` and then point at it; returns its version, from 1."""
    root = root.rstrip("/")
    path = f"{root}/models/{uuid.uuid4().hex}"
    model.write().save(path)
    last = current(spark, root)
    version = last[0] + 1 if last else 1
    spark.range(1).select(F.lit(path).alias("path")).coalesce(1).write.mode("append").parquet(f"{root}/pointer/version={version}")
    return version


def load_current(spark: SparkSession, root: str) -> tuple[int, PipelineModel]:
    """The newest version and its model."""
    found = current(spark, root)
    if found is None:
        raise ValueError(f"no model under {root}")
    return found[0], PL.load_model(found[1])


def refit(spark: SparkSession, tables: dict[str, tuple[DataFrame, PL.FeatureSpec, str]], root: str,
          kind: str = "gbt", seed: int = S.SEED, **params) -> dict[str, int]:
    """Fit the final model of each table (process, memory, ...) on its whole
    balanced rows and save it as the next version under ``root/<name>``
    (M14). ``tables``: name to (rows, features, key column). Returns the versions."""
    return {name: save_version(PL.final_model(df, spec, kind=kind, seed=seed, key=key, **params), spark, f"{root.rstrip('/')}/{name}")
            for name, (df, spec, key) in tables.items()}
