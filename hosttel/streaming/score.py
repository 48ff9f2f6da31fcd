"""Score live rows with a saved pipeline (ST7).

A fitted ``PipelineModel`` transforms a streaming ``DataFrame`` like a batch
one: the indexer, encoder, assembler and trees are all row-wise. Stream rows
carry no label, which none of the stages needs at prediction time.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_stream(rows: DataFrame, model: PipelineModel | str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus ``prediction`` and ``p_attack`` (P(class 1))."""
    if isinstance(model, str):
        model = PipelineModel.load(model)
    return model.transform(rows).select(
        *keep, "prediction", vector_to_array("probability")[1].alias("p_attack"))


def write_scored(rows: DataFrame, root: str, keep: list[str], path: str, checkpoint: str,
                 available_now: bool = False, trigger: str = "5 seconds"):
    """Score a stream with the newest version of a model store (ST7, M14).

    Every micro-batch looks the pointer up and is scored whole with one
    version, which its rows name; a version saved meanwhile serves the next
    batch. A replayed batch replaces its own output. Returns the
    ``StreamingQuery``; ``path`` holds ``keep``, ``prediction``, ``p_attack``
    and ``model_version``.
    """
    from ..plans import model_store

    held: dict[int, PipelineModel] = {}

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = model_store.current(spark, root)
        if found is None:
            raise ValueError(f"no model under {root}")
        version, where = found
        if version not in held:
            held.clear()
            held[version] = PipelineModel.load(where)
        (score_stream(batch, held[version], keep).withColumn("model_version", F.lit(version))
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}"))

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
