"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label): the smallest id reachable from each id that has a link.

    Every round takes the smallest label among an id's neighbours and then the
    label of that label, so paths shorten quickly; it ends when no label
    falls. Labels are written each round. Links may repeat; a null end or an
    end linked with itself adds nothing.
    """
    ends = links.select(F.col(a).alias("id"), F.col(b).alias("other")).where("id != other")
    both = written(ends.union(ends.select("other", "id")).distinct(), "links")
    label = written(both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")), "labels")
    while True:
        near = (both.join(label.select(F.col("id").alias("other"), F.col("label").alias("seen")), "other")
                .groupBy("id").agg(F.min("seen").alias("seen")))
        lower = label.join(near, "id").select("id", "label", F.least("label", "seen").alias("low"))
        jump = label.select(F.col("id").alias("low"), F.col("label").alias("beyond"))
        label_new = written(
            lower.join(jump, "low", "left")
            .select("id", F.least("low", F.coalesce("beyond", "low")).alias("label"),
                    (F.least("low", F.coalesce("beyond", "low")) < F.col("label")).alias("fell")), "labels")
        fell = label_new.where("fell").limit(1).count()
        label = label_new.select("id", "label")
        if not fell:
            return label
