"""The README's batch flow on a memory-telemetry CSV in the reference's layout."""

import os
import tempfile

from pyspark.sql import functions as F

from hosttel.operators import audit, clean, profile
from hosttel.plans import pipelines as PL
from hosttel.schemas import MEMORY_COLUMNS
from hosttel.sources.csv import read_memory_csv
from hosttel.sources.fixtures import mem

from conftest import SF_SMALL


def _write_memory_csv(spark, folder):
    m = mem(spark, SF_SMALL)
    rows = m.select(
        F.col("seq").alias("ts"), (F.col("pid") % 1000).cast("int").alias("PID"),
        F.col("minflt").alias("MINFLT"), F.col("rsize").alias("MAJFLT"),
        F.col("vsize").alias("VSTEXT"), F.col("vsize").alias("VSIZE"),
        F.col("rsize").alias("RSIZE"), F.lit("0").alias("VGROW"), F.lit("2K").alias("RGROW"),
        F.lit("1.5K").alias("MEM"), F.col("cmd").alias("CMD"), F.col("attack"),
        F.when(F.col("attack") == 1, "exploit").otherwise("normal").alias("type"))
    assert [c for c, _ in MEMORY_COLUMNS] == rows.columns
    rows.coalesce(2).write.option("header", True).csv(os.path.join(folder, "memory_part1"))
    return os.path.join(folder, "memory_part1", "*.csv")


def test_readme_batch_flow(spark):
    folder = tempfile.mkdtemp(prefix="hosttel-e2e-")
    raw = read_memory_csv(spark, _write_memory_csv(spark, folder))
    assert raw.count() == mem(spark, SF_SMALL).count()
    cleaned = clean.clean_memory(raw)
    dtypes = dict(cleaned.dtypes)
    assert dtypes["MINFLT"] == "bigint" and dtypes["RSIZE"] == "double" and dtypes["MEM"] == "double"
    assert cleaned.where("CMD LIKE '<%' OR CMD LIKE '%>'").count() == 0
    assert cleaned.select(F.max("RGROW"), F.max("MEM")).first() == (2000.0, 1.5)   # text rule
    before = audit.missing_counts(raw).first()
    after = audit.missing_counts(cleaned).first()
    assert after.RSIZE > before.RSIZE          # "k" sizes do not parse: they become missing
    top = profile.top_values(cleaned, "CMD", 10).collect()
    assert sum(r.Total for r in top) == cleaned.count()
    train, test = PL.train_test(cleaned, PL.MEMORY_FEATURES, key="PID")
    models = PL.fit_models(train, PL.MEMORY_FEATURES, ("dt",))
    ev = PL.evaluate(PL.predict(models["dt"], test, PL.MEMORY_FEATURES), PL.MEMORY_FEATURES).first()
    assert 0.0 <= ev.auc <= 1.0 and 0.0 <= ev.accuracy <= 1.0
