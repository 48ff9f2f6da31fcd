"""Corpus pipeline: documents to token ids in five stages.

Each stage is ``f(spark, docs, sf_dir)``; what it returns is written as
Parquet and read again as the next one's ``docs``. All stages but the last
return the columns they were given. A verdict is on the row itself, told by
its id (null or not) and text, so rows without a doc_id or that share one are
kept or dropped for their own text. Empty texts and repeated rows pass through
each stage as its operator defines; an empty table stays empty, extra columns
are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hosttel.llm import decontam, near_dup, pii, quality, sentencepiece_bpe
from hosttel.llm.store import written
from hosttel.llm.text import without
from hosttel.streaming.repeats import maybe_in

MODEL_FILE = "piece_bpe_32k.model"
SHINGLE_WORDS, SIMILARITY = 5, 80
BENCHMARK_WORDS = 10
#: What a verdict names a row by: its id and the hash of its text.
KEY = ["doc_id", "text_hash"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail a base rule or come from a rejected host."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row as one struct, so that no name clashes, beside its key."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))


def _apart(rows: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key ``named`` surely does not hold, and the others. A
    filter of bounded size is broadcast, so only the latter need be shuffled
    with their texts; a few of them may not be named either."""
    tested = maybe_in(rows, named, KEY)
    return tuple(tested.where(side).select(*rows.columns) for side in ("NOT __maybe_seen", "__maybe_seen"))


def _kept(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The rows but those whose key ``named`` (doc_id, text_hash, kept; a key
    once) holds as not kept: a verdict is on a row's own id, null or not, and
    text. An anti join would be moved to before the filter of ``_apart``."""
    on = F.expr("l.text_hash = r.text_hash AND l.doc_id <=> r.doc_id")
    return rows.alias("l").join(named.alias("r"), on, "left").where("r.kept IS NULL OR r.kept").select("l.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the
    smallest doc_id; of rows that repeat, one."""
    verdict = near_dup.near_duplicates(docs, width=SHINGLE_WORDS, limit=SIMILARITY)
    named = written(verdict.groupBy(*KEY).agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
                    .where("n > 1 OR NOT kept").select(*KEY, "kept"), "verdicts")
    clear, rest = _apart(_keyed(docs), named)
    return clear.unionByName(_kept(rest, named).dropDuplicates(KEY)).select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontam.contamination(docs, items, width=BENCHMARK_WORDS).where("size(hits) > 0")
    named = written(hit.select(*KEY).distinct().withColumn("kept", F.lit(False)), "verdicts")
    clear, rest = _apart(_keyed(docs), named)
    return clear.unionByName(_kept(rest, named)).select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; ``n_chars`` follows the text."""
    clean = pii.redact(docs, pii.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the token ids and their number; ``text`` is what they decode to.
    Columns of these names are replaced."""
    model = sentencepiece_bpe.load_model(public_tokenizers.path(MODEL_FILE))
    coded = sentencepiece_bpe.encode_decode(docs, model, decoded="text")
    return coded.select(*without(docs, ["n_tokens", "ids"]), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("personal_data", personal_data), ("tokens", tokens)]

#: Sketches, fitted classifiers and tokens have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
