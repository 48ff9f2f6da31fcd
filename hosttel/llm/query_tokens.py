"""op1: SentencePiece encoding and decoding of all documents; op5: their ids
in training order, written as fixed-stride shards."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import sentencepiece_bpe as sp
from . import token_shards
from .registry import register, table
from .store import new_folder

MODEL_FILE = "piece_bpe_32k.model"


@register("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir, model_path: str | None = None):
    """No SQL: tested against the library itself."""
    model = sp.load_model(model_path or public_tokenizers.path(MODEL_FILE))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sp.encode_decode(docs, model, keep_text=False)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


SEQUENCE, PER_SHARD, ORDER_KEY = 1024, 4096, "epoch-0"


RANKS_FILE, END = "byte_bpe_multi_50k.tiktoken", 50_256


@register("op5_feistel_order")
def op5_feistel_order(spark, sf_dir, ranks_path: str | None = None, folder: str | None = None):
    """No SQL (binary files); tested by reading every record back."""
    ranks = token_shards.load_ranks(ranks_path or public_tokenizers.path(RANKS_FILE), public_tokenizers.PATTERN, END)
    return token_shards.write_shards(table(spark, sf_dir, "documents"), ranks,
                                     folder or new_folder(spark, "token-shards"), ORDER_KEY, SEQUENCE, PER_SHARD)
