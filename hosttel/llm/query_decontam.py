"""op10: benchmark windows in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontam
from .registry import register, table

WIDTH = 10

WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

SQL = f"""
WITH doc AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
item AS (SELECT item_id, w, least(len(w), {WIDTH}) AS k
         FROM (SELECT item_id, {WORDS_SQL} AS w FROM benchmark) WHERE len(w) > 0),
item_at AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM item),
gram AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM item_at),
widths AS (SELECT DISTINCT k FROM gram),
doc_at AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM doc, widths WHERE len(w) >= k),
hit AS (SELECT d.doc_id, d.i, d.k, g.item_id
        FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM doc_at) d
        JOIN gram g USING (gram, k)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM hit))
              GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
              FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@register("op10_decontamination", SQL)
def op10_decontamination(spark, sf_dir):
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=WIDTH)
    ids = F.concat_ws(",", F.array_sort(F.col("items").cast("array<string>")))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))
