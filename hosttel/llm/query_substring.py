"""op3: repeated passages in all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import substring_dedup
from .registry import register, table

WINDOW = 35

SQL = rf"""
WITH doc AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                        lambda x: x <> '') AS w FROM documents),
seen AS (SELECT doc_id, i, array_to_string(w[i:i + {WINDOW} - 1], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM doc WHERE len(w) >= {WINDOW})),
often AS (SELECT g FROM seen GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM seen JOIN often USING (g)),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM doc),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
         FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""


@register("op3_block_anchors", SQL)
def op3_block_anchors(spark, sf_dir):
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"), window=WINDOW)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
