"""op12: phrase collocations of all documents."""

from __future__ import annotations

from . import collocations
from .registry import register, table

SQL = r"""
WITH RECURSIVE doc AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM doc),
words AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
         FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
               FROM words, (VALUES (1), (2), (3), (4)) AS s(k) WHERE len(w) >= k)),
total AS (SELECT lang, count(*) AS n FROM gram WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS f FROM gram GROUP BY lang, k, phrase
      HAVING count(*) >= 30),
inner_part AS (SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, f
               FROM (SELECT lang, w, f, j, unnest(range(1, k - j + 2)) AS i
                     FROM f, (VALUES (2), (3)) AS s(j) WHERE j < k)),
covered AS (SELECT lang, phrase, max(f) AS most FROM inner_part GROUP BY lang, phrase),
cand AS (SELECT f.* FROM f LEFT JOIN covered USING (lang, phrase) WHERE k > 1 AND (most IS NULL OR 100 * most < 80 * f)),
cut AS (SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r,
               ((2000000::HUGEINT * c.f) // (x.f + y.f))::BIGINT AS score
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) AS c
        JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
        JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best),
edge AS (SELECT lang, phrase, array_to_string(w[1:3], ' ') AS src, array_to_string(w[2:4], ' ') AS dst FROM f WHERE k = 4),
unary AS (SELECT lang, x.dst AS node, any_value(x.phrase) AS phrase, any_value(y.phrase) AS next
          FROM edge AS x JOIN edge AS y USING (lang) WHERE x.dst = y.src GROUP BY lang, x.dst
          HAVING count(*) = 1 AND any_value(x.phrase) <> any_value(y.phrase)),
walk AS (SELECT lang, phrase, phrase AS path_end, 0 AS steps FROM edge
         WHERE (lang, phrase) NOT IN (SELECT lang, phrase FROM unary)
         UNION ALL
         SELECT w.lang, u.phrase, w.path_end, w.steps + 1 FROM walk AS w JOIN unary AS u ON u.lang = w.lang AND u.next = w.phrase),
path AS (SELECT lang, phrase, path_end, 4 + max(steps) OVER (PARTITION BY lang, path_end) AS path_words FROM walk)
SELECT lang, rank, phrase, a, l, r, n, score, path_end, path_words::BIGINT AS path_words
FROM ranked JOIN total USING (lang) LEFT JOIN path USING (lang, phrase) WHERE rank <= 2000
"""


@register("op12_collocations", SQL)
def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))
