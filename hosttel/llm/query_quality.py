"""op4: quality rules over all documents, judged with their hosts."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import quality
from .registry import register, table

_RULES = {"few_words": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words",
          "symbols": "10 * n_symbols > n_words", "dup_lines": "100 * n_dup_lines > 30 * n_lines"}


def _each(text: str) -> str:
    return ", ".join(text.format(r=r) for r in _RULES)


def _em_sql() -> str:
    """CTEs ``u0``, ``p1``, ``u1``, ...: chances of being a usual host and the prior, round by round."""
    out = ["u0 AS (SELECT *, " + _each("CASE WHEN f_{r} > 0.5 * docs THEN 0.0 ELSE 1.0 END::DOUBLE AS u_{r}") + " FROM host)"]
    for i in range(1, quality.EM_ROUNDS + 1):
        sums = _each("coalesce(sum(u_{r}), 0) AS w_{r}, sum(u_{r} * f_{r} / docs) AS m_{r}, sum(u_{r} * (f_{r} / docs) * (f_{r} / docs)) AS q_{r}, "
                     "sum(u_{r} / docs) AS e_{r}, coalesce(avg(f_{r} / docs), 0) AS all_{r}")
        alike = "((greatest(q_{r} / w_{r} - pow(m_{r} / w_{r}, 2), 0) / nullif(m_{r} / w_{r} * (1 - m_{r} / w_{r}), 0) - e_{r} / w_{r}) / (1 - e_{r} / w_{r}))"
        out.append(f"t{i} AS (SELECT count(*) AS hosts, {sums} FROM u{i - 1} WHERE docs >= {quality.ENOUGH})")
        out.append(f"a{i} AS (SELECT *, " + _each("CASE WHEN w_{r} > 0.5 THEN coalesce(" + alike + ", 0) END AS alike_{r}") + f" FROM t{i})")
        out.append(f"p{i} AS (SELECT " + _each(
            f"least(greatest(CASE WHEN w_{{r}} > 0.5 THEN m_{{r}} / w_{{r}} ELSE all_{{r}} END, {quality.LOWEST}), {quality.HIGHEST})::DOUBLE AS mean_{{r}}, "
            f"CASE WHEN w_{{r}} <= 0.5 THEN {quality.WEAKEST} WHEN alike_{{r}} > 0 THEN least(greatest((1 - alike_{{r}}) / alike_{{r}}, {quality.WEAKEST}), {quality.STRONGEST}) "
            f"ELSE {quality.STRONGEST} END::DOUBLE AS s_{{r}}, (hosts - w_{{r}} + 1) / (hosts + 2) AS odd_{{r}}") + f" FROM a{i})")
        bb = ("(lgamma(f_{{r}} + mean_{{r}} * {s}) + lgamma(docs - f_{{r}} + (1 - mean_{{r}}) * {s}) - lgamma(docs + {s}) "
              "- lgamma(mean_{{r}} * {s}) - lgamma((1 - mean_{{r}}) * {s}) + lgamma({s}))")
        ratio = f"{bb.format(s=f'{quality.WEAKEST}::DOUBLE')} - {bb.format(s='s_{r}')}"
        out.append(f"u{i} AS (SELECT host.*, p{i}.*, " + _each(
            "1 / (1 + odd_{r} / (1 - odd_{r}) * exp(least(" + ratio + ", 700.0))) AS u_{r}") + f" FROM host, p{i})")
    return ",\n".join(out)


_RATE = (f"u_{{r}} * (f_{{r}} + mean_{{r}} * s_{{r}}) / (docs + s_{{r}}) + "
         f"(1 - u_{{r}}) * (f_{{r}} + mean_{{r}} * {quality.WEAKEST}) / (docs + {quality.WEAKEST})")

SQL = rf"""
WITH doc AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
gram AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM doc WHERE len(w) >= 3)),
often AS (SELECT doc_id, g FROM gram GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM gram JOIN often USING (doc_id, g)) GROUP BY doc_id),
judged AS (
    SELECT doc_id, source, len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
    FROM doc LEFT JOIN rep USING (doc_id)),
host AS (SELECT source, count(*) AS docs, {', '.join(f'sum(CASE WHEN {x} THEN 1 ELSE 0 END) AS f_{r}' for r, x in _RULES.items())}
         FROM judged GROUP BY source),
{_em_sql()},
verdict AS (SELECT source, greatest({_each(_RATE)}) AS rate FROM u{quality.EM_ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT rate > 0.5 AS kept,
       round(rate, 6) AS host_rate, rate > 0.5 AS host_rejected
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
"""


@register("op4_host_rules", SQL)
def op4_host_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs, keep_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("host_rate", 6).alias("host_rate"), "host_rejected")
