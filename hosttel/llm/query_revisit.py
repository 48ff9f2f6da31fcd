"""op9: revisit records derived from all pages, resolved to their responses.

The pages table holds no revisits. Every page is read as a capture; later
captures of the same pages are derived from it with other spellings of the
URL, changed and unchanged content, and validators that agree, differ or
lack.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import revisit
from .registry import register, table


def records_sql(pages: str, array: str, close: str, long: str, payload: str = "md5({body})") -> str:
    """Capture records of ``pages`` in a SQL that both engines read. ``payload``
    is made from the response's ``{body}``: the operator gets it whole."""
    start = f"1700000000 + CAST((page_id * 7919) % 864000 AS {long})"
    tag = "'\"' || md5(html) || '\"'"

    def headers(*lines: str) -> str:
        return f"{array}{', '.join(lines)}{close}"

    def response(n: int, delay: int, body: str, where: str) -> str:
        etag = f"'\"' || md5({body}) || '\"'"
        return f"""SELECT page_id, page_id * 8 + {n} AS record_id, url, {start} + {delay} AS ts, 'response' AS kind,
    {etag} AS etag, CASE WHEN page_id % 4 <> 1 THEN {start} + {delay} - 3600 END AS last_modified,
    {headers("'Content-Type: text/html'", f"'Date: ' || ({start} + {delay})", f"'ETag: ' || {etag}",
             "'Server: s' || (page_id % 7)", "'Cache-Control: max-age=60'")} AS headers,
    {payload.format(body=body)} AS payload FROM {pages} WHERE {where}"""

    def again(n: int, delay: str, url: str, where: str) -> str:
        return f"""SELECT page_id, page_id * 8 + {n} AS record_id, {url} AS url, {start} + {delay} AS ts,
    'revisit' AS kind,
    CASE page_id % 7 WHEN 0 THEN '"gone"' WHEN 1 THEN 'W/' || {tag} WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE {tag} END AS etag,
    CASE WHEN page_id % 7 = 2 THEN {start} - 3600 END AS last_modified,
    {headers(f"'Date: ' || ({start} + {delay})", "'Expires: never'", "'Cache-Control: max-age=120'",
             "'Set-Cookie: a=1'", "'Content-Length: 0'")} AS headers,
    CAST(NULL AS {'STRING' if long == 'BIGINT' and array == 'array(' else 'VARCHAR'}) AS payload
    FROM {pages} WHERE {where}"""

    variant = "CASE WHEN page_id % 3 = 1 THEN url || '#again' ELSE replace(url, 'https://', 'http://') END"
    tracked = ("CASE WHEN url LIKE '%#%' THEN url WHEN url LIKE '%?%' THEN url || '&utm_campaign=x' "
               "ELSE url || '?utm_campaign=x' END")
    return "\nUNION ALL\n".join([
        response(0, 0, "html", "TRUE"),
        response(1, 500_000, "html || 'v2'", "page_id % 5 = 0"),
        again(2, "250000", variant, "page_id % 3 <> 0"),
        again(3, "700000", tracked, "TRUE"),
        again(4, "-100000", "url", "page_id % 11 = 0"),
    ])


_LINE_NAME = "lower(trim(split_part(x, ':', 1)))"
_ALLOWED = ", ".join(f"'{p}'" for p in revisit.PERMITTED)

SQL = rf"""
WITH raw AS ({records_sql('pages', '[', ']', 'BIGINT')}),
bare AS (SELECT *, regexp_replace(url, '#.*$', '', 's') AS u FROM raw),
parts AS (SELECT *, regexp_replace(lower(regexp_extract(u, '^[^:/?]*://([^/?]*)', 1)), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(u, '^[^:/?]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\?(.*)$', 1), '&'),
        lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), '&') AS q FROM bare),
rec AS (SELECT *, CASE WHEN regexp_matches(url, '^[^:/?#]*://') THEN
    host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS canonical FROM parts),
pair AS (SELECT v.*, r.record_id AS response_id, r.etag AS r_etag, r.last_modified AS r_modified,
    r.headers AS r_headers, r.payload AS r_payload,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC, r.record_id DESC) AS k
    FROM rec v LEFT JOIN rec r ON r.kind = 'response' AND r.canonical = v.canonical AND r.ts < v.ts
    WHERE v.kind = 'revisit'),
judged AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_response'
    WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = r_etag THEN 'resolved' ELSE 'mismatch' END
    WHEN last_modified IS NOT NULL THEN CASE WHEN last_modified = r_modified THEN 'resolved' ELSE 'mismatch' END
    ELSE 'no_validator' END AS verdict,
    list_filter(headers, lambda x: {_LINE_NAME} IN ({_ALLOWED})) AS fresh FROM pair WHERE k = 1)
SELECT record_id, record_id // 8 AS page_id, canonical, response_id, verdict,
    CASE WHEN verdict = 'resolved' THEN array_to_string(list_sort(list_concat(
        list_filter(r_headers, lambda x: NOT list_contains(list_transform(fresh, lambda y: lower(trim(split_part(y, ':', 1)))),
                                                        {_LINE_NAME})), fresh)), chr(10)) END AS headers,
    CASE WHEN verdict = 'resolved' THEN r_payload END AS payload
FROM judged
"""


@register("op9_revisit_resolution", SQL)
def op9_revisit_resolution(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = spark.sql(records_sql("{pages}", "array(", ")", "BIGINT", "{body}"), pages=pages)
    return revisit.resolve(records).select(
        "record_id", F.expr("record_id DIV 8").alias("page_id"), "canonical", "response_id", "verdict",
        F.array_join("headers", "\n").alias("headers"), F.md5("payload").alias("payload"))
