"""Resolution of not-modified revisit records.

A revisit stands for the latest earlier full response of the same canonical
URL, if its validators agree; its headers then replace the stored ones as far
as a 304 answer may. The as-of join runs in time buckets: the last response of
each (URL, bucket) is aggregated before anything is ordered, earlier buckets'
last responses are carried forward over these few rows, and only inside a
bucket moments are ordered one by one. Records of one URL and second are
counted together first, so an ordered group has at most ``bucket_seconds``
rows however hot its URL is. Payloads and headers are joined at the end, to
the one response found; a response that many revisits ask for is joined in
several copies, each with its part of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

DAY = 86_400
#: Header fields that a 304 answer may update (fixed values).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: A response with more revisits than this is joined in parts of about this many.
PART_ROWS = 10_000
RECORD = ("record_id", "url", "ts", "kind", "etag", "last_modified", "headers", "payload")


def canonical_url(url: Column) -> Column:
    """Host (lower-cased, without default port), path without a trailing
    slash, and the sorted query without utm_ parameters. Scheme and fragment do
    not count. Null, or without ``://``: null."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, r"(?s)^[^:/?]*://([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^:/?]*://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(bare, r"(?s)^[^?]*\?(.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~F.startswith(p, F.lit("utm_")))), "&")
    whole = F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    return F.when(F.regexp_like(url, F.lit(r"^[^:/?#]*://")), whole)


def header_name(line: Column) -> Column:
    return F.lower(F.trim(F.substring_index(line, ":", 1)))


def merged_headers(stored: Column, fresh: Column) -> Column:
    """Stored header lines, those that the revisit may update replaced by its own; sorted."""
    empty = F.array().cast("array<string>")
    stored, fresh = F.coalesce(stored, empty), F.coalesce(fresh, empty)
    allowed = F.filter(fresh, lambda x: header_name(x).isin(*PERMITTED))
    names = F.transform(allowed, header_name)
    return F.array_sort(F.concat(F.filter(stored, lambda x: ~F.array_contains(names, header_name(x))), allowed))


def resolve(records: DataFrame, bucket_seconds: int = DAY, part_rows: int = PART_ROWS) -> DataFrame:
    """(record_id, canonical, response_id, verdict, headers, payload) for each
    revisit of ``records`` (columns ``RECORD``; ts and last_modified in
    seconds, headers as "Name: value" lines, kind ``response`` or ``revisit``).

    The latest response with an earlier ts counts, of equal times the larger
    record_id. An entity tag, compared without its weakness mark, decides; if
    the revisit has none, its last_modified must equal the response's.
    Verdicts: ``resolved``; ``mismatch``; ``no_validator`` (the revisit has
    neither); ``no_response`` (nothing earlier, or no canonical URL, or no
    ts). Headers are merged and the payload taken over only when resolved.

    Responses without a record_id cannot be named and are left out; repeated
    responses count once, repeated revisits come out as often as they came.
    Parts of a response's revisits follow from their record_id, url and etag,
    so exact repeats of one revisit stay in one part.
    Records of other kinds and other columns are ignored; an empty table gives
    no rows.
    """
    base = records.select(*[F.col(c) for c in RECORD]).withColumn("canonical", canonical_url(F.col("url")))
    at = base.select("canonical", "ts", "record_id", "kind", F.expr(f"ts DIV {bucket_seconds}").alias("bucket"))
    responses = at.where("kind = 'response' AND canonical IS NOT NULL AND ts IS NOT NULL AND record_id IS NOT NULL")
    revisits = base.where("kind = 'revisit'")
    placed = at.where("kind = 'revisit' AND canonical IS NOT NULL AND ts IS NOT NULL")

    moments = (responses.unionAll(placed).groupBy("canonical", "bucket", "ts")
               .agg(F.max(F.when(F.col("kind") == "response", F.col("record_id"))).alias("record_id"),
                    F.count_if(F.col("kind") == "revisit").alias("revisits")))
    ref = F.when(F.col("record_id").isNotNull(), F.struct("ts", "record_id"))
    earlier = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (moments.groupBy("canonical", "bucket").agg(F.max(ref).alias("last"))
               .withColumn("carried", F.last("last", ignorenulls=True).over(earlier))
               .select("canonical", "bucket", "carried"))
    before = (Window.partitionBy("canonical", "bucket").orderBy("ts")
              .rangeBetween(Window.unboundedPreceding, -1))
    inside = (moments.withColumn("found", F.max(ref).over(before)).where("revisits > 0")
              .select("canonical", "bucket", "ts", "found", "revisits"))
    matched = written(inside.join(carried, ["canonical", "bucket"])
                      .select("canonical", "ts", F.coalesce("found", "carried")["record_id"].alias("response_id"), "revisits")
                      .where("response_id IS NOT NULL"), "revisit-matches")
    # at most one row for each ``part_rows`` revisits there are
    hot = F.broadcast(matched.groupBy("response_id").agg(F.ceil(F.sum("revisits") / part_rows).cast("int").alias("parts"))
                      .where("parts > 1"))
    parts = F.coalesce("parts", F.lit(1))
    full = (base.where("kind = 'response' AND record_id IS NOT NULL")
            .select(F.col("record_id").alias("response_id"), F.col("etag").alias("r_etag"),
                    F.col("last_modified").alias("r_modified"), F.col("headers").alias("r_headers"),
                    F.col("payload").alias("r_payload"))
            .join(hot, "response_id", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
            .dropDuplicates(["response_id", "part"]))
    asking = (revisits.join(matched.drop("revisits"), ["canonical", "ts"], "left").join(hot, "response_id", "left")
              .withColumn("part", F.pmod(F.xxhash64("record_id", "url", "etag"), parts).cast("int")))
    joined = asking.join(full, ["response_id", "part"], "left")
    bare = lambda tag: F.regexp_replace(tag, "^W/", "")
    verdict = (F.when(F.col("response_id").isNull(), "no_response")
               .when(F.col("etag").isNotNull(),
                     F.when(F.coalesce(bare(F.col("etag")) == bare(F.col("r_etag")), F.lit(False)), "resolved")
                     .otherwise("mismatch"))
               .when(F.col("last_modified").isNotNull(),
                     F.when(F.coalesce(F.col("last_modified") == F.col("r_modified"), F.lit(False)), "resolved")
                     .otherwise("mismatch"))
               .otherwise("no_validator"))
    done = F.col("verdict") == "resolved"
    return joined.withColumn("verdict", verdict).select(
        "record_id", "canonical", "response_id", "verdict",
        F.when(done, merged_headers(F.col("r_headers"), F.col("headers"))).alias("headers"),
        F.when(done, F.col("r_payload")).alias("payload"))
