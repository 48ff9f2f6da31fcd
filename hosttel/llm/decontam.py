"""Benchmark decontamination by a broadcast hash set of test n-grams.

DataFrame operations only. Every item is normalised to words and cut into
windows; equal windows are one row with the items that hold them. Each
document's windows of the same widths are looked up in that table, by a
broadcast hash join while its counted size is within ``broadcast_windows``.
Beyond, a filter of fixed size is broadcast in its place, and only windows
that it cannot rule out are shuffled to the table. The key is the window's
text itself, so a match is verified by being found. Matches go back to their document as word positions,
from which spans or whole documents are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.repeats import bloom_blocks, split_by_filter
from .store import written

#: Anything but ASCII letters, digits and non-ASCII characters parts words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    low = (F.when(F.length(text) == F.octet_length(text), F.lower(text))  # ASCII only: the same, and faster
           .otherwise(F.translate(text, UPPER, LOWER)))
    return F.coalesce(F.filter(F.split(low, SEPARATORS), lambda w: w != ""), F.array().cast("array<string>"))


def _windows(w: Column, width: int) -> Column:
    """(start, gram) of every window of ``width`` words; starts from 0."""
    gram = lambda i: F.struct((i - 1).alias("start"),
                              F.array_join(F.slice(w, i, width), " ").alias("gram"))
    return F.when(F.size(w) >= width, F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), gram))


def item_windows(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """(gram, width, items): distinct windows and the sorted distinct ids that hold them.
    An item of fewer words, but not none, is one window."""
    w = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).where(F.size("w") > 0)
    each = w.select("item", F.least(F.size("w"), F.lit(width)).alias("width"), "w")
    grams = each.select(
        "item", "width",
        F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - F.col("width") + 1),
                              lambda i: F.array_join(F.slice("w", i, F.col("width")), " "))).alias("gram"))
    return grams.groupBy("gram", "width").agg(F.sort_array(F.collect_set("item")).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", width: int = 10,
                  broadcast_windows: int = 500_000) -> DataFrame:
    """(doc_id, n_words, hits, items, text_hash): for each document row its
    number of words, the sorted positions (from 0) of words inside any
    occurrence of an item's window, the sorted distinct ids of the items with
    occurring windows, and ``xxhash64`` of the text, which tells rows of one
    doc_id apart.

    Null and empty texts have no words and no hits. Rows that share a doc_id
    but not the text are judged apart; repeated rows alike. Items with a null
    id hit words but are not listed; items without words match nothing. Other
    columns of both tables are ignored; without documents there is no row,
    without items there are no hits.
    """
    grams = item_windows(items, item_id, item_text, width)
    size = grams.groupBy("width").count().collect()  # one row for each width up to ``width``
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("__text"), F.col(text).alias("text"))
    few = sum(r["count"] for r in size) <= broadcast_windows
    grams = F.broadcast(grams) if few else written(grams, "item-windows")
    by_words = base.select("doc_id", "__text", words(F.col("text")).alias("w"))
    found = None
    for k in sorted(r["width"] for r in size):
        seen = by_words.select("doc_id", "__text", F.explode(_windows(F.col("w"), k)).alias("at"))
        seen, of_width = seen.select("doc_id", "__text", "at.start", "at.gram"), grams.where(F.col("width") == k)
        if not few:
            seen = split_by_filter(seen, bloom_blocks(of_width, ["gram"]), ["gram"]).where("__maybe_seen")
        hit = (seen.join(of_width, "gram")
               .select("doc_id", "__text", "start", F.lit(k).alias("k"), "items"))
        found = hit if found is None else found.unionAll(hit)
    counted = base.select("doc_id", "__text", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    no_hits, no_items = F.array().cast("array<int>"), F.array().cast(f"array<{items.schema[item_id].dataType.simpleString()}>")
    if found is None:
        return counted.select("doc_id", "n_words", no_hits.alias("hits"), no_items.alias("items"),
                              F.col("__text").alias("text_hash"))
    spans = found.groupBy("doc_id", "__text").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(
            F.expr("sequence(start, start + k - 1)"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    left, right = counted.alias("l"), spans.alias("r")
    on = F.expr("l.doc_id <=> r.doc_id AND l.__text = r.__text")
    return left.join(right, on, "left").select(
        "l.doc_id", "l.n_words", F.coalesce("r.hits", no_hits).alias("hits"),
        F.coalesce("r.items", no_items).alias("items"), F.col("l.__text").alias("text_hash"))


def clean_text(text: Column, hits: Column) -> Column:
    """The text's normalised words without those at the positions ``hits``."""
    return F.array_join(F.filter(words(text), lambda w, i: ~F.array_contains(hits, i)), " ")
