"""HyperMinHash near-duplicate groups.

1. Each text becomes the sorted set of its shingle hashes. Texts with the same
   set form one class, named by the set's 64-bit hash.
2. A class's sketch splits the 64-bit hash range into ``bins``; of the smallest
   hash in a bin it keeps the count of leading zeros and ten bits after the
   first one. Bands of ``rows`` registers are hashed into buckets. A register
   of an empty bin is lent by the filled bin that comes first in that
   register's own random order, so that bands of short texts also agree with
   the chance of the sets' similarity.
3. In each bucket the smallest member is compared with the others, and
   components are formed. Members of buckets that then still hold several
   components have their lone shingles counted, those that no other such
   member has; a text with more than a fifth of them can have no link and
   leaves. In what is still split, the members outside a bucket's largest
   component are compared with all members of other components, block by
   block; a pair that shares several buckets counts in its first. No bucket
   is cut.
4. A pair is dropped early only if sizes or lone shingles rule it out, or if
   the similarity estimated from the sketches, corrected for chance collisions
   of registers, lies ``SLACK`` standard errors below the limit. The rest is
   decided by the full shingle sets of both texts.

With 51 bands of 5 registers a pair at the limit of 0.8 shares no bucket with a
chance of (1 - 0.8**5)**51 < 2e-9. All 512 registers serve the estimate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..streaming.repeats import maybe_in
from .components import connected_components
from .store import written
from .text import fields, map_columns, shingle_set

BINS, BANDS, ROWS = 512, 51, 5
MANTISSA = 10
#: Standard errors below the limit at which an estimate rules a pair out.
SLACK = 5.0
#: Members that a block of a split bucket holds.
BLOCK = 256


def sketch(u: np.ndarray, bins: int) -> np.ndarray:
    """Registers (uint16, 0: empty) of sorted distinct 64-bit hashes."""
    bits = bins.bit_length() - 1
    at = (u >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    rest = (u[first] << np.uint64(bits)) >> np.uint64(11)  # 53 bits, exact as a double
    zeros = 53 - np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    mantissa = ((rest << zeros.astype(np.uint64)) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = np.zeros(bins, np.uint16)
    out[at[first]] = ((zeros + 1) << MANTISSA | mantissa.astype(np.int64)).astype(np.uint16)
    return out


@lru_cache(4)
def _orders(bins: int) -> np.ndarray:
    """A random order of the bins for each register, the same on every worker."""
    return np.random.default_rng(20_231).random((bins, bins), np.float32)


@lru_cache(4)
def _band_keys(bands: int, rows: int) -> np.ndarray:
    return np.random.default_rng(77).integers(1, 2 ** 63, (bands, rows), np.int64).astype(np.uint64) | np.uint64(1)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit bucket key for each band of ``rows`` registers."""
    bins, used = len(registers), bands * rows
    source = np.arange(used)
    filled = np.flatnonzero(registers)
    empty = np.flatnonzero(registers[:used] == 0)
    if len(empty):
        source[empty] = filled[_orders(bins)[empty][:, filled].argmin(axis=1)]
    value = registers[source].astype(np.uint64) | source.astype(np.uint64) << np.uint64(16)
    value = (value + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    value ^= value >> np.uint64(29)
    total = (value.reshape(bands, rows) * _band_keys(bands, rows)).sum(axis=1, dtype=np.uint64)
    total += np.arange(bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


@lru_cache(65_536)
def chance_collision(n_a: int, n_b: int, bins: int) -> float:
    """Chance that two unrelated filled bins hold equal registers, for sets of
    these sizes: equal counts of zeros, then equal bits after the first one."""
    a, b = max(n_a / bins, 1e-9), max(n_b / bins, 1e-9)
    total = 0.0
    for z in range(54):
        low, high = 2.0 ** -(z + 1), 2.0 ** -z
        total += ((math.exp(-a * low) - math.exp(-a * high)) * (math.exp(-b * low) - math.exp(-b * high)))
    return total / ((1 - math.exp(-a)) * (1 - math.exp(-b))) / 2 ** MANTISSA


def estimate(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> tuple[float, int]:
    """Similarity from two sketches, corrected for chance collisions, and the
    number of bins it rests on."""
    used = int(np.count_nonzero(a | b))
    if not used:
        return 0.0, 0
    share = np.count_nonzero((a == b) & (a > 0)) / used
    chance = chance_collision(n_a, n_b, len(a))
    return max(0.0, (share - chance) / (1 - chance)), used


def signatures(df: DataFrame, doc_id: str, text: str, width: int, bins: int = BINS) -> DataFrame:
    """(doc_id, text_hash, n, node, sketch): size of the shingle set, its hash and its sketch."""

    def run(column: pa.Array) -> list[pa.Array]:
        n, node, sk = [], [], []
        for t in column.to_pylist():
            u = shingle_set(t, width)
            n.append(len(u))
            node.append(xxhash.xxh3_64_intdigest(u.tobytes()) - 2 ** 63 if len(u) else None)
            sk.append(sketch(u, bins).tobytes() if len(u) else None)
        return [pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sk, pa.binary())]

    only = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return map_columns(only, ["text"], fields([("n", T.LongType()), ("node", T.LongType()),
                                               ("sketch", T.BinaryType())]), run, drop=("text",))


def _bands(classes: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(column: pa.Array) -> list[pa.Array]:
        keys = [band_hashes(np.frombuffer(s, np.uint16), bands, rows).view(np.int64) for s in column.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    made = map_columns(classes.select("id", "n", "sketch"), ["sketch"],
                       fields([("keys", T.ArrayType(T.LongType()))]), run, drop=("sketch",))
    return made.select(F.explode("keys").alias("key"), "id", "n")


def _size_fits(limit: int):
    return F.expr(f"100 * least(n_a, n_b) >= {limit} * greatest(n_a, n_b)")


def _floor(limit: int, used, n_both):
    """The estimate below which a pair is ruled out. The smallest hashes of
    the ``used`` bins are a random draw without replacement from the union,
    which holds ``n_both / (1 + limit)`` hashes for a pair at the limit; so
    for short texts, whose sketch holds nearly all of them, the error is small."""
    j, union = limit / 100, n_both / (1 + limit / 100)
    used = np.maximum(used, 1)
    left = np.clip((union - used) / np.maximum(union - 1, 1), 0, 1)
    return j - SLACK * np.sqrt(j * (1 - j) / used * left) - 1 / used


def _by_sketch(pairs: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """The pairs (a, b) of class ids that their sketches do not rule out."""
    side = lambda s: classes.select(F.col("id").alias(s), F.col("sketch").alias(f"sketch_{s}"),
                                    F.col("n").alias(f"n_{s}"))

    def run(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> list[pa.Array]:
        out = []
        for x, y, p, q in zip(a.to_pylist(), b.to_pylist(), n_a.to_pylist(), n_b.to_pylist(), strict=True):
            j, used = estimate(np.frombuffer(x, np.uint16), np.frombuffer(y, np.uint16), p, q)
            out.append(bool(j >= _floor(limit, used, p + q)))
        return [pa.array(out, pa.bool_())]

    return map_columns(pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b"),
                       ["sketch_a", "sketch_b", "n_a", "n_b"], fields([("ok", T.BooleanType())]), run,
                       drop=("sketch_a", "sketch_b", "n_a", "n_b")).where("ok").select("a", "b")


def _by_sets(pairs: DataFrame, texts: DataFrame, width: int, limit: int) -> DataFrame:
    """The pairs (a, b) of class ids whose full shingle sets are similar enough."""

    def run(a: pa.Array, b: pa.Array) -> list[pa.Array]:
        out, last, u = [], None, None
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            if x != last:
                last, u = x, shingle_set(x, width)
            v = shingle_set(y, width)
            both = len(np.intersect1d(u, v, assume_unique=True))
            out.append(100 * both >= limit * (len(u) + len(v) - both) > 0)
        return [pa.array(out, pa.bool_())]

    side = lambda s: texts.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b")
    return (map_columns(full, ["text_a", "text_b"], fields([("ok", T.BooleanType())]), run,
                        drop=("text_a", "text_b"), batch_rows=128).where("ok").select("a", "b"))


def _lone_shingles(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(id, lone): for each of the ids, how many of its shingles no other of them has."""

    def run(column: pa.Array) -> list[pa.Array]:
        sets = [shingle_set(t, width).view(np.int64) for t in column.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(u) for u in sets])]).astype(np.int32)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]

    made = map_columns(texts.join(ids, "id"), ["text"], fields([("set", T.ArrayType(T.LongType()))]), run, drop=("text",))
    return (made.select("id", F.explode("set").alias("shingle")).groupBy("shingle")
            .agg(F.min("id").alias("id"), F.max("id").alias("top")).where("id = top")
            .groupBy("id").agg(F.count("*").alias("lone")))


def _compare_blocks(split: DataFrame, bands: int, rows: int, limit: int) -> DataFrame:
    """Pairs (a, b) of members of a bucket with unlike labels, one of them
    outside the largest component, that sizes, lone shingles and sketches do
    not rule out. ``split``: (key, m, main, id, n, lone, label, sketch)."""
    member = F.struct("id", "label", "n", "lone", "sketch")

    def blocks(part: DataFrame, size: str, name: str) -> DataFrame:
        number = F.expr(f"pmod(xxhash64(id), CAST(ceil({size} / {BLOCK}) AS INT))")
        return part.groupBy("key", number.alias("block")).agg(F.collect_list(member).alias(name)).drop("block")

    outside = blocks(split.where("label != main"), "others", "left").join(
        split.select("key", "main").distinct(), "key")
    pairs = outside.join(blocks(split, "m", "right"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                key, left, right, main = (batch.column(c)[i].as_py() for c in ("key", "left", "right", "main"))
                found = _matches(key, main, left, right, bands, rows, limit)
                yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    return pairs.select("key", "main", "left", "right").mapInArrow(run, "a long, b long")


def _matches(key: int, main, left: list[dict], right: list[dict], bands: int, rows: int, limit: int) -> list[tuple[int, int]]:
    sketches = np.array([np.frombuffer(r["sketch"], np.uint16) for r in right])
    ids, label, n, lone = (np.array([r[c] for r in right]) for c in ("id", "label", "n", "lone"))
    keys: dict[int, np.ndarray] = {}

    def buckets_of(member: dict) -> np.ndarray:
        if member["id"] not in keys:
            keys[member["id"]] = band_hashes(np.frombuffer(member["sketch"], np.uint16), bands, rows).view(np.int64)
        return keys[member["id"]]

    out = []
    for x in left:
        both = np.minimum(n - lone, x["n"] - x["lone"])  # at most so many shingles are shared
        fit = np.flatnonzero((label != x["label"]) & ((label == main) | (ids > x["id"]))
                             & (100 * both >= limit * (n + x["n"] - both)))
        if not len(fit):
            continue
        own = np.frombuffer(x["sketch"], np.uint16)
        other = sketches[fit]
        used = np.count_nonzero(other | own, axis=1)
        share = np.count_nonzero((other == own) & (own > 0), axis=1) / np.maximum(used, 1)
        for j in fit[share >= _floor(limit, used, n[fit] + x["n"])].tolist():  # the correction only lowers the share
            y = right[j]
            e, bins = estimate(own, sketches[j], x["n"], y["n"])
            if e >= _floor(limit, bins, x["n"] + y["n"]):
                same = buckets_of(x)[buckets_of(x) == buckets_of(y)]
                if len(same) and same[0] == key:
                    out.append((min(x["id"], y["id"]), max(x["id"], y["id"])))
    return out


def _still_split(member: DataFrame) -> DataFrame:
    """The members (key, id, n, label...) of buckets with several labels, with the bucket's size
    ``m``, its commonest label ``main`` and the number of ``others``."""
    state = (member.groupBy("key", "label").agg(F.count("*").alias("c"))
             .groupBy("key").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("m"),
                                 F.count("*").alias("labels"))
             .where("labels > 1")
             .select("key", "m", F.col("top.label").alias("main"), (F.col("m") - F.col("top.c")).alias("others")))
    return member.join(state, "key")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5,
                    limit: int = 80, bins: int = BINS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash) for each row of ``df``.

    Two rows are linked when ``100 * |A & B| >= limit * |A | B|`` for their
    sets of ``width``-word shingles (A-Z lower-cased; a shorter text is one
    shingle). ``component_id`` is the smallest doc_id reachable over links; one
    row of each component is ``kept``, the one that holds it. ``text_hash``
    (``xxhash64`` of the text) tells rows of one doc_id apart.

    Ids may be of any type that has an order. Null and empty texts, and texts
    of white space only, have an empty set, are linked with nothing and kept.
    Repeated rows share all values. Rows that share a doc_id but not the text
    are documents of their own; of those that hold a component's smallest id,
    the one with the smallest ``text_hash`` is kept. A row without a doc_id is
    linked like others and heads a component only if no row of it has one
    (``component_id`` is null then). Other columns are ignored; an empty table
    gives none.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    rows_of = written(signatures(docs, "doc_id", "text", width, bins), "signatures")
    members = rows_of.where("n > 0")
    head = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("head")
    classes = written(members.groupBy("node").agg(head, F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    linkable = classes.select(F.col("node").alias("id"), "n", "sketch")
    banded = _bands(linkable, bands, rows).repartition("key")  # one shuffle for both uses
    several = (banded.groupBy("key").agg(F.min(F.struct("id", "n")).alias("head"), F.max("id").alias("top"))
               .where("head.id != top")
               .select("key", F.col("head.id").alias("a"), F.col("head.n").alias("n_a")))
    bucket = written(banded.join(several, "key")
                     .select("key", "id", "n", "a", "n_a"), "buckets")
    sharing = written(bucket.select("id").distinct(), "sharing")
    texts = written(_texts_of(docs, classes, sharing), "texts")  # of texts that share a bucket
    linkable = _maybe_in(linkable, sharing, "id")
    first = (bucket.select("a", "n_a", F.col("id").alias("b"), F.col("n").alias("n_b"))
             .where(F.col("a") != F.col("b")).where(_size_fits(limit)).select("a", "b").distinct())
    links = written(_by_sets(_by_sketch(first, linkable, limit), texts, width, limit), "links")
    label = connected_components(links)
    member = bucket.select("key", "id", "n").join(label, "id", "left").withColumn("label", F.coalesce("label", "id"))
    split = written(_still_split(member), "split")
    alone = _lone_shingles(split.select("id").distinct(), texts, width)
    able = (split.select("key", "id", "n", "label").join(alone, "id", "left").withColumn("lone", F.coalesce("lone", F.lit(0)))
            .where(F.expr(f"100 * (n - lone) >= {limit} * n")))
    split = _still_split(able).join(linkable.select("id", "sketch"), "id")
    more = written(_compare_blocks(split, bands, rows, limit), "candidates")
    links = written(links.unionAll(_by_sets(more, texts, width, limit)), "links")
    label = connected_components(links)
    of_class = classes.select("node", "head").join(label.select(F.col("id").alias("node"), "label"), "node", "left")
    several = of_class.where("label IS NOT NULL")
    heads = several.groupBy("label").agg(F.min("head").alias("top"))
    of_class = (several.join(heads, "label").select("node", "top")
                .unionByName(of_class.where("label IS NULL").select("node", F.col("head").alias("top"))))
    linked = members.join(of_class, "node").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("top.doc_id").alias("component_id"),
        F.expr("doc_id <=> top.doc_id AND text_hash = top.text_hash").alias("kept"), "text_hash")
    alone = rows_of.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                          F.lit(True).alias("kept"), "text_hash")
    return linked.unionAll(alone)


def _maybe_in(df: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key may be in ``keyed``. A filter of bounded size is
    broadcast, so that a join shuffles hardly any wide row that it then drops."""
    return maybe_in(df, keyed, [key]).where("__maybe_seen").drop("__maybe_seen")


def _texts_of(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text): the text of the row that heads each of the classes ``ids``, once."""
    row = lambda d, h: F.xxhash64(d, h)
    wanted = written(classes.select(F.col("node").alias("id"), "head").join(ids, "id").select(
        "id", row("head.doc_id", "head.text_hash").alias("row"), "head"), "wanted")
    found = _maybe_in(docs.withColumn("row", row("doc_id", "text_hash")), wanted, "row").join(wanted, "row").where(
        "doc_id <=> head.doc_id AND text_hash = head.text_hash")
    return found.groupBy("row", "id").agg(F.first("text").alias("text")).select("id", "text")
