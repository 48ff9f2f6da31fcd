"""URL filter by a ratio of two variable-order Markov models over bytes.

Hand-written rules decide the URLs they fit. The URLs they allow and those
they block train one model each: a byte's chance after the longest context in
which it was seen, times the escape from each longer context (method C: a
context with ``n`` occurrences and ``k`` kinds of next byte escapes with k /
(n + k)). A URL that no rule fits is blocked when the length-normalised
difference of its log-likelihoods falls below a threshold, which is calibrated
on allowed and on blocked rule-decided URLs that were kept out of training.
The final counts cover all rule-decided URLs: once the threshold is found, the
models are fitted again with the held-out ones.

Counts are Spark tables that grow with the corpus. A context stays if it
occurs ``SUPPORT`` times and more than one byte follows it; contexts are
lengthened as long as any stays, so how deep the models go is up to the data.
Before grams are shuffled, hashed counts of contexts rule out nearly all whose
context cannot stay.

A log-likelihood is a sum over a URL's contexts and grams (a context with its
next byte): each context adds its escape, each gram what is known beyond that
and beyond the gram one byte shorter. So a model is one table of (key, value),
both models together one table of differences, and a score is the sum of the
values of a URL's keys. A small table is looked up in the tasks. A larger one
never passes through the driver, which only gets bits that tell most keys that
are not in it: the URLs are cut into sorted pieces, each asks once for the keys
it may need, and they are joined. Without a context none of its lengthenings
stays, so no more are tried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written
from .text import bound_batches, fields, map_columns, mix

#: Occurrences that a context needs to stay, and lengths of context that one pass over the URLs counts.
SUPPORT, STEP = 16, 8
#: Contexts are hashed into about two cells a byte of the URLs, within these powers of two, to count which may stay.
LEAST_BITS, MOST_BITS = 16, 26
#: Byte values, and one more that stands before the first byte.
KINDS, START = 256, 256
#: Models of up to this many keys go to the tasks by the driver as two sorted arrays of 16 bytes a key; larger ones are joined.
LOOKUP_KEYS = 32_768
#: Larger ones are joined for pieces of about this many bytes of distinct URLs, and for about so many pieces at least.
PIECE, PIECES = 1 << 20, 48
#: One in so many rule-decided URLs is kept for calibration.
HELD_OUT = 5
#: Largest share of held-out allowed URLs that the threshold may block.
FALSE_BLOCKS = 0.01
#: Held-out scores are counted in cells of this width, up to this size: that bounds what calibration collects.
CELL, LARGEST = 0.001, 32.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.lit(r.text)).otherwise(found)
    return found


class Grams:
    """Keys of the contexts and grams of some URLs, length by length.

    A key is a 64-bit hash of the bytes; a context never reaches beyond the
    mark before its URL's first byte. The scheme is left out.
    """

    def __init__(self, urls: Sequence[str | None]):
        parts = [((u or "").partition("://")[2] or u or "").encode() for u in urls]
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        begins = np.cumsum(sizes) - sizes
        text = np.full(int(sizes.sum()), START, np.int64)
        mark = np.zeros(len(text), bool)
        mark[begins] = True
        text[~mark] = np.frombuffer(b"".join(parts), np.uint8)
        self.text = text.astype(np.uint64) + np.uint64(1)
        self.at = np.flatnonzero(~mark)  # of all bytes that are predicted
        self.owner = np.repeat(np.arange(len(parts)), sizes)[self.at]
        self.room = self.at - begins[self.owner]  # the longest context there is
        self.length = sizes - 1

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        return self.among(None)

    def among(self, stays: Callable[[np.ndarray], np.ndarray] | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, places, context keys, gram keys) for each length of context,
        from 0. Contexts that ``stays`` is false of are left out and not lengthened."""
        places = np.arange(len(self.at))
        context = np.full(len(self.at), np.uint64(0x243F6A8885A308D3))
        length = 0
        while len(places):
            if stays is not None:
                good = stays(context)
                places, context = places[good], context[good]
            yield length, places, context, mix(context * np.uint64(3) + self.text[self.at[places]])
            length += 1
            longer = self.room[places] >= length
            places, context = places[longer], context[longer]
            context = mix(context * np.uint64(5) + self.text[self.at[places] - length])


def _signed(keys: np.ndarray) -> pa.Array:
    return pa.array(keys.view(np.int64))


def _slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of at most ``most`` bytes of URLs, or one URL."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Cells:
    """Which cells of a hash of keys hold enough occurrences for any of their
    keys, of contexts for one, to stay: no such key is ever missed."""

    def __init__(self, flags: np.ndarray, bits: int):
        self.flags, self.shift = flags, np.uint64(64 - bits)

    def may_stay(self, key: np.ndarray) -> np.ndarray:
        cell = key >> self.shift
        return (self.flags[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _cells(df: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None], bits: int, most: int) -> Cells:
    """Cells of at least ``most`` occurrences, which ``count`` adds up over a
    task's batches. A task keeps one byte a cell, as counts beyond ``most``, at
    most 255, decide nothing, and sends the cells it met; at most
    2**MOST_BITS bits come back."""
    wide = min(bits, 16)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            count(batch, total)
        for bucket, part in enumerate(total.reshape(-1, 1 << wide)):
            cell = np.flatnonzero(part)
            if len(cell):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([cell.astype("<u2").tobytes()]),
                                                  pa.array([part[cell].tobytes()])], names=["bucket", "cells", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, cells, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                total = sums.setdefault(bucket, np.zeros(1 << wide, np.uint8))
                cell = np.frombuffer(cells, "<u2")
                total[cell] = np.minimum(total[cell].astype(np.int64) + np.frombuffer(counts, np.uint8), most)
        for bucket, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([np.packbits(total >= most, bitorder="little").tobytes()])],
                                             names=["bucket", "flags"])

    packed = (df.mapInArrow(pack, "bucket int, cells binary, counts binary")
              .repartition("bucket").mapInArrow(merge, "bucket int, flags binary"))
    flags = np.zeros((1 << bits - wide, (1 << wide) // 8), np.uint8)
    for r in packed.collect():
        flags[r["bucket"]] = np.frombuffer(r["flags"], np.uint8)
    return Cells(flags.ravel(), bits)


def context_cells(df: DataFrame, first: int, stems: Broadcast | None, bits: int, support: int) -> Cells:
    """Cells of the contexts of ``first`` to ``first + STEP - 1`` bytes whose
    stem may stay. ``df``: (url, ...)."""
    most, shift = min(support, 255), np.uint64(64 - bits)

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        for part in _slices(batch):
            grams = Grams(part.column(0).to_pylist())
            alive = np.ones(len(grams.at), bool)
            for length, places, context, _ in grams:
                if length >= first + STEP:
                    break
                if length == first - 1:
                    alive[places] = stems.value.may_stay(context)
                if length >= first:
                    cell, n = np.unique(context[alive[places]] >> shift, return_counts=True)
                    total[cell] = np.minimum(total[cell] + n, most)

    return _cells(df.select("url"), count, bits, most)


def key_cells(model: DataFrame, n: int) -> Cells:
    """Cells of the ``n`` keys of a model, eight or more for each within ``MOST_BITS``."""
    bits = min(MOST_BITS, max(LEAST_BITS, n.bit_length() + 3))
    shift = np.uint64(64 - bits)

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        total[batch.column(0).to_numpy().view(np.uint64) >> shift] = 1

    return _cells(model.select("key"), count, bits, 1)


#: Counts of a gram: of all URLs and of those that are fitted on, each without and with the label.
_SIDES = ("all0", "all1", "fit0", "fit1")
_COUNTS = "length int, context long, gram long, shorter long, " + ", ".join(f"{c} long" for c in _SIDES)


def gram_counts(df: DataFrame, first: int, stems: Broadcast | None, cells: Broadcast) -> DataFrame:
    """Counts of the grams whose context has ``first`` to ``first + STEP - 1``
    bytes and may stay. ``shorter`` is the gram's own with one context byte
    less. ``df``: (url, label, held)."""
    names = [c.split()[0] for c in _COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                grams = Grams(part.column(0).to_pylist())
                label, held = (np.array(part.column(i).to_pylist(), bool)[grams.owner] for i in (1, 2))
                alive = np.ones(len(grams.at), bool)
                before = np.zeros(len(grams.at), np.uint64)
                for length, places, context, gram in grams:
                    if length >= first + STEP:
                        break
                    if length == first - 1:
                        alive[places] = stems.value.may_stay(context)
                    if length >= first:
                        good = alive[places]
                        if length:
                            good = good & cells.value.may_stay(context)
                        some, at, group = np.unique(gram[good], return_index=True, return_inverse=True)
                        p = places[good]
                        counts = [np.bincount(group[chosen], minlength=len(some)) for chosen in
                                  (~label[p], label[p], ~label[p] & ~held[p], label[p] & ~held[p])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), length, np.int32)), _signed(context[good][at]), _signed(some),
                             _signed(before[p[at]]), *[pa.array(n.astype(np.int64)) for n in counts]], names=names)
                    before[places] = gram

    return df.mapInArrow(run, _COUNTS)


def _contexts(rows: DataFrame, support: int) -> DataFrame:
    """The contexts that stay, each with its at most 257 grams: ``stays_*``,
    sums ``s_*`` and kinds ``k_*`` of all and of the fitted-on URLs."""
    total = rows.agg(F.sum(F.octet_length("url"))).first()[0] or 0
    bits = min(MOST_BITS, max(LEAST_BITS, int(total).bit_length() + 1))
    shared = rows.sparkSession.sparkContext
    found, first, stems = None, 0, None
    while True:
        cells = shared.broadcast(context_cells(rows, first, stems, bits, support))
        grams = gram_counts(rows, first, stems, cells).groupBy("length", "context", "gram", "shorter").agg(
            *[F.sum(c).alias(c) for c in _SIDES])
        by = grams.groupBy("length", "context").agg(
            F.collect_list(F.struct("gram", "shorter", *_SIDES)).alias("grams"), F.count("*").alias("k_all"),
            F.count_if(F.col("fit0") + F.col("fit1") > 0).alias("k_fit"),
            *[F.sum(c).alias(f"s_{c}") for c in _SIDES], *[F.count_if(F.col(c) > 0).alias(f"k_{c}") for c in _SIDES])
        # a context stays with its counts of both models; that of length 0 always does
        for v in ("all", "fit"):
            by = by.withColumn(f"stays_{v}", F.expr(f"length = 0 OR (s_{v}0 + s_{v}1 >= {support} AND k_{v} > 1)"))
        by = written(by.where("stays_all"), "url-contexts")
        found = by if found is None else found.unionByName(by)
        first += STEP
        if not by.where(F.col("length") == first - 1).limit(1).count():
            return found
        stems = cells


def train(df: DataFrame, url: str, label: str, support: int = SUPPORT, held: str | None = None) -> DataFrame:
    """(key, length, n, value): for each context and gram that stays its
    occurrences and what it adds to a URL's log-likelihood under the model of
    the rows with a true ``label``, less that under the model of the others.

    With ``held`` also (n_fit, value_fit), the same without the rows where
    that column is true: n_fit is 0 where the smaller model has no such key.
    Both come from one count, since what stays without some rows stays with them."""
    rows = df.select(F.col(url).alias("url"), F.col(label).cast("boolean").alias("label"),
                     (F.col(held) if held else F.lit(False)).alias("held")).where("url IS NOT NULL")
    found = _contexts(rows, support)
    root = F.col("length") == 0

    def escape(side: str) -> Column:
        # at length 0 each byte value has been seen once more than it was, and the rest is the escape
        n, k = F.col(f"s_{side}"), F.col(f"k_{side}")
        return F.when(F.col(f"stays_{side[:-1]}") & (n > 0), F.when(root, -F.log(n + KINDS)).otherwise(F.log(k / (n + k))))

    def chance(side: str) -> Column:
        n, s, k = F.col(f"g.{side}"), F.col(f"s_{side}"), F.col(f"k_{side}")
        return F.when(F.col(f"stays_{side[:-1]}") & (n > 0), F.when(root, F.log((n + 1) / (s + KINDS))).otherwise(F.log(n / (s + k))))

    def outcome(v: str, times: Column, parts: dict[str, Column]) -> list[Column]:
        value = F.coalesce(parts[f"{v}1"], F.lit(0.0)) - F.coalesce(parts[f"{v}0"], F.lit(0.0))
        tail = "" if v == "all" else "_fit"
        return [F.when(F.col(f"stays_{v}"), times).otherwise(0).alias(f"n{tail}"), value.alias(f"value{tail}")]

    versions = ("all", "fit") if held else ("all",)
    of_contexts = found.select(F.col("context").alias("key"), "length", *[
        c for v in versions for c in outcome(v, F.col(f"s_{v}0") + F.col(f"s_{v}1"), {s: escape(s) for s in _SIDES})])
    grams = found.withColumn("g", F.explode("grams")).select(
        "g.gram", "g.shorter", "length", "stays_all", "stays_fit", *[F.col(f"g.{s}").alias(s) for s in _SIDES],
        *[escape(s).alias(f"e_{s}") for s in _SIDES], *[chance(s).alias(f"c_{s}") for s in _SIDES])
    parent = grams.select(F.col("gram").alias("shorter"), *[F.col(f"c_{s}").alias(f"p_{s}") for s in _SIDES])
    gain = {s: F.col(f"c_{s}") - F.coalesce(f"p_{s}", F.lit(0.0)) - F.col(f"e_{s}") for s in _SIDES}
    # shuffled: exploded, the parents are many times what a plan takes them for, and the driver would broadcast them
    of_grams = grams.join(parent.hint("merge"), "shorter", "left").select(F.col("gram").alias("key"), "length", *[
        c for v in versions for c in outcome(v, F.col(f"{v}0") + F.col(f"{v}1"), gain)])
    return written(of_contexts.unionByName(of_grams), "url-model")


def score(df: DataFrame, model: DataFrame, url: str = "url", out: str = "score", lookup_keys: int = LOOKUP_KEYS) -> DataFrame:
    """Append the mean log-likelihood difference per byte; null and empty URLs get 0."""
    n = model.count()
    return _score_in_tasks(df, model, url, out) if n <= lookup_keys else _score_by_join(df, model, n, url, out)


class Lookup:
    """The values of a model's keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float64)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.keys[self._at(keys)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """0 for a key that there is not."""
        at = self._at(keys)
        return np.where(self.keys[at] == keys, self.values[at], 0.0)

    def scores(self, urls: Sequence[str | None]) -> np.ndarray:
        grams = Grams(urls)
        total = np.zeros(len(grams.length))
        for _, places, context, gram in grams.among(self.has):
            if len(places):
                for k in (context, gram):
                    total += np.bincount(grams.owner[places], self.of(k), len(total))
        return total / np.maximum(grams.length, 1)


def _score_in_tasks(df: DataFrame, model: DataFrame, url: str, out: str) -> DataFrame:
    got = model.select("key", "value").toArrow()  # at most LOOKUP_KEYS rows
    shared = df.sparkSession.sparkContext.broadcast(Lookup(got["key"].to_numpy(), got["value"].to_numpy()))
    return map_columns(df, [url], fields([(out, T.DoubleType())]),
                       lambda column: [pa.array(shared.value.scores(column.to_pylist()), pa.float64())])


def _pieces(urls: DataFrame) -> DataFrame:
    """(piece, urls): distinct URLs, similar ones together, in pieces of up to
    twice ``PIECE`` bytes or one URL. ``urls``: a written table (url)."""
    total = urls.agg(F.sum(F.octet_length("url"))).first()[0] or 0
    most = max(1, min(PIECE, total // PIECES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0

        def piece(parts: list[pa.Array]) -> pa.RecordBatch:
            whole = pa.concat_arrays(parts)
            return pa.RecordBatch.from_arrays([pa.array([(task << 32) + n], pa.int64()), pa.ListArray.from_arrays([0, len(whole)], whole)],
                                              names=["piece", "urls"])

        held, size = [], 0
        for batch in batches:
            for part in _slices(batch, most):
                more = pc.sum(pc.binary_length(part.column(0))).as_py()
                if held and size + more > 2 * most:
                    yield piece(held)
                    held, size, n = [], 0, n + 1
                held.append(part.column(0))
                size += more
        if held:
            yield piece(held)

    start = F.expr("substr(url, locate('://', url) + 3)")
    dealt = urls.repartitionByRange(total // most + 1, start).sortWithinPartitions(start)
    return written(dealt.mapInArrow(cut, "piece long, urls array<string>"), "url-pieces")


def _score_by_join(df: DataFrame, model: DataFrame, n: int, url: str, out: str) -> DataFrame:
    """The same, piece by piece of the distinct URLs: the keys that a piece may
    need are joined with the model, each once, and come back to it."""
    bound_batches(df.sparkSession)
    cells = df.sparkSession.sparkContext.broadcast(key_cells(model, n))
    pieces = _pieces(written(df.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct(), "urls"))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, urls in zip(*batch.columns, strict=True):
                grams = Grams(urls.as_py())
                for _, _, context, gram in grams.among(cells.value.may_stay):
                    for k in (np.unique(context), np.unique(gram[cells.value.may_stay(gram)])):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), piece.as_py())), _signed(k)], names=["piece", "key"])

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        lookup = Lookup(right["key"].to_numpy(), right["value"].to_numpy())
        urls = left["urls"].combine_chunks().flatten()
        return pa.table({"__url": urls, "__score": pa.array(lookup.scores(urls.to_pylist()), pa.float64())})

    # shuffled: a plan's guess of either side's size would have the driver broadcast it
    asked = pieces.mapInArrow(ask, "piece long, key long").join(model.select("key", "value").hint("merge"), "key")
    found = pieces.groupBy("piece").cogroup(asked.select("piece", "key", "value").groupBy("piece")).applyInArrow(
        sums, "__url string, __score double")
    kept = [F.col(f"l.`{c}`") for c in df.columns if c.lower() != out.lower()]
    return df.alias("l").join(found, F.expr(f"l.`{url}` = __url"), "left").select(
        *kept, F.coalesce("__score", F.lit(0.0)).alias(out))


def limit_between(cells: Sequence[tuple[int, int, float, float]], false_blocks: float) -> float | None:
    """The limit with the smallest sum of error rates, from (allowed, blocked,
    lowest score, highest score) of each cell in order; None without both kinds.

    At most ``false_blocks`` of the allowed lie below it. It is the middle of
    the two scores it parts, and not above 0 unless a score that it should
    block is: 0 is where both models find a URL equally likely. Limits of equal
    error block less.
    """
    good, bad = sum(c[0] for c in cells), sum(c[1] for c in cells)
    if not good or not bad:
        return None
    best, limit, lost, caught = 1.0, float("-inf"), 0, 0
    for below, above in zip(cells, [*cells[1:], None], strict=True):
        lost, caught = lost + below[0], caught + below[1]
        error = lost / good + 1 - caught / bad
        if lost <= false_blocks * good and error < best:
            middle = (below[3] + above[2]) / 2 if above else np.nextafter(below[3], np.inf)
            best, limit = error, min(middle, 0.0) if below[3] < 0 else middle
    return float(limit)


def calibrate(scored: DataFrame, false_blocks: float = FALSE_BLOCKS) -> float | None:
    """``limit_between`` for held-out URLs with a ``score`` and whether they are allowed (``y``)."""
    cell = F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.col("score"))) / CELL)
    rows = (scored.groupBy(cell.alias("cell"))
            .agg(F.count_if("y"), F.count_if(~F.col("y")), F.min("score"), F.max("score")).collect())
    return limit_between([tuple(r)[1:] for r in sorted(rows)], false_blocks)


def judge(df: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id",
          false_blocks: float = FALSE_BLOCKS) -> DataFrame:
    """Append ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    The rule's verdict where one fits, else ``block`` if the score lies below
    the calibrated threshold, else ``allow``. Null URLs and URLs without
    ``://`` have an empty host and path, fit no rule and are judged by score
    (null and empty: 0). Without both allowed and blocked URLs to train on and
    to calibrate with, nothing is blocked by score. Repeated rows
    are judged alike; columns of the added names are replaced.
    """
    taken = ("host", "path", "rule", "score", "verdict")
    base = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
    base = base.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = [r.text for r in rules if r.verdict == "allow"]
    # equal URLs lie on one side of the split
    decided = base.where("rule IS NOT NULL").select(
        F.col(url).alias("url"), F.col("rule").isin(allowed).alias("y"),
        (F.pmod(F.xxhash64(url), F.lit(HELD_OUT)) == 0).alias("held"))
    sides = {r["y"]: r["count"] for r in decided.where("NOT held").groupBy("y").count().collect()}
    if len(sides) == 2:
        model = train(decided, "url", "y", held="held")
        fitted = model.where("n_fit > 0").select("key", "length", F.col("n_fit").alias("n"), F.col("value_fit").alias("value"))
        limit = calibrate(score(decided.where("held"), fitted, "url"), false_blocks)
        scored = score(base, model.select("key", "length", "n", "value"), url)
    else:
        scored, limit = base.withColumn("score", F.lit(0.0)), None
    by_rule = F.when(F.col("rule").isin(allowed), "allow").when(F.col("rule").isNotNull(), "block")
    by_score = F.when(F.col("score") < (limit if limit is not None else float("-inf")), "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce(by_rule, by_score))
