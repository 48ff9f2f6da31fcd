"""Phrase collocations from a weighted de Bruijn graph.

Nodes are runs of ``longest - 1`` words, an edge is a run of ``longest`` words
and joins the two nodes it holds; its weight is how often it occurs. Texts are
cut into pieces and for every word the longest run that begins there is
counted: an edge, or, near the end of its piece, a shorter run. These counts
are the only ones taken from the text. A shorter phrase's count is the flow
through its node: the weights of all runs it begins, plus the runs that end
the piece with it (``flow``).

A phrase with a frequency below ``min_count`` is no candidate, and no part of
one. So before the graph is built, passes count hashed words, pairs, ... up to
a node's length, each only where the shorter ones are frequent, and the runs
of the graph end where the next would be rare. Hashes that collide only raise
a count, so what is frequent is never cut, and all counts of frequent phrases
are exact.

Unary paths, along which every node has one frequent edge in and one out, are
compacted by pointer doubling (``compact``): each edge learns its path and the
path's length in words, so phrases longer than ``longest`` are seen whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written
from .text import mix

MIN_COUNT, LONGEST, COVER, TOP = 30, 4, 80, 2000
SCALE = 2_000_000
NO_LANG = "und"
#: Cells (as a power of two) of the bitmaps of frequent hashed words, and of longer runs: 8 and 16 MB
#: at any input size.
WORD_BITS, RUN_BITS = 26, 27
#: Cells that are counted together (their numbers fit 16 bits), 4 KB of a bitmap.
BUCKET_BITS = 15
#: Bytes of text taken at once, and words that a Python worker remembers.
CHUNK_BYTES, KNOWN_WORDS = 2 << 20, 300_000
#: A part of more cuts than this is joined by a broadcast; there are at most cuts / HOT_PART of them.
HOT_PART = 5_000

# fixed values: what parts pieces, and A-Z in lower case; a tab parts words like a space
_TABLE = bytearray(range(256))
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 10
for _c in range(65, 91):
    _TABLE[_c] = _c + 32
_TABLE[9] = 32
_TABLE = bytes(_TABLE)
_GAP, _BREAK = 0, 1  # ids of the empty token and of the break between pieces


class _Words(dict):
    """Ids of a worker's words, dense from 0, and their hashes."""

    def __init__(self) -> None:
        super().__init__({b"": _GAP, b"\n": _BREAK})
        self.words: list[bytes] = [b"", b"\n"]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        return n

    def hashes(self, known: np.ndarray) -> np.ndarray:
        new = [xxhash.xxh64_intdigest(w) for w in self.words[len(known):]]
        return np.concatenate([known, np.array(new, np.uint64)])


def _chunks(text: bytes) -> Iterator[bytes]:
    """Parts of a normalised text, cut between pieces."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        end = text.find(b"\n", at + CHUNK_BYTES)
        if end < 0:
            break
        yield text[at:end]
        at = end + 1
    yield text[at:]


def _token_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """(lang, text) of many documents of one language at a time, pieces parted by line feeds."""
    waiting: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for chunk in _chunks(text.encode().translate(_TABLE)):
                    waiting.setdefault(lang, []).append(chunk)
                    sizes[lang] = sizes.get(lang, 0) + len(chunk)
                    if sizes[lang] >= CHUNK_BYTES:
                        yield lang, b"\n".join(waiting.pop(lang))
                        sizes[lang] = 0
                    elif len(waiting) > 64:  # many languages: hand over what there is
                        for other in list(waiting):
                            yield other, b"\n".join(waiting.pop(other))
                        sizes.clear()
    for lang, parts in waiting.items():
        yield lang, b"\n".join(parts)


class Scanner:
    """Turns texts into word ids and looks up which runs of words are frequent.

    ``maps[k - 1]`` is the bitmap of frequent runs of ``k`` words.
    """

    def __init__(self, maps: list[np.ndarray]):
        self.maps = maps
        self._reset()

    def _reset(self) -> None:
        self.ids, self.hash = _Words(), np.empty(0, np.uint64)

    def read(self, text: bytes) -> np.ndarray:
        """The ids of the text's words and breaks, in order."""
        if len(self.ids.words) > KNOWN_WORDS:
            self._reset()
        tokens = text.replace(b"\n", b" \n ").split(b" ")
        at = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        self.hash = self.ids.hashes(self.hash)
        return at[at != _GAP]

    def levels(self, lang: str, ids: np.ndarray, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of 1, 2, ... ``upto`` words: the places where one begins
        whose shorter runs are all frequent, and the run's cell."""
        at = np.flatnonzero(ids != _BREAK)
        word = self.hash[ids]
        run = mix(word ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())))
        for k in range(1, upto + 1):
            cells = (run[at] >> np.uint64(64 - _bits(k))).astype(np.int64)
            yield at, cells
            if k == upto:
                return
            good = np.zeros(len(ids) + 1, bool)
            good[at] = _test(self.maps[k - 1], cells)
            at = np.flatnonzero(good[:-1] & good[1:])  # both runs of k words in a run of one more
            longer = np.zeros_like(run)
            longer[at] = mix(run[at] * np.uint64(3) + word[at + k])
            run = longer

    def runs(self, lang: str, ids: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, length): the longest run of up to ``longest`` words that
        begins at each frequent word, all its parts of up to ``longest - 1``
        words frequent."""
        length = np.zeros(len(ids) + 1, np.int8)
        for k, (at, cells) in enumerate(self.levels(lang, ids, longest - 1), 1):
            good = at[_test(self.maps[k - 1], cells)]
            length[good] = k
        whole = length >= longest - 1
        length[:-1][whole[:-1] & whole[1:]] = longest
        starts = np.flatnonzero(length)
        return starts, length[starts]


def _bits(k: int) -> int:
    return WORD_BITS if k == 1 else RUN_BITS


def _test(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def _scan(df: DataFrame, schema: str, maps: list[np.ndarray],
          each: Callable[[Scanner, str, np.ndarray], list[pa.Array]]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(maps)
        for lang, text in _token_streams(batches):
            yield pa.RecordBatch.from_arrays(each(scanner, lang, scanner.read(text)), names=names)

    names = [c.split()[0] for c in schema.split(", ")]
    return df.mapInArrow(run, schema)


def _binaries(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each range of ``data`` between two of ``ends``."""
    offsets = (ends * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _frequent(docs: DataFrame, maps: list[np.ndarray], min_count: int) -> np.ndarray:
    """The bitmap of frequent runs one word longer than those of ``maps``.

    A task sends the distinct cells of a chunk with their counts, packed by
    bucket; counts need not grow beyond ``min_count``. A bucket's counts are
    added up one packet after the other.
    """
    k = len(maps) + 1
    kind = np.dtype("<u1") if min_count < 256 else np.dtype("<u4")

    def cells(scan: Scanner, lang: str, ids: np.ndarray) -> list[pa.Array]:
        for _, found in scan.levels(lang, ids, k):
            pass
        at, n = np.unique(found, return_counts=True)
        bucket = at >> BUCKET_BITS
        ends = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(at))
        return [pa.array(bucket[ends[:-1]].astype(np.int32)),
                _binaries((at & ((1 << BUCKET_BITS) - 1)).astype("<u2"), ends),
                _binaries(np.minimum(n, min_count).astype(kind), ends)]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, total = None, np.zeros(1 << BUCKET_BITS, np.int64)

        def done() -> pa.RecordBatch:
            bits = np.packbits(total >= min_count, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([bits], pa.binary())], names=["bucket", "bits"])

        for batch in batches:
            for b, cell, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if b != bucket:
                    if bucket is not None:
                        yield done()
                    bucket = b
                    total[:] = 0
                total[np.frombuffer(cell, "<u2")] += np.frombuffer(n, kind)
        if bucket is not None:
            yield done()

    packets = _scan(docs, "bucket int, cells binary, counts binary", maps, cells)
    merged = packets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add_up, "bucket int, bits binary")
    out, size = np.zeros(1 << (_bits(k) - 3), np.uint8), 1 << (BUCKET_BITS - 3)
    for bucket, bits in merged.collect():  # 8 or 16 MB at most, whatever the input
        out[bucket * size:(bucket + 1) * size] = np.frombuffer(bits, np.uint8)
    return out


def longest_grams(docs: DataFrame, min_count: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """The graph's edges and the shorter runs that end where no frequent run
    goes on, as (lang, phrase, k, w), and (lang, n) with all word occurrences."""
    maps: list[np.ndarray] = []
    while len(maps) < longest - 1:
        maps.append(_frequent(docs, maps, min_count))

    def grams(scan: Scanner, lang: str, ids: np.ndarray) -> list[pa.Array]:
        starts, length = scan.runs(lang, ids, longest)
        padded = np.concatenate([ids, np.zeros(longest, np.int64)])
        columns = [np.where(length > j, padded[starts + j], _GAP) for j in range(longest)]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        first = np.flatnonzero(new)
        weight = np.diff(np.append(first, len(order)))
        used, place = np.unique(np.concatenate([[_GAP], *[c[first] for c in columns]]), return_inverse=True)
        names = pa.array([scan.ids.words[i].decode() if i else None for i in used.tolist()], pa.string())
        parts = np.split(place[1:], longest)
        text = pc.binary_join_element_wise(*[names.take(pa.array(p)) for p in parts], " ", null_handling="skip")
        # the last row counts all words
        n = int((ids != _BREAK).sum())
        return [pa.array([lang] * (len(first) + 1), pa.string()), pa.concat_arrays([text, pa.array([""], pa.string())]),
                pa.array(np.append(weight, n).astype(np.int64))]

    k = F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1)
    runs = _scan(docs, "lang string, phrase string, w long", maps, grams).groupBy("lang", "phrase").agg(F.sum("w").alias("w"))
    runs = written(runs.select("lang", "phrase", k.alias("k"), "w"), "phrase-runs")
    return runs.where("k > 0"), runs.where("k = 0").select("lang", F.col("w").alias("n"))


def _head(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", k)


def _tail(phrase: Column, k: int) -> Column:
    return F.substring_index(phrase, " ", -k)


def flow(runs: DataFrame, min_count: int, longest: int) -> DataFrame:
    """(lang, phrase, k, f) of all phrases with ``f >= min_count``.

    From the longest to single words: a phrase's count is the sum over the
    runs one word longer that it begins, and the runs that end a piece with it.
    """
    out, level = None, runs.where(F.col("k") == longest).select("lang", "phrase", F.col("w").alias("f"))
    for k in range(longest, 0, -1):
        kept = level.where(F.col("f") >= min_count).select("lang", "phrase", F.lit(k).alias("k"), "f")
        out = kept if out is None else out.unionAll(kept)
        if k > 1:
            ends = runs.where(F.col("k") == k - 1).select("lang", "phrase", F.col("w").alias("f"))
            level = (level.select("lang", _head(F.col("phrase"), k - 1).alias("phrase"), "f").unionAll(ends)
                     .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
            level = written(level, f"phrase-flow-{k - 1}") if k > 2 else level
    return written(out, "phrases")


def compact(phrases: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, path_end, path_words) of each frequent edge: the last
    edge of the unary path it lies on, and the path's length in words. Edges
    of a closed ring have no end: both are null.

    Pointer doubling: in each round an edge's pointer leaps to its pointer's
    pointer, so the rounds grow with the logarithm of the longest path. No
    path is gathered in one place.
    """
    edges = phrases.where(F.col("k") == longest).select("lang", "phrase")
    into, out = _tail(F.col("phrase"), longest - 1), _head(F.col("phrase"), longest - 1)
    ins = edges.groupBy("lang", into.alias("node")).agg(F.count("*").alias("n"), F.min("phrase").alias("edge"))
    outs = edges.groupBy("lang", out.alias("node")).agg(F.count("*").alias("n"), F.min("phrase").alias("next"))
    unary = (ins.where("n = 1").drop("n").join(outs.where("n = 1").drop("n"), ["lang", "node"])
             .select("lang", F.col("edge").alias("phrase"), "next").where("phrase != next"))
    step = written(edges.join(unary, ["lang", "phrase"], "left")
                   .select("lang", "phrase", "next", F.when(F.col("next").isNotNull(), 1).otherwise(0).cast("long").alias("after")),
                   "path-steps")
    open_before = None
    while True:
        still = step.where("next IS NOT NULL").count()
        ahead = step.select("lang", F.col("phrase").alias("next"), F.col("next").alias("leap"), F.col("after").alias("more"))
        moving = step.where("next IS NOT NULL").join(ahead, ["lang", "next"], "left")
        # an edge that points at a path's end keeps pointing there; it is settled
        settled = moving.where("leap IS NULL").count()
        if still == settled or still - settled == open_before:  # what never settles are rings
            break
        open_before = still - settled
        step = written(step.where("next IS NULL").unionByName(moving.select(
            "lang", "phrase", F.coalesce("leap", "next").alias("next"), (F.col("after") + F.col("more")).alias("after"))),
            "path-steps")
    ends = step.where("next IS NULL").select("lang", F.col("phrase").alias("end"))
    on_path = (step.select("lang", "phrase", F.coalesce("next", "phrase").alias("end"), "after")
               .join(ends, ["lang", "end"]))
    long = on_path.groupBy("lang", "end").agg((F.max("after") + longest).alias("path_words"))
    return (edges.join(on_path, ["lang", "phrase"], "left").join(long, ["lang", "end"], "left")
            .select("lang", "phrase", F.col("end").alias("path_end"), "path_words"))


def _looked_up(parts: DataFrame, phrases: DataFrame, hot_part: int) -> DataFrame:
    """The rows of ``parts`` (lang, part, ...) with ``f`` of their part. A
    frequent word is part of very many phrases: what is looked up more than
    ``hot_part`` times is broadcast, which bounds both that table and the rows
    that meet at any other part."""
    uses = parts.groupBy("lang", "part").agg(F.count("*").alias("uses"))
    counts = written(uses.join(phrases.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"]), "phrase-parts")
    hot = counts.where(F.col("uses") > hot_part).drop("uses")
    cold = counts.where(F.col("uses") <= hot_part).drop("uses")
    return (parts.join(F.broadcast(hot), ["lang", "part"])
            .unionByName(parts.join(cold, ["lang", "part"])))


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT,
                 longest: int = LONGEST, cover: int = COVER, top: int = TOP, hot_part: int = HOT_PART) -> DataFrame:
    """The best ``top`` phrases of each language: (lang, rank, phrase, a, l, r,
    n, score, path_end, path_words).

    ``a`` is the phrase's frequency, ``l`` and ``r`` those of its two parts at
    the cut with the lowest score (the first of equal ones), ``n`` all word
    occurrences of the language, ``score`` = floor(2 000 000 a / (l + r)).
    Phrases inside a longer one with ``100 f >= cover * a`` are left out.
    Phrases of ``longest`` words name the unary path they lie on.

    A null language is ``und``; null and empty texts hold no word; repeated
    rows count each time; other columns, whatever their names, are ignored;
    an empty table gives no row. A piece is cut into words whole, however long.
    """
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text"))
    docs = docs.where("text IS NOT NULL AND text != ''")
    runs, totals = longest_grams(docs, min_count, longest)
    phrases = flow(runs, min_count, longest)
    longer = phrases.where("k > 1")
    # a phrase inside one that is two words longer is also inside one in between, which is as frequent
    around = longer.where("k > 2").select("lang", "f", F.explode(F.array_distinct(F.array(
        F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substring_index(phrase, ' ', 1 - k)")))).alias("phrase"))
    covered = around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = longer.join(covered, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (big("most") * 100 < big("f") * cover)).select("lang", "phrase", "k", F.col("f").alias("a"))
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    sides = cuts.select("lang", "phrase", "a", "cut", F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.expr("substring_index(phrase, ' ', cut)").alias("part")),
        F.struct(F.lit(False).alias("left"), F.expr("substring_index(phrase, ' ', cut - k)").alias("part")))).alias("s"))
    known = _looked_up(written(sides.select("lang", "phrase", "a", "cut", "s.left", "s.part"), "phrase-cuts"), phrases, hot_part)
    scored = known.groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    score = F.expr(f"(CAST(a AS DECIMAL(20,0)) * CAST({SCALE} AS DECIMAL(8,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    best = (scored.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.score", "b.l", "b.r"))
    # Spark keeps the first ``top`` of every partition before a language meets in one
    ranked = best.withColumn("rank", F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")) \
        .where(F.col("rank") <= top)
    paths = compact(phrases, longest)
    return (ranked.join(F.broadcast(totals), "lang", "left").join(paths, ["lang", "phrase"], "left")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score"), "path_end", "path_words"))
