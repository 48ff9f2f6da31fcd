"""Repeated passages by fixed-block anchors.

A passage of ``window`` words that occurs twice holds, in each place, a whole
block of that text's own grid of ``block = (window + 1) // 2`` words. So:

1. The blocks of all documents are the index; every rolling window of block
   width, at any offset, is a probe. A block is *hit* when its words also
   start anywhere else.
2. Hits are extended: of the windows around a hit block, those whose full word
   sequence also starts elsewhere are repeats; overlapping ones join to the
   maximal repeat, whose words are removed.

Only hashes travel. Documents are dealt into groups by a hash of their
content; a group sends each hash once, whatever its multiplicity there, in
sorted packed form to the bucket that owns the hash's range; the bucket
answers with one bit for each hash that asked. A passage shared by a third of
all documents thus costs each group one entry. Block hashes are cut to a
length that grows with the corpus (about one chance hit in 500 blocks, which
step 2 refutes); windows are compared by 64 bits.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written
from .text import ascii_words, covered, window_hashes, word_hashes

WINDOW = 35
#: Text that a group of documents or a bucket of hashes stands for, in bytes; fewest buckets.
GROUP_BYTES, LEAST_BUCKETS = 8 << 20, 64

_SENT = "bucket int, g int, size int, hashes binary, marks binary"
_ANSWER = "g int, phase int, bucket int, size int, hits binary"
_RESULT = "n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>"


def pack(values: np.ndarray) -> bytes:
    """Sorted 64-bit values as differences, byte plane by byte plane, so that the shuffle's
    compression drops the planes of zeros."""
    return np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(raw: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, size)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Group:
    """The documents of one group as one run of word hashes. Texts with fewer
    words than a window take no part."""

    def __init__(self, texts: list[str | None], window: int, bits: int):
        self.window, self.block = window, (window + 1) // 2
        self.words = [ascii_words(t) for t in texts]
        self.length = np.array([len(w) if len(w) >= window else 0 for w in self.words], np.int64)
        h = word_hashes([x for w in self.words if len(w) >= window for x in w])
        self.n = len(h)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.at = np.arange(self.n) - np.repeat(self.start[:-1], self.length)
        self.left = np.repeat(self.length, self.length) - self.at
        self.h, self.shift = h, np.uint64(64 - bits)

    def of_width(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows inside a document, and their hashes."""
        made = window_hashes(self.h, width)
        starts = np.flatnonzero(self.left[:len(made)] >= width)
        return starts, made[starts]

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct cut hashes of all rolling windows; which are blocks; which occur twice here."""
        starts, made = self.of_width(self.block)
        value, which, count = np.unique(made >> self.shift, return_inverse=True, return_counts=True)
        asks = np.zeros(len(value), bool)
        asks[which[self.at[starts] % self.block == 0]] = True
        return value, asks, count > 1

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows that hold a hit block. ``hit``:
        for each distinct block hash, in order, whether it was hit."""
        starts, made = self.of_width(self.block)
        own = self.at[starts] % self.block == 0
        starts, made = starts[own], made[own] >> self.shift
        _, which = np.unique(made, return_inverse=True)
        starts = starts[hit[which]] if len(starts) else starts
        near = np.zeros(self.n + 1, np.int64)
        first = np.maximum(starts - (self.window - self.block), self.start[:-1][np.searchsorted(self.start, starts, "right") - 1])
        np.add.at(near, first, 1)
        np.add.at(near, starts + 1, -1)
        full, made = self.of_width(self.window)
        chosen = np.cumsum(near[:-1])[full] > 0
        return full[chosen], made[chosen]

    def result(self, repeated: np.ndarray) -> pa.RecordBatch:
        """Counts, kept words and removed spans of each text, given the starts of its repeats."""
        gone = covered(repeated, self.window, self.n)
        out: list[tuple] = []
        for i, words in enumerate(self.words):
            cut = gone[self.start[i]:self.start[i + 1]]
            if not cut.any():
                out.append((len(words), 0, b" ".join(words).decode(), []))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate([[0], cut.view(np.int8), [0]]))).reshape(-1, 2).tolist()
            out.append((len(words), int(cut.sum()), b" ".join(compress(words, ~cut)).decode(),
                        [{"start": a, "end": b} for a, b in edge]))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        return [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]


def _bucket_ends(values: np.ndarray, bits: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Filled buckets of sorted values, and where each bucket's values end."""
    top = (values >> np.uint64(max(bits - 32, 0))).astype(np.uint64)
    owner = (top * np.uint64(buckets)) >> np.uint64(min(bits, 32))
    first = np.flatnonzero(np.diff(owner.astype(np.int64), prepend=-1))
    return owner[first].astype(np.int64), np.append(first, len(values))


def _send(g: int, values: np.ndarray, asks: np.ndarray, twice: np.ndarray, bits: int, buckets: int) -> pa.Table:
    owner, ends = _bucket_ends(values, bits, buckets)
    rows = [(int(o), g, int(b - a), pack(values[a:b]), np.packbits(np.concatenate([asks[a:b], twice[a:b]])).tobytes())
            for o, a, b in zip(owner, ends, ends[1:], strict=False)]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                names=["bucket", "g", "size", "hashes", "marks"])


def _answers(sent: DataFrame, phase: int) -> DataFrame:
    """For each sent row with questions, a bit for each: is that hash anywhere else?"""

    def run(table: pa.Table) -> pa.Table:
        sizes = table["size"].to_pylist()
        values, asks, twice = [], [], []
        for size, raw, marks in zip(sizes, table["hashes"], table["marks"], strict=True):
            values.append(unpack(raw.as_py(), size))
            bits = np.unpackbits(np.frombuffer(marks.as_py(), np.uint8), count=2 * size).astype(bool)
            asks.append(bits[:size])
            twice.append(bits[size:])
        _, which, count = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
        count = count + np.bincount(which[np.concatenate(twice)], minlength=len(count))
        hit, at, rows = count[which] > 1, 0, []
        for i, ask in enumerate(asks):
            if ask.any():
                rows.append((i, int(ask.sum()), np.packbits(hit[at:at + len(ask)][ask]).tobytes()))
            at += len(ask)
        index = [r[0] for r in rows]
        return pa.Table.from_arrays(
            [table["g"].combine_chunks().take(pa.array(index, pa.int32())), pa.array([phase] * len(rows), pa.int32()),
             table["bucket"].combine_chunks().take(pa.array(index, pa.int32())),
             pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
            names=["g", "phase", "bucket", "size", "hits"])

    return sent.groupBy("bucket").applyInArrow(run, _ANSWER)


def _hits(answers: pa.Table, phase: int) -> np.ndarray:
    """A group's answers in the order of its sorted hashes."""
    rows = sorted((b, n, raw) for p, b, n, raw in zip(*(answers[c].to_pylist() for c in ("phase", "bucket", "size", "hits")),
                                                      strict=True) if p == phase)
    bits = [np.unpackbits(np.frombuffer(raw, np.uint8), count=n) for _, n, raw in rows]
    return np.concatenate(bits).astype(bool) if bits else np.empty(0, bool)


def repeated_passages(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                      group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed) for each row of ``df``.

    Every word covered by a window of ``window`` consecutive words whose
    sequence also starts anywhere else, in this or another row, is removed;
    ``removed`` lists the spans (word positions, end exclusive), ``kept_text``
    is the other words joined by one space. Words are runs of anything but
    ASCII white space, compared as they are.

    Null and empty texts have no words and an empty ``kept_text``; texts
    shorter than a window keep all words. Repeated rows repeat each other.
    Rows without a doc_id take part like any other. Other columns are ignored;
    an empty table gives none.
    """
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(partitions, -(-total // group_bytes))
    buckets = max(LEAST_BUCKETS, -(-total // group_bytes))
    bits = min(64, max(33, total.bit_length() + 7))  # words are shorter than four bytes hardly ever: 2**9 per word
    docs = docs.withColumn("g", F.expr(f"CAST(pmod(xxhash64(doc_id, text), {groups}) AS INT)"))

    def probe(table: pa.Table) -> pa.Table:
        value, asks, twice = Group(table["text"].to_pylist(), window, bits).probes()
        return _send(table["g"][0].as_py(), value, asks, twice, bits, buckets)

    def widen(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return _send(0, np.empty(0, np.uint64), np.empty(0, bool), np.empty(0, bool), 64, buckets)
        _, made = Group(table["text"].to_pylist(), window, bits).candidates(_hits(answers, 1))
        value, count = np.unique(made, return_counts=True)
        return _send(table["g"][0].as_py(), value, np.ones(len(value), bool), count > 1, 64, buckets)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table["text"].to_pylist(), window, bits)
        repeated = np.empty(0, np.int64)
        if len(answers):
            starts, made = group.candidates(_hits(answers, 1))
            if len(starts):
                _, which = np.unique(made, return_inverse=True)
                repeated = starts[_hits(answers, 2)[which]]
        return pa.Table.from_arrays([table["doc_id"].combine_chunks(), *group.result(repeated)],
                                    names=["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    blocks = written(_answers(docs.groupBy("g").applyInArrow(probe, _SENT), 1), "block-hits")
    asked = docs.groupBy("g").cogroup(blocks.groupBy("g")).applyInArrow(widen, _SENT)
    both = written(blocks.unionAll(_answers(asked, 2)), "window-hits")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.groupBy("g").cogroup(both.groupBy("g")).applyInArrow(finish, f"doc_id {kind}, {_RESULT}")
