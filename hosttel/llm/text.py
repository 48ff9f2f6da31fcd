"""Shared text and batch helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

#: Rows handed to a batch function at once; bounds a task's Python memory.
BATCH_ROWS = 512
#: Bytes that Spark sends to a Python worker at once. Its own default, 64 MB, is a whole split of texts, which
#: executor and worker hold several times over.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
#: Words remembered per Python worker, of about 200 bytes each; the memo is emptied when it is full. Longer words are not remembered.
MEMO_WORDS, MEMO_LENGTH = 32_768, 64

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The frame's columns except ``names`` (compared as Spark does, without case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def bound_batches(spark: SparkSession) -> None:
    """Set ``ARROW_BYTES`` where it is unset; a session's own value wins."""
    if spark.conf.get(ARROW_BYTES[0], None) is None:
        spark.conf.set(*ARROW_BYTES)


def map_columns(df: DataFrame, inputs: Sequence[str], outputs: StructType,
                func: Callable[..., list[pa.Array]], drop: Sequence[str] = (),
                batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Append the columns ``outputs``, which ``func`` computes from Arrow
    arrays of the columns ``inputs``, a few hundred rows at a time.

    Every row comes out exactly once. An input column named like an output is
    replaced by it; the columns ``drop`` are not carried along. An input that
    is carried along goes to the worker once.
    """
    bound_batches(df.sparkSession)
    kept = without(df, [*outputs.names, *drop])
    schema = StructType([df.schema[c] for c in kept] + outputs.fields)
    sent = [*kept, *[c for c in inputs if c not in kept]]
    n_kept, at = len(kept), [sent.index(c) for c in inputs]
    source = df.select(*[df[c] for c in kept], *[df[c].alias(f"__in{i}") for i, c in enumerate(sent[n_kept:])])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        pool.release_unused()  # workers are used again: what earlier tasks' batches took
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                made = func(*[part.column(i) for i in at])
                yield pa.RecordBatch.from_arrays([*part.columns[:n_kept], *made], names=names)
            pool.release_unused()

    return source.mapInArrow(run, schema)


def fields(ddl: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in ddl])


def ascii_words(text: str | None) -> list[bytes]:
    """UTF-8 words: runs of anything but space, tab, newline, vertical tab,
    form feed and carriage return. Null has none."""
    return [] if text is None else text.encode().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= MEMO_LENGTH:
            self[word] = value
        return value


_word_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit depends on every other."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = np.ones((2, 1), np.uint64)


def _powers_to(n: int) -> np.ndarray:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    global _powers
    if _powers.shape[1] < n:
        steps = np.array([[_MULTIPLIER], [np.uint64(pow(int(_MULTIPLIER), -1, 2 ** 64))]], np.uint64)
        full = np.repeat(steps, n, axis=1)
        full[:, 0] = 1
        _powers = np.cumprod(full, axis=1, dtype=np.uint64)
    return _powers


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` consecutive entries: a polynomial
    modulo 2**64, for wide windows from prefix sums."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if width > 6:
        up, down = _powers_to(len(h))
        before = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * down[:len(h)], dtype=np.uint64, out=before[1:])
        return mix((before[width:] - before[:n]) * up[:n])
    total = h[width - 1:].copy()
    for j in range(width - 2, -1, -1):
        total = total * _powers_to(2)[1, 1] + h[j:j + n]
    return mix(total)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's ``width``-word shingles after
    lower-casing A-Z; a shorter text is one shingle; no words: empty."""
    if text is None:
        return np.empty(0, np.uint64)
    h = word_hashes(text.encode().lower().split())
    return np.unique(window_hashes(h, min(width, len(h)))) if len(h) else h


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``width`` from one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + width, n), -1)
    return np.cumsum(edge[:-1]) > 0
