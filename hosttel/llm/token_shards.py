"""Training-order token shards.

Documents are tokenised and packed, partition by partition, into sequences of
a fixed length. A first pass counts each partition's sequences, so all of
them are numbered from 0 without gaps; a keyed Feistel permutation with
cycle-walking maps each number to its slot in training order. The order is a
function of the key and the count alone and can be inverted without a table.
Slots are range-partitioned: shard ``i`` holds the slots from
``i * per_shard``, each in a record of fixed stride, so a reader seeks to any
slot and resumes there.

Tokenising twice costs less than keeping the tokens between the passes.
Shards are written whole under another name and then renamed; one that is
already complete is compared and left as it is, so a lost task or a second
call writes little. Every shard is checked to hold each of its records once.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .store import written

ROUNDS = 6
PAD = 0
#: How a pattern takes white space: all but what stands before a word, then the rest.
LOOKING = r"|\s+(?!\S)|\s+"
_TWO_SPACES = re.compile(r"\s\s")
MANIFEST = "manifest.json"
#: Tasks that write shards; with more shards each takes a range of several.
MOST_TASKS = 1 << 16


@dataclass(frozen=True)
class Ranks:
    """A byte-level vocabulary; ``end`` is the id put after each document."""

    raw: bytes
    pattern: str
    end: int


def load_ranks(path: str, pattern: str, end: int) -> Ranks:
    with open(path, "rb") as f:
        return Ranks(f.read(), pattern, end)


_encodings: dict[int, tuple[tiktoken.Encoding, tiktoken.Encoding]] = {}


def _encodings_of(ranks: Ranks) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The vocabulary with its pattern, and with the plain one."""
    key = hash((ranks.raw, ranks.pattern))
    if key not in _encodings:
        _encodings.clear()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.raw.splitlines())}
        if max(*table.values(), ranks.end) > 0xFFFF:
            raise ValueError("ids must fit 16 bits")
        plain = ranks.pattern.removesuffix(LOOKING) + "|\\s+" if ranks.pattern.endswith(LOOKING) else ranks.pattern
        made = [tiktoken.Encoding(name, pat_str=p, mergeable_ranks=table, special_tokens={})
                for name, p in (("ranks", ranks.pattern), ("plain", plain))]
        _encodings[key] = (made[0], made[1])
    return _encodings[key]


def ids_of(text: str, ranks: Ranks) -> array:
    """The ids of a text. Looking ahead behind white space only matters where
    two such characters meet; other texts take the plain pattern, which is faster."""
    exact, plain = _encodings_of(ranks)
    return array("H", (exact if _TWO_SPACES.search(text) else plain).encode_ordinary(text))


def _round_keys(key: str) -> np.ndarray:
    raw = hashlib.sha256(key.encode()).digest() + hashlib.sha256(b"2" + key.encode()).digest()
    return np.frombuffer(raw, np.uint64)[:ROUNDS]


def _mix(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _half_bits(n: int) -> int:
    return max(1, -(-(max(n, 2) - 1).bit_length() // 2))


def _feistel(x: np.ndarray, half: int, keys: np.ndarray, backwards: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> shift, x & mask
    if backwards:
        for k in keys[::-1]:
            left, right = right ^ (_mix(left, k) & mask), left
    else:
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
    return left << shift | right


def permute(x: np.ndarray, n: int, key: str, backwards: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 (its inverse with ``backwards``): a
    Feistel network on the next even number of bits, repeated for values that
    fall outside until they fall inside."""
    keys, half = _round_keys(key), _half_bits(n)
    out = _feistel(x.astype(np.uint64), half, keys, backwards)
    outside = np.flatnonzero(out >= n)
    while len(outside):
        out[outside] = _feistel(out[outside], half, keys, backwards)
        outside = outside[out[outside] >= n]
    return out.astype(np.int64)


def _documents(batches: Iterator[pa.RecordBatch], ranks: Ranks) -> Iterator[tuple[object, bytes]]:
    """(doc_id, ids as bytes, ``end`` last) of each document that has a text."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if text:
                    ids = ids_of(text, ranks)
                    ids.append(ranks.end)
                    yield doc, ids.tobytes()


def packed(batches: Iterator[pa.RecordBatch], ranks: Ranks, length: int) -> Iterator[tuple[list, int, bytes]]:
    """(doc_ids, tokens, record) of each sequence of a stream of (doc_id,
    text) batches: documents one after the other, each followed by ``end``,
    cut every ``length`` ids; the last sequence is padded. Null and empty
    texts give nothing."""
    stride = 2 * length
    parts, owners, have = [], [], 0  # of the sequence that is being filled
    for doc, raw in _documents(batches, ranks):
        at = 0
        while at < len(raw):
            piece = raw[at:at + stride - have]
            at += len(piece)
            parts.append(piece)
            owners.append(doc)
            have += len(piece)
            if have == stride:
                yield owners, length, b"".join(parts)
                parts, owners, have = [], [], 0
    if have:
        yield owners, have // 2, b"".join(parts) + array("H", [PAD]).tobytes() * ((stride - have) // 2)


def shard_name(shard: int) -> str:
    return f"tokens-{shard:06d}.bin"


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, also of the names that Spark's readers know S3 by."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def _claim(fs: pafs.FileSystem, root: str, about: dict) -> None:
    """Say what the folder holds, or fail if it holds something else."""
    name, body = f"{root}/{MANIFEST}", json.dumps(about, sort_keys=True).encode()
    if fs.get_file_info(name).type == pafs.FileType.File:
        with fs.open_input_stream(name) as f:
            there = f.read()
        if there != body:
            raise ValueError(f"{root} holds other shards: {there.decode()} where {body.decode()} is due")
        return
    with fs.open_output_stream(name) as f:
        f.write(body)


class _Shard:
    """One shard being written or, when it is already there, compared."""

    def __init__(self, fs: pafs.FileSystem, root: str, shard: int, due: int, stride: int):
        self.fs, self.shard, self.due, self.stride, self.next = fs, shard, due, stride, 0
        self.name = f"{root}/{shard_name(shard)}"
        info = fs.get_file_info(self.name)
        self.there = info.type == pafs.FileType.File and info.size == due * stride
        self.temporary = f"{root}/_{shard_name(shard)}.{np.random.default_rng().integers(1 << 62)}"
        self.file = fs.open_input_stream(self.name) if self.there else fs.open_output_stream(self.temporary)

    def add(self, row: int, record: pa.Buffer) -> None:
        if row != self.next:
            raise ValueError(f"shard {self.shard}: record {row} where {self.next} is due")
        if not self.there:
            self.file.write(record)
        elif self.file.read(self.stride) != record.to_pybytes():
            raise ValueError(f"shard {self.shard}: record {row} differs from the file's")
        self.next += 1

    def close(self) -> None:
        self.file.close()
        if self.next != self.due:
            raise ValueError(f"shard {self.shard}: {self.next} of {self.due} records")
        if not self.there:
            self.fs.move(self.temporary, self.name)


def write_shards(df: DataFrame, ranks: Ranks, folder: str, key: str, length: int = 1024, per_shard: int = 4096,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all sequences as fixed-stride shards into ``folder`` (a URI that
    every executor reaches) and return their index: (slot, shard, byte_offset,
    n_tokens, doc_ids, record_sha256).

    A record is ``length`` little-endian 16-bit ids; slot ``s`` is record
    ``s % per_shard`` of shard ``s // per_shard``; all shards but the last
    hold ``per_shard`` records. ``doc_ids`` lists the documents in a record,
    in order. Null and empty texts give no ids; repeated rows give theirs
    again; a null doc_id is listed as null; other columns are ignored; an
    empty table writes no shard.

    A manifest names key, sizes, vocabulary and the digest of all ids, so a
    folder never mixes two orders: another manifest there is an error, the
    same one lets complete shards stay, which are compared record by record.

    ``df`` has to yield the same rows in the same order when a partition is
    read again, as files do; the check of the shards fails otherwise.
    """
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, digest = 0, hashlib.sha256()
        for _, raw in _documents(batches, ranks):
            ids += len(raw) // 2
            digest.update(raw)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          pa.array([-(-ids // length)], pa.int64()), pa.array([digest.hexdigest()])],
                                         names=["part", "n", "digest"])

    parts = sorted(docs.mapInArrow(count, "part int, n long, digest string").collect())  # one row a partition
    ends = np.cumsum([r["n"] for r in parts]).tolist()
    first = {r["part"]: e - r["n"] for r, e in zip(parts, ends, strict=True)}
    total = ends[-1] if ends else 0
    stride = 2 * length
    shards = -(-total // per_shard)
    kind = docs.schema["doc_id"].dataType
    ids_type = to_arrow_type(T.ArrayType(kind))
    placed_schema = T.StructType([
        T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType()),
        T.StructField("row", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("record", T.BinaryType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = first.get(TaskContext.get().partitionId(), 0), []

        def batch_of() -> pa.RecordBatch:
            slot = permute(np.arange(number - len(rows), number), total, key)
            return pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(slot // per_shard, pa.int32()), pa.array(slot % per_shard, pa.int32()),
                 pa.array([r[1] for r in rows], pa.int32()), pa.array([r[0] for r in rows], ids_type),
                 pa.array([r[2] for r in rows], pa.binary())], names=placed_schema.names)

        for made in packed(batches, ranks, length):
            rows.append(made)
            number += 1
            if len(rows) == 512:
                yield batch_of()
                rows = []
        if rows:
            yield batch_of()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _folder(folder)
        open_shard: _Shard | None = None
        for batch in batches:
            shard, row = batch.column("shard").to_pylist(), batch.column("row").to_pylist()
            for i, record in enumerate(batch.column("record")):
                if open_shard is None or shard[i] != open_shard.shard:
                    if open_shard is not None:
                        open_shard.close()
                    open_shard = _Shard(fs, root, shard[i], min(per_shard, total - shard[i] * per_shard), stride)
                open_shard.add(row[i], record.as_buffer())
            yield batch.drop_columns(["record"])
        if open_shard is not None:
            open_shard.close()

    fs, root = _folder(folder)
    fs.create_dir(root, recursive=True)
    _claim(fs, root, {"key": key, "length": length, "per_shard": per_shard, "sequences": total, "end": ranks.end,
                      "vocabulary": hashlib.sha256(ranks.raw + ranks.pattern.encode()).hexdigest(),
                      "ids": hashlib.sha256("".join(r["digest"] for r in parts).encode()).hexdigest()})
    # a partition is a range of slots: whole shards, one after the other
    tasks = max(1, min(shards, MOST_TASKS))
    placed = (docs.mapInArrow(place, placed_schema).repartitionById(tasks, F.expr(f"CAST(shard * {tasks}L DIV {max(shards, 1)} AS INT)"))
              .sortWithinPartitions("shard", "row").withColumn("record_sha256", F.sha2("record", 256)))
    names = ["shard", "row", "slot", "n_tokens", "doc_ids", "record_sha256"]
    out = T.StructType([placed.schema[c] for c in names])
    index = written(placed.select(*names, "record").mapInArrow(write, out), "index")
    return index.select("slot", "shard", (F.col("row").cast("long") * stride).alias("byte_offset"),
                        "n_tokens", "doc_ids", "record_sha256")


def read_slots(folder: str, first: int, count: int, length: int = 1024, per_shard: int = 4096) -> np.ndarray:
    """The records of ``count`` slots from ``first`` on, read by seeking: a reader that was
    stopped after a slot goes on with the next."""
    fs, root = _folder(folder)
    out = []
    while count > 0:
        shard, row = divmod(first, per_shard)
        n = min(count, per_shard - row)
        with fs.open_input_file(f"{root}/{shard_name(shard)}") as f:
            out.append(np.frombuffer(f.read_at(n * 2 * length, row * 2 * length), "<u2").reshape(-1, length))
        first, count = first + n, count - n
    return np.concatenate(out) if out else np.empty((0, length), np.uint16)
