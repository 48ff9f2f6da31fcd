"""SentencePiece (merge type) encoding and decoding.

Exact BPE by backtracking: an Aho-Corasick automaton over the vocabulary finds
every piece that starts at each position; the longest is tried first; two
neighbours are accepted only if merging their joint text gives back just these
two; a position from which no piece fits is marked as failed and never entered
again. An encoding whose neighbours all fit is the one that merging yields.

A text is cut where no piece can reach across: before a run of word marks
that follows another character, around line breaks when no piece holds one,
and between a letter or digit and a punctuation mark that none of them precedes
in any piece. Units repeat a lot, so each Python worker remembers some of them; the
memo only saves time.
"""

from __future__ import annotations

import hashlib
import re
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .text import fields, map_columns

MARK = "▁"
#: Rows handed to a Python worker's coder at once.
BATCH_ROWS = 128
#: Bytes that the units remembered per Python worker may take, what one costs besides its text and ids,
#: and the longest that is remembered.
MEMO_BYTES, ENTRY_BYTES, MEMO_CHARS = 64 << 20, 200, 40
#: Pairs of pieces remembered per Python worker, of about 200 bytes each.
MEMO_PAIRS = 150_000


@dataclass(frozen=True)
class PieceModel:
    """What encoding and decoding need of a model file; its size is that of
    the vocabulary."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    normal: tuple[bool, ...]
    byte_of: tuple[int, ...]  # -1: not a byte piece
    control: frozenset[int]
    unknown: int
    key: str


def load_model(path: str) -> PieceModel:
    """Read the vocabulary once, on the driver. Only merge-type models with
    identity normalisation, word marks before words and byte fallback are
    exact here."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = tuple(sp.id_to_piece(i) for i in range(n))
    byte_of = tuple(int(p[3:5], 16) if sp.is_byte(i) else -1 for i, p in enumerate(pieces))
    control = frozenset(i for i in range(n) if sp.is_control(i))
    normal = tuple(not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
                   for i in range(n))
    scores = tuple(sp.get_score(i) for i in range(n))
    key = hashlib.sha256(repr((pieces, scores)).encode()).hexdigest()
    return PieceModel(pieces, scores, normal, byte_of, control, sp.unk_id(), key)


class Decoder:
    """The tables that decoding needs: one entry for each piece."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.surface = [self._surface(i) for i in range(len(model.pieces))]
        self.is_byte = np.array(model.byte_of) >= 0
        self.is_control = np.isin(np.arange(len(model.pieces)), list(model.control))

    def _surface(self, i: int) -> bytes:
        if i in self.model.control:
            return b""
        if self.model.byte_of[i] >= 0:
            return bytes([self.model.byte_of[i]])
        return " ⁇ ".encode() if i == self.model.unknown else self.model.pieces[i].replace(MARK, " ").encode()

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids: the mark that opens the first piece is dropped, runs of byte
        pieces become UTF-8, each byte that is no part of valid UTF-8 becomes U+FFFD."""
        hidden = self.is_control[ids]
        shown = ids[~hidden] if hidden.any() else ids
        if not len(shown):
            return ""
        begin = 1 if self.model.pieces[shown[0]].startswith(MARK) else 0
        if len(shown) == len(ids):  # a control piece parts the bytes on its two sides
            try:
                return b"".join(map(self.surface.__getitem__, ids.tolist()))[begin:].decode()
            except UnicodeDecodeError:
                pass
        return b"".join(self._runs(ids))[begin:].decode()

    def _runs(self, ids: np.ndarray) -> Iterator[bytes]:
        flags = self.is_byte[ids]
        cuts = [0, *(np.flatnonzero(flags[1:] != flags[:-1]) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            run = b"".join(map(self.surface.__getitem__, ids[a:b].tolist()))
            yield _utf8(run).encode() if flags[a] else run


class Encoder(Decoder):
    """Encoder and decoder of one model, kept per Python worker."""

    def __init__(self, model: PieceModel):
        super().__init__(model)
        self.ids = {p: i for i, p in enumerate(model.pieces) if model.normal[i]}
        self.score = {p: model.scores[i] for p, i in self.ids.items()}
        self.byte_ids = [0] * 256
        for i, b in enumerate(model.byte_of):
            if b >= 0:
                self.byte_ids[b] = i
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece holds a word mark after another character")
        before: dict[str, set[str]] = {}
        for p in self.ids:
            for x, y in zip(p, p[1:], strict=False):
                before.setdefault(y, set()).add(x)
        breaks = "" if "\n" in before or any(p[0] == "\n" and len(p) > 1 for p in self.ids) else "\n"
        ends = "".join(y for y in string.punctuation
                       if not any(re.fullmatch(r"[^\W_]", x) for x in before.get(y, ())))
        self.units = re.compile((rf"{MARK}*[^\W_]++(?=[{re.escape(ends)}])|" if ends else "")
                                + f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+" + "|\n" * bool(breaks))
        usual = [y for y in ",." if y in ends]
        #: Where a usual mark follows something else than a letter or digit, or a word mark is in the text.
        self.regular = re.compile(rf"{MARK}|(?:^|[\W_])[{re.escape(''.join(usual)) or MARK}]")
        self.cuts = [(" ", f" {MARK}")] + [("\n", " \n ")] * bool(breaks) + [(y, " " + y) for y in usual]
        self.automaton = ahocorasick.Automaton()
        self.parts: dict[str, tuple[str, str]] = {}  # the two that a piece's last merge joins
        for p in self.ids:
            if len(p) > 1:
                parts = self.merge(p, 2)
                if len(parts) > 2 or "".join(parts) not in self.score or self.merge(p) != [p]:
                    continue  # never the outcome of merging
                self.parts[p] = (parts[0], parts[1])
            self.automaton.add_word(p, (len(p) - 1, p))
        self.automaton.make_automaton()
        #: The next shorter piece that a piece begins with; one character ends the chain.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in self.parts), p[:1])
                        for p in self.parts}
        #: When a piece comes about: single characters first, then by falling score.
        self.rank = {p: -self.score[p] for p in self.parts}
        first = min(self.rank.values(), default=0.0) - 1
        self.first = first
        #: Pieces that do not come about strictly after their parts; these are always re-merged.
        self.odd: set[str] = set()
        for p in sorted(self.parts, key=len):
            if any(x in self.odd or self.rank.get(x, first) >= self.rank[p] for x in self.parts[p]):
                self.odd.add(p)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = _Memo(self)

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Plain merging down to ``stop`` parts: again and again the best-scored
        neighbours, the leftmost among equals. For short texts only."""
        parts, score = list(text), self.score
        while len(parts) > stop:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: str, right: str) -> bool:
        """Would merging ``left + right`` give these two? It would not if, at
        any moment of it, the two parts then at the seam merge. The merges are
        walked backwards: whichever of the two came about last is undone."""
        known = self.pairs.get((left, right))
        if known is not None:
            return known
        if left in self.odd or right in self.odd:
            known = self.merge(left + right) == [left, right]
        else:
            rank, a, b = self.rank, left, right
            # a merge at the seam counts if it comes before ``until``; of two
            # with one rank the left one is first
            until, known = (float("inf"), 0), True
            while True:
                seam = rank.get(a + b)
                if seam is not None and (seam, 1) < until:
                    known = False
                    break
                ra, rb = rank.get(a, self.first), rank.get(b, self.first)
                if ra == rb == self.first:
                    break
                if ra > rb:
                    until, a = (ra, 0), self.parts[a][1]
                else:
                    until, b = (rb, 2), self.parts[b][0]
        if len(self.pairs) >= MEMO_PAIRS:
            self.pairs.clear()
        self.pairs[left, right] = known
        return known

    def split(self, unit: str) -> list[str]:
        """The pieces of one unit by backtracking."""
        n = len(unit)
        longest = list(unit)  # where no piece starts: the character, bytes in the end
        for end, (reach, piece) in self.automaton.iter(unit):
            longest[end - reach] = piece  # ends rise, so the longest comes last
        pairs, shorter = self.pairs, self.shorter
        failed = bytearray(n + 1)
        done: list[str] = []
        last = None
        at, piece = 0, longest[0]
        while True:
            while piece is not None:
                if not failed[at + len(piece)]:
                    if last is None:
                        break
                    fit = pairs.get((last, piece))
                    if fit if fit is not None else self.fits(last, piece):
                        break
                piece = shorter.get(piece)
            if piece is not None:
                done.append(piece)
                at += len(piece)
                if at == n:
                    return done
                last, piece = piece, longest[at]
            else:
                failed[at] = 1
                if not done:
                    raise ValueError("no encoding")
                piece = done.pop()
                at -= len(piece)
                last = done[-1] if done else None
                piece = shorter.get(piece)

    def encode_unit(self, unit: str) -> bytes:
        ids, out = self.ids, array("i")
        for piece in self.split(unit):
            i = ids.get(piece)
            if i is None:
                out.extend([self.byte_ids[b] for b in piece.encode()])
            else:
                out.append(i)
        return out.tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if text[0] == " " or "  " in text or self.regular.search(text):
            units = self.units.findall(MARK + text.replace(" ", MARK))
        else:  # the same cuts (or fewer), by plain replacement
            for mark, put in self.cuts:
                text = text.replace(mark, put)
            units = (MARK + text).split(" ")
        return np.frombuffer(b"".join(map(self.memo.__getitem__, units)), np.int32)


class _Memo(dict):
    """Units seen lately. When half of the room is used, what is there becomes
    the older half, from which only units that are met again are kept."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder, self.room = encoder, MEMO_BYTES // 2
        self.older: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        value = self.older.get(unit)
        if value is None:
            value = self.encoder.encode_unit(unit) if unit else b""
        if len(unit) <= MEMO_CHARS:
            self.room -= ENTRY_BYTES + len(unit) + len(value)
            if self.room < 0:
                self.older, self.room = dict(self), MEMO_BYTES // 2
                self.clear()
            self[unit] = value
        return value


def _utf8(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at:at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_coders: dict[tuple[type, str], Decoder] = {}


def _coder(kind: type, model: PieceModel) -> Decoder:
    """The worker's encoder or decoder; one of a kind, an encoder decodes too."""
    if kind is Decoder and (Encoder, model.key) in _coders:
        kind = Encoder
    if (kind, model.key) not in _coders:
        for other in [k for k in _coders if k[0] is kind]:
            del _coders[other]
        _coders[kind, model.key] = kind(model)
    return _coders[kind, model.key]


def _encoded(coder: Encoder, column: pa.Array) -> list[np.ndarray]:
    return [coder.encode(t) if t else np.empty(0, np.int32) for t in column.to_pylist()]


def _id_lists(made: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
    flat = np.concatenate(made) if made else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(df: DataFrame, model: PieceModel, text: str = "text", ids: str = "ids",
           keep_text: bool = True) -> DataFrame:
    """Append ``ids`` (array<int>), the ids of the whole text, without begin
    or end ids. Null and empty text: an empty array. Repeated rows are encoded
    alike; a column already named ``ids`` is replaced; an empty table stays
    empty."""

    def run(column: pa.Array) -> list[pa.Array]:
        return [_id_lists(_encoded(_coder(Encoder, model), column))]

    return map_columns(df, [text], fields([(ids, T.ArrayType(T.IntegerType()))]), run,
                       drop=() if keep_text else (text,), batch_rows=BATCH_ROWS)


def encode_decode(df: DataFrame, model: PieceModel, text: str = "text", ids: str = "ids",
                  decoded: str = "decoded", keep_text: bool = True) -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that a task needs one Python
    worker: appends ``ids`` and ``decoded``, the text that they decode to.
    With ``decoded`` = ``text`` the text is replaced."""

    def run(column: pa.Array) -> list[pa.Array]:
        coder = _coder(Encoder, model)
        made = _encoded(coder, column)
        return [_id_lists(made), pa.array([coder.decode(x) for x in made], pa.string())]

    return map_columns(df, [text], fields([(ids, T.ArrayType(T.IntegerType())), (decoded, T.StringType())]), run,
                       drop=() if keep_text else (text,), batch_rows=BATCH_ROWS)


def decode(df: DataFrame, model: PieceModel, ids: str = "ids", text: str = "decoded",
           keep_ids: bool = True) -> DataFrame:
    """Append ``text``, the text of the column ``ids``. Null or empty ids:
    empty text. An id outside the vocabulary is an error. A column already
    named ``text`` is replaced."""

    def run(column: pa.Array) -> list[pa.Array]:
        coder = _coder(Decoder, model)
        out = []
        for row in column:
            x = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.empty(0, np.int32)
            out.append(coder.decode(x.astype(np.int64)))
        return [pa.array(out, pa.string())]

    return map_columns(df, [ids], fields([(text, T.StringType())]), run,
                       drop=() if keep_ids else (ids,), batch_rows=BATCH_ROWS)
