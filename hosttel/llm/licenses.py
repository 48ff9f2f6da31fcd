"""Licence scan of texts.

One Aho-Corasick automaton finds notice phrases in the normalised words of a
text; another finds identifier tags in the raw text. What follows a tag is read
as a licence expression: a shunting-yard parser with ``or`` < ``and`` < ``with``
puts it in postfix order, which is then evaluated. A choice (``or``) is as
strict as its mildest side, a combination (``and``) as its strictest, an
exception (``with``) takes one step off; the strictest of a text's
expressions and notices is its own.

All work is per row, in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .text import fields, map_columns

# fixed values: phrases in words, with the label each stands for
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOTICES = {
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl", "mozilla public license": "mpl", "eclipse public license": "epl",
    "boost software license": "bsl", "artistic license": "artistic", "bsd license": "bsd", "zlib license": "zlib",
    "redistribution and use in source and binary forms": "bsd", "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd",
    "cc0": "cc0", "all rights reserved": "proprietary",
}
#: Marks that a licence expression follows, in lower case.
TAGS = ("spdx-license-identifier:", "license-expression:", "license:", "licence:")
#: How strict a licence is: 0 none, 1 notice, 2 share changes, 3 share the whole, 4 restricted use.
STRICTNESS = {
    "cc0": 0, "unlicense": 0, "0bsd": 0, "mit": 1, "apache": 1, "bsd": 1, "isc": 1, "zlib": 1, "bsl": 1, "cc-by": 1,
    "artistic": 2, "mpl": 2, "epl": 2, "lgpl": 2, "cc-by-sa": 3, "gpl": 3, "agpl": 3,
    "cc-by-nc": 4, "cc-by-nd": 4, "proprietary": 4,
}
#: What one kind of evidence is worth on its own; kinds are joined as independent ones.
WEIGHT = {"tag": 0.95, "base": 0.6, "notice": 0.5}
RANK = {"or": 1, "and": 2, "with": 3}

# fixed values: A-Z in lower case, and the characters that part words
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 48 or 58 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))
_TOKEN = re.compile(r"[ \t]*(?:([()])|([a-z0-9][a-z0-9.+-]*))")
_VERSION = re.compile(r"^([a-z0-9-]*[a-z])-(?:v?\d[\d.]*)(?:-clause)?(?:-only|-or-later)?\+?$")


def family(identifier: str) -> str | None:
    """The label of a licence identifier such as ``apache-2.0``; null when it is unknown."""
    if identifier in STRICTNESS:
        return identifier
    m = _VERSION.match(identifier)
    name = m[1] if m else identifier.rstrip("+")
    # variants that say more after the name, as bsd-3-clause-clear or cc-by-nc-sa
    while name not in STRICTNESS and "-" in name:
        name = name.rpartition("-")[0]
    return name if name in STRICTNESS else None


def postfix(text: str, at: int = 0) -> list[str] | None:
    """The licence expression that begins at ``at``, in postfix order, by the
    shunting-yard method; it ends where the line ends or nothing fits. Null
    when there is none or its brackets do not match."""
    out: list[str] = []
    wait: list[str] = []  # operators and open brackets
    operand_due = True
    while m := _TOKEN.match(text, at):
        bracket, word = m[1], m[2]
        if word is not None and len(word) > 1:
            word = word.rstrip(".")
        if operand_due:
            if bracket == ")" or word in RANK:
                break
            if bracket:
                wait.append("(")
            else:
                out.append(word)
                operand_due = False
        elif bracket == ")":
            while wait and wait[-1] != "(":
                out.append(wait.pop())
            if not wait:
                break  # belongs to the text around
            wait.pop()
        elif word in RANK:
            while wait and wait[-1] != "(" and RANK[wait[-1]] >= RANK[word]:
                out.append(wait.pop())
            wait.append(word)
            operand_due = True
        else:
            break  # a word after an operand is no part of it
        at = m.end()
    if operand_due or "(" in wait:
        return None
    return out + wait[::-1]


def evaluate(tokens: list[str]) -> tuple[int, set[str], str] | None:
    """(strictness, labels, canonical text) of an expression in postfix order;
    null when an identifier is unknown."""
    stack: list[tuple[int, set[str], str, int]] = []
    for i, token in enumerate(tokens):
        if token in RANK:
            right, left = stack.pop(), stack.pop()
            rank = RANK[token]
            shown = " ".join([left[2] if left[3] >= rank else f"({left[2]})", token.upper(),
                              right[2] if right[3] > rank else f"({right[2]})"])
            if token == "with":
                if not left[1] or right[3] < 4:
                    return None
                stack.append((max(left[0] - 1, 0), left[1], shown, rank))
            elif not left[1] or not right[1]:
                return None
            else:
                pick = min if token == "or" else max
                stack.append((pick(left[0], right[0]), left[1] | right[1], shown, rank))
        else:
            label = family(token)  # an exception's name has none
            stack.append((STRICTNESS.get(label, 0), {label} if label else set(), token, 4))
    (strictness, labels, shown, _), = stack
    return (strictness, labels, shown) if labels else None


def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for kind, table in (("base", BASE), ("notice", NOTICES)):
        for phrase, label in table.items():
            phrases.add_word(f" {phrase} ", (len(phrase.split()), kind, label))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


_made: list = []


def scan(text: str | None) -> tuple:
    """The values of ``OUTPUT`` for one text."""
    if not _made:
        _made.extend(_automata())
    phrases, tags = _made
    raw = (text or "").encode()
    words = raw.translate(_WORDS).split()
    # bytes as characters: the phrases are ASCII, and positions need no UTF-8
    joined = f" {b' '.join(words).decode('latin-1')} "
    notices, seen, at = [], 0, 0
    for end, (size, kind, label) in phrases.iter(joined):
        seen, at = seen + joined.count(" ", at, end), end
        notices.append((seen - size, kind, label))
    base = [(w, label) for w, kind, label in notices if kind == "base"]
    evidence = {(kind, label) for _, kind, label in notices}
    strictness = max((STRICTNESS[label] for _, _, label in notices), default=None)
    expressions = []
    low = raw.translate(_LOWER).decode("latin-1")
    if ":" in low:
        for end, _ in tags.iter(low):
            tokens = postfix(low, end + 1)
            found = evaluate(tokens) if tokens else None
            if found:
                evidence |= {("tag", label) for label in found[1]}
                expressions.append(found[2])
                strictness = found[0] if strictness is None else max(strictness, found[0])
    none = 1.0
    for kind, label in sorted(evidence):
        none *= 1.0 - WEIGHT[kind]
    return (len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
            ",".join(sorted({label for _, label in base})), ",".join(sorted({label for _, label in evidence})),
            1.0 - none, strictness, sorted(set(expressions)),
            [{"word": w, "label": label} for w, _, label in sorted(set(notices))])


_LONG, _TEXT = T.LongType(), T.StringType()
OUTPUT = fields([
    ("n_words", _LONG), ("n_base", _LONG), ("first_word", _LONG), ("last_word", _LONG), ("base_labels", _TEXT),
    ("labels", _TEXT), ("score", T.DoubleType()), ("strictness", T.IntegerType()),
    ("expressions", T.ArrayType(_TEXT)), ("notices", T.ArrayType(fields([("word", _LONG), ("label", _TEXT)])))])
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int32(),
          pa.list_(pa.string()), pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))]


def license_scan(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Append what the whole text says of its licence.

    ``n_base`` places of the base phrases, the first and last word of these
    (null without one), their labels, all labels, a score from 0 to 1, the
    ``strictness`` of the strictest notice or expression (null without one),
    the distinct ``expressions`` after tags, and all ``notices`` with the word
    they begin at. Null and empty texts have no words and no labels, and score
    0. Every row is scanned by itself, repeated rows alike; columns of the
    added names are replaced; an empty table stays empty.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        rows = [scan(t) for t in column.to_pylist()]
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_ARROW)]

    return map_columns(df, [text], OUTPUT, run, drop=() if keep_text else (text,), batch_rows=128)
