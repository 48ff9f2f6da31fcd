"""Personal data by weak supervision.

Fixed patterns find the base spans, which always count. Looser patterns give
further candidates: keys and passwords, social-security numbers, phone numbers
without a country code, account numbers, street addresses and names of
persons. Three labelers vote on every candidate with yes, no or nothing: its
shape, gazetteers and its context; what no labeler votes yes on is no
candidate. Expectation-maximisation estimates from the votes on all documents,
for each kind by itself, how far each labeler can be trusted and how likely
each candidate is; base spans are voted on like all others. A logistic span
classifier is trained on these probabilities and decides on the further
candidates.

What is gathered is one count for each combination of kind, votes and feature
buckets: at most ``len(KINDS) * 27 * 15`` rows, whatever the corpus.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import fields, map_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn", "local_phone", "number", "address", "name")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a run of digits does
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"[A-Za-z0-9_+/-]{20,}")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,5}\)?(?:[\x20.-]{1,2}[0-9]{2,4}){2,4}(?![0-9A-Za-z])")
NUMBER = re.compile(r"[0-9](?:[\x20().-]?[0-9]){8,}")
ADDRESS = re.compile(r"(?<![0-9A-Za-z.,-])[1-9][0-9]{0,4}(?:\x20[A-Z][A-Za-z.'-]{0,20}){1,4}")
NAME = re.compile(r"\b[A-Z][a-z]{1,14}(?:\x20[A-Z]\.)?(?:\x20[A-Z][a-z]{1,14}){1,2}\b")
PHONE_SHAPE = re.compile(r"\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[2-9][0-9]{2}[\x20.-][0-9]{4}|\(?0[0-9]{1,4}\)?(?:[\x20.-][0-9]{2,4}){2,4}")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-.\x20][01][0-9][-.\x20]|[0-3]?[0-9][-.\x20][01]?[0-9][-.\x20](?:19|20)[0-9]{2}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
POSTCODE = re.compile(r"(?:[A-Za-z.\x20-]{0,12},)?[A-Za-z.\x20,-]{0,30}\b[0-9]{5}\b")
WORD = re.compile(r"[a-z]{3,}")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Gazetteers (fixed values).
TOP_DOMAINS = frozenset("com net org edu gov int info biz io de fr es uk eu us ca au jp cn in it nl ch at be".split())
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
RESERVED_OCTETS = frozenset([0, 127, *range(224, 256)])
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
                 "47", "48", "49", "52", "55", "61", "64", "81", "82", "86", "90", "91")
SECRET_CUES = ("token", "key", "secret", "password", "passwd", "pwd", "bearer", "auth", "credential")
DIGEST_CUES = ("commit", "sha", "md5", "digest", "checksum", "hash", "revision", "uuid", "guid", "etag", "http", "blob")
SECRET_PREFIXES = ("sk-", "sk_", "pk_", "ghp_", "gho_", "AKIA", "ASIA", "xoxb-", "xoxp-", "AIza", "eyJ", "glpat-")
PERSON_CUES = ("card", "visa", "account", "phone", "tel", "call", "fax", "mobile", "mail", "contact", "iban", "ssn")
PHONE_CUES = ("phone", "tel", "call", "fax", "mobile", "cell", "contact", "reach", "number")
SSN_CUES = ("ssn", "social security", "soc. sec", "taxpayer", "tax id")
PART_CUES = ("part", "model", "serial", "order", "invoice", "isbn", "version", "item", "case", "ticket")
ADDRESS_CUES = ("address", "live at", "lives at", "live in", "located at", "ship to", "deliver to", "resid", "office at", "home")
NAME_CUES = ("name", "mr", "mr.", "mrs", "mrs.", "ms", "ms.", "dr", "dr.", "prof.", "dear", "patient", "named", "contact", "sincerely,")
FAKE_SSN = ("078-05-1120", "219-09-9999", "123-45-6789", "111-11-1111")
STREETS = frozenset("Street St Avenue Ave Road Rd Lane Ln Drive Dr Boulevard Blvd Court Ct Place Pl Square Way Terrace Parkway "
                    "Highway Close Crescent Alley".split())
GIVEN_NAMES = frozenset("""James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan
Joseph Jessica Thomas Sarah Charles Karen Christopher Lisa Daniel Nancy Matthew Betty Anthony Sandra Mark Margaret Donald Ashley
Steven Kimberly Andrew Emily Paul Donna Joshua Michelle Kenneth Carol Kevin Amanda Brian Melissa George Deborah Timothy Stephanie
Ronald Rebecca Jason Laura Edward Helen Jeffrey Sharon Ryan Cynthia Jacob Kathleen Gary Amy Nicholas Angela Eric Anna Jonathan
Ruth Stephen Brenda Larry Pamela Justin Nicole Scott Katherine Brandon Virginia Benjamin Catherine Samuel Christine Gregory
Samantha Frank Debra Alexander Janet Raymond Maria Patrick Heather Jack Diane Peter Julia Hans Claudia Klaus Sabine Pierre
Isabelle Jean Sophie Luis Carmen Carlos Lucia Jose Elena Wei Yuki Ahmed Fatima Ivan Olga Raj Priya""".split())
NO_NAMES = frozenset("""The This That These Those When Where What Who Why How And But For From With Monday Tuesday Wednesday Thursday
Friday Saturday Sunday January February March April May June July August September October November December North South East
West New Old Street Road Avenue University Institute Company Inc Ltd County City State National International""".split())

#: Rounds of expectation-maximisation and of Newton's method; ridge of the classifier.
EM_ROUNDS, NEWTON_ROUNDS, RIDGE = 100, 25, 0.1
#: What is assumed of a kind before its votes are seen, worth so many candidates: share of true ones, yes votes on true and on false ones.
PRIOR, SHARE, YES = 20.0, 0.3, (0.3, 0.7)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each @."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in _LOCAL:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            done = m.end()
            yield a, done
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(map(str.isdecimal, m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def further_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates, by kind, then start: each overlaps no base span and
    none of an earlier kind, and some labeler votes yes on it."""
    taken: list[tuple[int, int]] = []  # disjoint, in order
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    patterns = [("secret", SECRET), ("ssn", SSN), ("local_phone", LOCAL_PHONE), ("number", NUMBER), ("address", ADDRESS)]
    out = []
    for kind, pattern in [*(patterns if _DIGIT.search(text) else ()), ("name", NAME)]:
        for m in pattern.finditer(text):
            a, b = span_of(kind, m)
            i = bisect_left(taken, (b, 0))
            if (i == 0 or taken[i - 1][1] <= a) and 1 in votes(text, kind, a, b):
                out.append((kind, a, b))
                insort(taken, (a, b))
    return out


def span_of(kind: str, m: re.Match) -> tuple[int, int]:
    """The match, an address only up to its last street word if it has one."""
    a, b = m.span()
    if kind == "address":
        at = a
        for word in m[0].split(" "):
            at += len(word) + 1
            if word.rstrip(".") in STREETS:
                b = at - 1
    return a, b


def _shape_of_secret(span: str, digits: str) -> int:
    """Words and paths are none, digests may be anything, many kinds of characters look drawn."""
    if UUID.fullmatch(span) or not digits or len(digits) == len(span):
        return 0
    if sum(map(len, WORD.findall(span))) * 2 > len(span) and ("-" in span or "/" in span or "_" in span):
        return 0
    if all(c in "0123456789abcdefABCDEF" for c in span):
        return -1
    kinds = any("a" <= c <= "z" for c in span) + any("A" <= c <= "Z" for c in span) + (len(digits) >= 3)
    turns = sum(x.isdecimal() != y.isdecimal() or x.isupper() != y.isupper() for x, y in zip(span, span[1:], strict=False))
    return 1 if kinds == 3 and turns * 4 >= len(span) and len(set(span)) >= 12 else -1


def votes(text: str, kind: str, a: int, b: int) -> tuple[int, int, int]:
    """Votes (1 yes, 0 no, -1 nothing) of shape, gazetteers and context."""
    span = text[a:b]
    digits = "".join(c for c in span if c in "0123456789")
    before = text[max(0, a - 24):a].lower()
    left, right = text[max(0, a - 1):a], text[b:b + 1]

    def cued(cues: tuple[str, ...]) -> bool:
        return any(c in before for c in cues)

    inside = any(c.isalnum() for c in left + right)
    context = 0 if inside else 1 if cued(PERSON_CUES) else -1
    if kind == "email":
        last = span.rpartition(".")[2]
        shape, known = int(last.isalpha() and 2 <= len(last) <= 12), 1 if last.lower() in TOP_DOMAINS else -1
    elif kind == "ip":
        parts = span.split(".")
        shape = int(left != "." and not (right == "." and text[b + 1:b + 2].isdecimal())
                    and not any(len(p) > 1 and p[0] == "0" for p in parts))
        known = 0 if int(parts[0].lstrip("0") or "0") in RESERVED_OCTETS else -1
    elif kind == "card":
        groups = re.split(r"[\x20-]", span)
        shape = int(len(groups) == 1 or all(len(g) == 4 for g in groups[:-1]) and len(set(span) & {" ", "-"}) == 1)
        known = int(digits.startswith(CARD_PREFIXES))
    elif kind == "phone":
        shape, known = int(len(digits) >= 10), 1 if digits.startswith(COUNTRY_CODES) else 0
    elif kind == "secret":
        shape = _shape_of_secret(span, digits)
        known = 1 if span.startswith(SECRET_PREFIXES) else 0 if cued(DIGEST_CUES) else -1
        context = 0 if inside or left in (".", "/") else 1 if cued(SECRET_CUES) and shape else -1
    elif kind == "ssn":
        shape = int(span[:3] not in ("000", "666") and span[0] != "9" and span[4:6] != "00" and span[7:] != "0000")
        known = 0 if span in FAKE_SSN else -1
        context = 1 if cued(SSN_CUES) else 0 if inside or cued(PART_CUES) else -1
    elif kind == "local_phone":
        shape = int(9 <= len(digits) <= 12 and PHONE_SHAPE.fullmatch(span) is not None)
        known = 0 if DATE.match(span) else -1
        context = 0 if cued(PART_CUES) else 1 if cued(PHONE_CUES) and shape else -1
    elif kind == "number":
        shape = int(not inside and 13 <= len(digits) <= 19 and luhn(digits))
        known = int(digits.startswith(CARD_PREFIXES)) if shape else -1
        context = 0 if inside or cued(PART_CUES) else context
    elif kind == "address":
        words = span.split(" ")[1:]
        known = int(len(words) > 1 and words[-1].rstrip(".") in STREETS)
        shape = 1 if known and POSTCODE.match(text[b:b + 60]) else -1
        context = 1 if known and cued(ADDRESS_CUES) else -1
    else:
        words = span.split(" ")
        before_it = text[max(0, a - 2):a]
        shape = 1 if any(w.endswith(".") for w in words) else 0 if before_it.strip() in (".", "!", "?") or not before_it.strip(" ") else -1
        known = 0 if NO_NAMES & set(words) else 1 if words[0] in GIVEN_NAMES else -1
        cue = before.rstrip(" :=").rpartition(" ")[2]
        context = 1 if cue in NAME_CUES else -1
    return shape, known, context


def buckets(text: str, a: int, b: int) -> tuple[int, int]:
    """Length and share of digits of a span, in five and three steps."""
    n = b - a
    share = sum(c in "0123456789" for c in text[a:b]) / n
    return sum(n >= x for x in (12, 16, 20, 36)), (share > 0.25) + (share > 0.75)


def pattern_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """(pattern, n): how often each combination of kind, votes and buckets occurs."""
    schema = "pattern string, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                for t in batch.column(0).slice(start, 512).to_pylist():
                    base = base_spans(t or "")
                    for kind, a, b in base + further_spans(t or "", base):
                        seen["|".join(map(str, (kind, *votes(t, kind, a, b), *buckets(t, a, b))))] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"])

    return (df.select(F.col(text).alias("text")).mapInArrow(run, schema)
            .groupBy("pattern").agg(F.sum("n").alias("n")))


@dataclass(frozen=True)
class Model:
    """Trust in the labelers and the span classifier's weights."""

    trust: tuple  # [kind][labeler]: chances of a yes on false and on true spans, if it votes
    weights: tuple  # of features()

    def chance(self, kind: str, vote: tuple[int, int, int], bucket: tuple[int, int]) -> float:
        return float(1 / (1 + np.exp(-features(kind, vote, bucket) @ np.array(self.weights))))


def features(kind: str, vote, bucket) -> np.ndarray:
    """The kind, each vote for each kind, and the buckets."""
    k = KINDS.index(kind)
    x = np.zeros(len(KINDS) * 10 + 5 + 3)
    x[k] = 1
    for j, v in enumerate(vote):
        x[len(KINDS) + 9 * k + 3 * j + v + 1] = 1
    x[len(KINDS) * 10 + bucket[0]] = 1
    x[len(KINDS) * 10 + 5 + bucket[1]] = 1
    return x


def estimate(vote: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each vote pattern (-1, 0 or 1 by labeler; ``n`` times) to be
    true, and [labeler][false, true] chances of a yes, for one kind.

    A labeler that says nothing says nothing about the span either. Each is
    taken to be no worse than a coin on true and on false spans, which keeps
    the two sides from changing places."""
    yes_rate = np.array([YES] * 3)
    share, spoke, said = SHARE, vote >= 0, vote == 1
    true = np.full(len(n), SHARE)
    for _ in range(EM_ROUNDS):
        odds = np.full(len(n), np.log(share) - np.log(1 - share))
        for j in range(3):
            low, high = yes_rate[j]
            odds += np.where(spoke[:, j], np.where(said[:, j], np.log(high / low), np.log((1 - high) / (1 - low))), 0.0)
        true = 1 / (1 + np.exp(-odds))
        share = (n @ true + PRIOR * SHARE) / (n.sum() + PRIOR)
        for j in range(3):
            for side, weight in enumerate((n * (1 - true), n * true)):
                rate = (weight @ said[:, j] + PRIOR * YES[side]) / (weight @ spoke[:, j] + PRIOR)
                yes_rate[j, side] = np.clip(rate, *((0.01, 0.5), (0.5, 0.99))[side])
    return true, yes_rate


def fit_counts(counts: dict[str, int]) -> Model | None:
    """Expectation-maximisation over vote patterns, kind by kind, then one
    classifier of all kinds. Without any candidate there is no model."""
    if not counts:
        return None
    keys = sorted(counts)
    parsed = [(k.split("|")[0], tuple(map(int, k.split("|")[1:4])), tuple(map(int, k.split("|")[4:]))) for k in keys]
    n = np.array([counts[k] for k in keys], float)
    kind = np.array([KINDS.index(p[0]) for p in parsed])
    vote = np.array([p[1] for p in parsed])
    yes = np.zeros(len(keys))
    trust = []
    for k in range(len(KINDS)):
        own = kind == k
        yes[own], rates = estimate(vote[own], n[own])
        trust.append(tuple(map(tuple, rates.tolist())))
    x = np.array([features(*p) for p in parsed])
    w = np.zeros(x.shape[1])
    for _ in range(NEWTON_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (yes - p)) - RIDGE * w
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w = w + np.linalg.solve(bend, slope)
    return Model(tuple(trust), tuple(w.tolist()))


def fit(df: DataFrame, text: str = "text") -> Model | None:
    """Fit on all documents; only the bounded pattern counts reach the driver."""
    return fit_counts({r["pattern"]: r["n"] for r in pattern_counts(df, text).collect()})


def all_spans(text: str, model: Model | None, least: float = 0.5):
    base = base_spans(text)
    more = [] if model is None else [
        (k, a, b) for k, a, b in further_spans(text, base)
        if model.chance(k, votes(text, k, a, b), buckets(text, a, b)) > least]
    return base, base + more


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                 T.StructField("end", T.IntegerType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _column(rows: list[list[tuple[str, int, int]]]) -> pa.Array:
    return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in row] for row in rows], _ARROW_SPAN)


def detect(df: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Append ``base`` and ``spans``, arrays of (kind, start, end) in code
    points, end exclusive, by kind and start: the fixed patterns' spans, and
    these with the accepted candidates. Null and empty texts have none.
    Repeated rows are judged alike; columns of these names are replaced; an
    empty table stays empty; without a model nothing is added to the base."""

    def run(column: pa.Array) -> list[pa.Array]:
        made = [all_spans(t, model) if t else ([], []) for t in column.to_pylist()]
        return [_column([m[0] for m in made]), _column([m[1] for m in made])]

    return map_columns(df, [text], fields([("base", SPAN), ("spans", SPAN)]), run,
                       drop=() if keep_text else (text,))


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Replace spans by <KIND>; of overlapping ones the text that any covers goes."""
    out, at = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Replace the personal data in ``text``; null stays null; rows, other
    columns and their order stay."""

    def run(column: pa.Array) -> list[pa.Array]:
        return [pa.array([redact_text(t, all_spans(t, model)[1]) if t else t for t in column.to_pylist()],
                         pa.string())]

    return map_columns(df, [text], fields([(text, T.StringType())]), run).select(*df.columns)
