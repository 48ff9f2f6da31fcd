"""Quality rules judged by host.

Each document gets counts and rule failures. The failures are added up by
host; a host's failure rates are shrunk towards the other hosts' with an
empirical beta prior in two parts of one mean: usual hosts, whose spread gives
the prior's strength, and odd hosts, for whom the prior weighs next to
nothing. Mean, strength and the share of odd hosts are estimated by a few
rounds of expectation-maximisation over the rates of all hosts with enough
documents, each host counting once (method of moments, sampling variance taken
off). Hosts whose shrunk rate of any rule passes ``host_limit`` are rejected,
and rate and verdict are joined back to the documents.

However large and alike the usual hosts are, a host that is unlike them is odd
and judged by its own documents.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written
from .text import covered, fields, map_columns, window_hashes, without, word_hashes

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SYMBOLS = "#*$%&|<>"
#: Rules on one document: too few words, too much repetition, many symbols, many repeated lines.
RULES = {
    "few_words": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE_FAILED = f"{RULES['few_words']} OR {RULES['repeats']}"
HOST_LIMIT = 0.5
#: Documents that are enough to know a host's rates; fewer do not shape the prior.
ENOUGH = 20
#: Strength of the prior for odd hosts, in documents, and the most it can be for usual ones.
WEAKEST, STRONGEST = 2.0, 10_000.0
#: Bounds of the prior's mean, and rounds of expectation-maximisation.
LOWEST, HIGHEST, EM_ROUNDS = 0.0001, 0.9999, 3
#: Host tables up to this many rows are broadcast; larger ones are joined over salted keys.
BROADCAST_HOSTS, SALTS = 100_000, 64

_SPACE = b" \t\r\x0b\x0c"


def counts_of(texts: list[str | None]) -> dict[str, list[int]]:
    """The counts of each text; null counts as empty."""
    out: dict[str, list[int]] = {c: [] for c in COUNTS}
    for text in texts:
        text = text or ""
        raw = text.encode()
        words = raw.split()
        lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
        n = len(words)
        grams = window_hashes(word_hashes(words), 3)
        repeated = 0
        if n > 3:
            _, which, often = np.unique(grams, return_inverse=True, return_counts=True)
            starts = np.flatnonzero(often[which] > 1)
            if len(starts):
                repeated = int(covered(starts, 3, n).sum())
        made = (n, len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")), sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)), repeated, len(lines))
        for c, v in zip(COUNTS, made, strict=True):
            out[c].append(v)
    return out


def signals(df: DataFrame, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Append the counts (long) of the whole text. Null and empty text: zeros.
    Columns of these names are replaced."""

    def run(column: pa.Array) -> list[pa.Array]:
        made = counts_of(column.to_pylist())
        return [pa.array(made[c], pa.int64()) for c in COUNTS]

    return map_columns(df, [text], fields([(c, T.LongType()) for c in COUNTS]), run, drop=drop)


def _log_beta(a: float, b: float) -> float:
    return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)


def usual_chance(docs: int, fails: int, mean: float, strength: float, odd: float) -> float:
    """The chance that a host with these counts is a usual one: beta-binomial
    likelihoods of the two parts of the prior."""
    log = [_log_beta(fails + mean * s, docs - fails + (1 - mean) * s) - _log_beta(mean * s, (1 - mean) * s)
           for s in (strength, WEAKEST)]
    return 1 / (1 + odd / (1 - odd) * math.exp(min(log[1] - log[0], 700.0)))


def _with_chances(by_host: DataFrame, priors: dict[str, tuple[float, float, float]]) -> DataFrame:
    """``by_host`` with ``u_<rule>``, the chance of being usual under the prior (mean, strength, share of odd hosts)."""

    def run(docs: pa.Array, *fails: pa.Array) -> list[pa.Array]:
        n = docs.to_pylist()
        return [pa.array([usual_chance(d, f, *priors[r]) for d, f in zip(n, x.to_pylist(), strict=True)], pa.float64())
                for r, x in zip(RULES, fails, strict=True)]

    return map_columns(by_host, ["docs", *[f"f_{r}" for r in RULES]], fields([(f"u_{r}", T.DoubleType()) for r in RULES]), run)


def _moments(weighted: DataFrame) -> dict[str, tuple[float, float, float]]:
    """The prior of each rule from hosts with enough documents, weighted by ``u_<rule>``: a few numbers."""
    known = weighted.where(F.col("docs") >= ENOUGH)
    rate = lambda r: F.col(f"f_{r}") / F.col("docs")
    t = known.agg(F.count("*").alias("hosts"), *[c for r in RULES for c in (
        F.sum(f"u_{r}").alias(f"w_{r}"), F.sum(F.col(f"u_{r}") * rate(r)).alias(f"m_{r}"),
        F.sum(F.col(f"u_{r}") * rate(r) * rate(r)).alias(f"q_{r}"),
        F.sum(F.col(f"u_{r}") / F.col("docs")).alias(f"e_{r}"), F.avg(rate(r)).alias(f"all_{r}"))]).first()
    out = {}
    for r in RULES:
        hosts, weight = t["hosts"], t[f"w_{r}"] or 0.0
        mean, strength = t[f"all_{r}"] or 0.0, WEAKEST
        if weight > 0.5:
            mean = t[f"m_{r}"] / weight
            noise, single = t[f"e_{r}"] / weight, mean * (1 - mean)  # single: the variance of one document's failure
            alike = (max(t[f"q_{r}"] / weight - mean * mean, 0.0) / single - noise) / (1 - noise) if single > 0 else 0.0
            strength = min(max((1 - alike) / alike, WEAKEST), STRONGEST) if alike > 0 else STRONGEST
        odd = (hosts - weight + 1) / (hosts + 2)
        out[r] = (min(max(mean, LOWEST), HIGHEST), strength, odd)
    return out


def host_verdicts(judged: DataFrame, host: str, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, docs, rate_<rule>..., usual_<rule>..., worst, rejected) for a
    table with the counts of ``signals``: shrunk failure rates, the chances of
    being a usual host, the highest rate and whether it passes the limit. Rows
    without a host are one host of their own (null)."""
    fails = {r: F.sum(F.expr(f"CAST({rule} AS BIGINT)")).alias(f"f_{r}") for r, rule in RULES.items()}
    by_host = written(judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("docs"), *fails.values()),
                      "hosts")
    # at first, hosts beyond the limit are taken as odd
    weighted = by_host.withColumns({f"u_{r}": F.when(F.col(f"f_{r}") > host_limit * F.col("docs"), 0.0).otherwise(1.0) for r in RULES})
    for _ in range(EM_ROUNDS):
        priors = _moments(weighted)
        weighted = _with_chances(by_host, priors)
    rates = {}
    for r, (mean, strength, _) in priors.items():
        u, f, n = F.col(f"u_{r}"), F.col(f"f_{r}"), F.col("docs")
        rates[r] = u * (f + mean * strength) / (n + strength) + (1 - u) * (f + mean * WEAKEST) / (n + WEAKEST)
    worst = F.greatest(*rates.values())
    return weighted.select("host", "docs", *[c.alias(f"rate_{r}") for r, c in rates.items()],
                           *[F.col(f"u_{r}").alias(f"usual_{r}") for r in RULES],
                           worst.alias("worst"), (worst > host_limit).alias("rejected"))


def judge(df: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT,
          broadcast_hosts: int = BROADCAST_HOSTS, keep_text: bool = True) -> DataFrame:
    """Append the counts, ``base_failed``, ``host_rate`` (the highest shrunk
    failure rate of its host), ``host_rejected`` and ``kept``.

    A document is kept unless it fails a base rule (too few words, or more
    than half of them in repeated windows) or its host is rejected. Null and
    empty texts have no words and fail. A null host is a host like any other.
    Every row is judged by itself, repeated rows alike; columns of the added
    names are replaced; an empty table stays empty.
    """
    only = df.select(F.col(host).alias("__host"), F.col(text).alias("__text"))
    hosts = host_verdicts(signals(only, "__text", drop=("__text",)), "__host", host_limit)
    hosts = written(hosts.select(F.col("host").alias("__judged"), F.col("worst").alias("__rate"), F.col("rejected").alias("__bad")),
                    "host-verdicts")
    own = df.withColumns({"__host": F.col(host), "__row_salt": F.expr(f"CAST(pmod(xxhash64(`{text}`), {SALTS}) AS INT)")})
    made = signals(own, text, drop=() if keep_text else (text,))
    if hosts.limit(broadcast_hosts + 1).count() <= broadcast_hosts:
        joined = made.join(F.broadcast(hosts), F.expr("__host <=> __judged"))
    else:  # a hot host is spread over salts
        salted = hosts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = made.join(salted, F.expr("__host <=> __judged AND __row_salt = __salt"))
    names = without(made, ["base_failed", "host_rate", "host_rejected", "kept", "__host", "__row_salt"])
    return joined.select(*[F.col(f"`{c}`") for c in names],
                         F.expr(BASE_FAILED).alias("base_failed"), F.col("__rate").alias("host_rate"),
                         F.col("__bad").alias("host_rejected"), (~F.expr(BASE_FAILED) & ~F.col("__bad")).alias("kept"))
