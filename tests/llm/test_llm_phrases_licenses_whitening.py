"""Operators 11 to 13: licence scan, phrase collocations, whitening."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hosttel.llm import catalog, collocations, licenses, whitening
from test_llm_operators import edge, empty  # noqa: F401  (fixtures)
from test_llm_queries import SF, rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- 11 -----------------------------------------------------------------

def plain_places(text):
    w = WORD.findall(lower(text))
    hits = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w))
            if w[i:i + len(phrase.split())] == phrase.split()]
    return (len(w), len(hits), min(hits)[0] if hits else None, max(hits)[0] if hits else None,
            ",".join(sorted({label for _, label in hits})))


def test_licence_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in rows_of("documents", "doc_id", "text")}
    got = catalog.QUERIES["op11_license_scan"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_places(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_base_places_on_random_texts():
    rng = random.Random(3)
    vocabulary = ["gnu", "General", "public", "license", "apache", "cc", "by", "mit", "MIT License", "é", "nc", "x"]
    for _ in range(3000):
        text = rng.choice([" ", "-", ", ", "\n", "\x00"]).join(rng.choices(vocabulary, k=rng.randrange(30)))
        assert licenses.scan(text)[:5] == plain_places(text), text


@pytest.mark.parametrize("expression, labels, strictness, shown", [
    ("MIT", "mit", 1, "mit"),
    ("MIT OR GPL-3.0-only", "gpl,mit", 1, "mit OR gpl-3.0-only"),
    ("MIT AND GPL-3.0-only", "gpl,mit", 3, "mit AND gpl-3.0-only"),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", "gpl", 2, "gpl-2.0-or-later WITH classpath-exception-2.0"),
    ("MIT OR Apache-2.0 AND GPL-3.0+", "apache,gpl,mit", 1, "mit OR apache-2.0 AND gpl-3.0+"),
    ("(MIT OR Apache-2.0) AND GPL-3.0+", "apache,gpl,mit", 3, "(mit OR apache-2.0) AND gpl-3.0+"),
    ("((LGPL-2.1))", "lgpl", 2, "lgpl-2.1"),
    ("BSD-3-Clause, as is", "bsd", 1, "bsd-3-clause"),
    ("MIT) and more", "mit", 1, "mit"),
    ("MIT is good", "mit", 1, "mit"),
])
def test_expressions(expression, labels, strictness, shown):
    r = licenses.scan(f"// SPDX-License-Identifier: {expression}\nint x;")
    assert (r[5], r[7], r[8]) == (labels, strictness, [shown])
    assert r[1] == 0 and r[6] == pytest.approx(1 - 0.05 ** len(labels.split(",")))


@pytest.mark.parametrize("expression", ["(MIT", "MIT AND", "OR MIT", "Unheard-1.0", "", "()", "MIT OR Unheard",
                                        "MIT WITH (a OR b)", "((((" * 5000, "with with with"])
def test_no_expression(expression):
    assert licenses.scan(f"License: {expression}")[5:9] == ("", 0.0, None, [])


def test_long_expression_is_read_whole():
    r = licenses.scan("license: " + "(" * 20_000 + "mit" + ")" * 20_000 + " or gpl-3.0" * 20_000)
    assert r[5] == "gpl,mit" and r[7] == 1


def test_licence_edge_rows(edge, empty):  # noqa: F811
    got = licenses.license_scan(edge).collect()
    assert len(got) == edge.count() and got[0].asDict().keys() >= {"n", "ids", "shard", "n_words", "labels"}
    by_text = {r.text: (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) for r in got}
    assert by_text[None] == by_text[""] == by_text[" \n\t "] == (0, 0, None, None, "", 0.0)
    assert by_text["x" * 50_000][0] == 1 and by_text["word " * 20_000][0] == 20_000
    assert licenses.license_scan(empty).count() == 0
    clash = edge.select("doc_id", "text", F.lit(1).alias("labels"), F.lit("z").alias("N_WORDS"))
    assert licenses.license_scan(clash).columns == ["doc_id", "text", *licenses.OUTPUT.names]


# --- 12 -----------------------------------------------------------------

def plain_collocations(rows, min_count=30, longest=4, cover=80, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = {}
    for (lang, g), a in f.items():
        if len(g) < 2 or a < min_count:
            continue
        score, _, left, right = min((2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]])
                                    for k in range(1, len(g)))
        out[lang, g] = (a, left, right, n[lang], score)
    inside = {}
    for (lang, g), row in out.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                inside[lang, g[i:i + k]] = max(row[0], inside.get((lang, g[i:i + k]), 0))
    kept = {}
    for lang in n:
        mine = [(g, row) for (x, g), row in out.items() if x == lang and 100 * inside.get((lang, g), 0) < cover * row[0]]
        mine.sort(key=lambda x: (-x[1][4], -x[1][0], " ".join(x[0]).encode()))
        kept |= {(lang, i): (" ".join(g), *row) for i, (g, row) in enumerate(mine[:top], 1)}
    return kept


def found(df):
    return {(r.lang, r["rank"]): (r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def random_rows(seed, size=400):
    rng = random.Random(seed)
    words = ["the", "of", "a", "b", "The", "é", "x1", "\x0b", "new", "york", "new york city hall clerk", "\x00", "-"]
    weights = [8, 7, 5, 4, 3, 2, 2, 1, 2, 2, 3, 1, 1]
    for i in range(size):
        picked = rng.choices(words, weights, k=rng.randrange(60))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", " "]) for w in picked)
        yield (i, rng.choice(["en", "en", "fr", None, "und"]), text if rng.random() > 0.05 else rng.choice([None, ""]))


@pytest.mark.parametrize("seed, min_count, longest, cover, hot", [
    (1, 30, 4, 80, 5000), (2, 5, 4, 80, 20), (3, 3, 3, 50, 5000), (4, 30, 5, 100, 5000), (5, 4, 4, 80, 0)])
def test_collocations_equal_brute_force(spark, seed, min_count, longest, cover, hot):
    rows = list(random_rows(seed))
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    got = collocations.collocations(df, min_count=min_count, longest=longest, cover=cover, top=25, hot_part=hot)
    want = plain_collocations([r[1:] for r in rows], min_count, longest, cover, 25)
    assert found(got) == want and want


def test_chunks_and_reset_do_not_change_counts(spark, monkeypatch):
    """Chunks end between pieces and a full word memory starts anew."""
    rows = list(random_rows(9))
    want = plain_collocations([r[1:] for r in rows])
    text = " ".join(r[2] or "" for r in rows).encode().translate(collocations._TABLE)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 50)
    assert b"\n".join(collocations._chunks(text)) == text
    monkeypatch.setattr(collocations, "KNOWN_WORDS", 5)
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert found(collocations.collocations(df)) == want


def test_unary_paths(spark):
    """A passage of 12 words is one path; a fork ends a path; a ring has none."""
    passage = " ".join(f"p{i}" for i in range(12))
    texts = [passage] * 40 + ["a b c d e"] * 30 + ["a b c d f"] * 30 + ["r s t u v w r s t u v w r s"] * 30
    df = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    runs, _ = collocations.longest_grams(df, 30, 4)
    got = {r.phrase: (r.path_end, r.path_words) for r in collocations.compact(collocations.flow(runs, 30, 4), 4).collect()}
    assert all(got[" ".join(passage.split()[i:i + 4])] == ("p8 p9 p10 p11", 12) for i in range(9))
    assert got["a b c d"] == ("a b c d", 4) and got["b c d e"] == ("b c d e", 4) and got["b c d f"] == ("b c d f", 4)
    assert got["r s t u"] == got["w r s t"] == (None, None)


def test_collocation_edge_rows(spark, edge, empty):  # noqa: F811
    named = edge.withColumn("lang", F.lit(None).cast("string")).withColumn("phrase", F.lit("x"))
    rows = named.collect()
    assert found(collocations.collocations(named)) == plain_collocations([(r.lang, r.text) for r in rows])
    assert collocations.collocations(empty.withColumn("lang", F.lit("en"))).count() == 0


# --- 13 -----------------------------------------------------------------

def plain_whitening(vectors):
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(v, s, strict=True)) for v in x]
    centred = np.array([[c - t / n for c, t in zip(v, s, strict=True)] for v in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred @ axes[:, ::-1] / np.sqrt(values[::-1]), values[::-1] / values.sum()


def test_whitening_equals_numpy(spark):
    rows = {r["vec_id"]: r["embedding"] for r in rows_of("embeddings", "vec_id", "embedding")}
    ids = [i for i, v in rows.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    n, deviation, z, share = plain_whitening([rows[i] for i in ids])
    got = {(r.vec_id, r.component): r for r in catalog.QUERIES["op13_block_whitening"](spark, SF).collect()}
    assert len(got) == 8 * len(ids)
    for k in range(1, 9):
        mine = np.array([got[i, k].whitened for i in ids])
        assert np.abs(np.abs(mine @ z[:, k - 1] / n) - 1) < 1e-9
        assert np.abs(mine * np.sign(mine @ z[:, k - 1]) - z[:, k - 1]).max() < 1e-6
    assert all(r.n == n and r.identity_error < 1e-9 and abs(r.explained / share[r.component - 1] - 1) < 1e-9 for r in got.values())
    assert all(got[i, 1].deviation == d for i, d in zip(ids, deviation, strict=True))


def test_whitening_over_many_blocks(spark, monkeypatch):
    """Small blocks and many splits give the same matrix."""
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(700, 5)) @ rng.normal(size=(5, 5)) + 30).round(4).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(9)
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 60)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 2)
    _, deviation, z, share = plain_whitening(vectors)
    got = whitening.whiten(df, components=5).orderBy("vec_id", "component").collect()
    assert [int(r.deviation) for r in got[::5]] == deviation
    mine = np.array([r.whitened for r in got]).reshape(-1, 5)
    assert np.abs(mine * np.sign((mine * z).sum(0)) - z).max() < 1e-6
    assert np.abs(np.array([r.explained for r in got[:5]]) / share - 1).max() < 1e-9


def test_whitening_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, nan], "a"), (2, None, "b"), (3, [1.0, None, 2.0], "c"), (None, [0.5, 0.25, 1.0], "d"),
            (5, [0.1, 0.7, -1.0], "e"), (5, [0.1, 0.7, -1.0], "e"), (6, [], "f"), (7, [1.0], "g"), (8, [inf, 1.0, 1.0], "h")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string").withColumn("y", F.lit(1))
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in got) == [(0, 1, 3), (5, 1, 3), (5, 1, 3)]
    assert got[0].asDict().keys() == {"vec_id", "embedding", "y", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    for none in (df.where("vec_id = -1"), df.where("vec_id = 5"), df.where("vec_id = 6"), df.where("vec_id = 7")):
        assert whitening.whiten(none).collect() == []
