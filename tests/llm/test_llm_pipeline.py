"""The pipeline stage by stage against a plain Python version."""

import sys

import corpus_pipeline as P
import pyarrow as pa
import pytest
import xxhash
from hosttel.llm import near_dup, pii
from hosttel.llm import text as text_module
from hosttel.llm.store import written
from hosttel.llm.text import fields, map_columns
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_llm_operators import plain_base
from test_llm_queries import SF, components, rows_of

DOC = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in P.STAGES:
        docs = written(f(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "tokens"]
    assert all(df.columns == DOC for df in stages[:5])
    assert stages[5].columns == [*DOC, "n_tokens", "ids"]


def test_quality_stage(stages):
    want = set()
    for i, t in texts(stages[0]).items():
        w = t.encode().split()
        grams = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        often = {g for g in grams if grams.count(g) > 1} if len(w) < 3000 else None
        if often is None:
            from collections import Counter
            often = {g for g, n in Counter(grams).items() if n > 1}
        rep = {p for j, g in enumerate(grams) if g in often for p in range(j, j + 3)}
        if len(w) >= 50 and 100 * len(rep) <= 50 * len(w):
            want.add(i)
    assert set(texts(stages[1])) == want  # no host is bad enough here


def test_near_duplicate_stage(stages):
    found = components(texts(stages[1]), 5, 80)
    assert set(texts(stages[2])) == {i for i, (_, c) in found.items() if i == c}


def test_decontamination_stage(stages):
    import re

    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    grams = set()
    for r in rows_of("benchmark", "item_id", "text"):
        w = words(r["text"])
        k = min(10, len(w))
        grams |= {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    sizes = {len(g) for g in grams}
    want = set()
    for i, t in texts(stages[2]).items():
        w = words(t)
        if not any(tuple(w[j:j + k]) in grams for k in sizes for j in range(len(w) - k + 1)):
            want.add(i)
    assert set(texts(stages[3])) == want


def test_personal_data_stage(stages):
    before, after = texts(stages[3]), {r.doc_id: r for r in stages[4].collect()}
    assert set(before) == set(after)
    for i, t in before.items():
        spans = plain_base(t)
        if not pii.further_spans(t, spans):
            assert after[i].text == pii.redact_text(t, spans)
        assert not [s for s in plain_base(after[i].text)] and after[i].n_chars == len(after[i].text)


def test_token_stage_and_run(spark, stages):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows, before = stages[5].collect(), texts(stages[4])
    for r in rows:
        assert r.ids == sp.encode(before[r.doc_id]) and r.n_tokens == len(r.ids) and r.text == sp.decode(r.ids)
    got = {(r.doc_id, r.n_tokens) for r in P.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.n_tokens) for r in rows}


def clean(seed, n=90):
    return " ".join(f"w{seed}x{i}" for i in range(n))


def test_stages_judge_rows_by_themselves(spark):
    """Exact rows of every stage for null and shared ids, empty and very long
    texts, repeated rows, nulls in all columns and clashing extra columns."""
    item = rows_of("benchmark", "item_id", "text")[0]["text"]
    leak, near = f"{clean(1)} {item}", clean(2, 200)
    texts = {
        "null": (1, None), "null id, few words": (None, "a b"), "empty": (2, ""), "shared": (3, clean(3)),
        "shared too": (3, clean(4)), "repeated": (4, clean(5)), "repeated again": (4, clean(5)), "long": (5, clean(6, 20_000)),
        "leak": (6, leak), "null id, leak": (None, f"{clean(7)} {item}"), "id of the leak": (6, clean(8)),
        "near": (9, near), "near copy": (8, near + " end"), "null id, near copy": (None, "start " + near),
        "null id": (None, clean(10)), "null id, its near copy": (None, clean(10) + " end"), "private": (11, clean(11) + " jo@x.org"),
    }
    rows = [(*r, None if "null" in k else "en", None if "null" in k else "s", len(r[1] or "")) for k, r in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "'?' AS ids", "1 AS kept", "2 AS text_hash", "3 AS __text")
    name_of = {}
    for k, r in texts.items():
        name_of.setdefault(r, k)
    left = lambda df: sorted((name_of[r.doc_id, r.text]) for r in df.collect())
    gone = {"quality_rules": {"null", "null id, few words", "empty"},
            "near_duplicates": {"repeated again", "near", "null id, near copy"}, "decontamination": {"leak", "null id, leak"}}
    want = [k if k != "repeated again" else "repeated" for k in texts]
    for name, stage in P.STAGES[:3]:
        docs = written(stage(spark, docs, SF), f"edge-{name}")
        assert docs.columns[:5] == DOC and docs.columns[5:] == ["ids", "kept", "text_hash", "__text"]
        if name == "quality_rules":
            want = [k for k in want if k not in gone[name]]
        elif name == "near_duplicates":
            want.remove("repeated")
            want = [k for k in want if k not in gone[name]]
            kept = [k for k in left(docs) if k.startswith("null id") and "leak" not in k]
            assert len(kept) == 1 and kept[0] in ("null id", "null id, its near copy")  # the smaller hash
            want = [k for k in want if k not in ("null id", "null id, its near copy")] + kept
        else:
            want = [k for k in want if k not in gone[name]]
        assert left(docs) == sorted(want), name
    before = {(r.doc_id, r.text) for r in docs.collect()}
    docs = written(P.personal_data(spark, docs, SF), "edge-personal")
    after = {(r.doc_id, r.text) for r in docs.collect()}
    assert len(after) == len(before) and {r for r in before if "@" not in r[1]} <= after
    assert not [t for _, t in after if "@" in t] and docs.columns[:5] == DOC
    out = P.tokens(spark, docs, SF)
    assert out.columns == [*DOC, "kept", "text_hash", "__text", "n_tokens", "ids"]
    assert {(r.doc_id, r.text) for r in out.collect()} == after and out.where("n_tokens < 90").count() == 0


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[:6] == [*DOC, "kept"] and out.count() == 0, name


def moved_rows(df, *wide):
    """Rows that the plan of a collected ``df`` shuffled with one of the columns ``wide``."""
    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    def names(plan):
        return {plan.output().apply(i).name() for i in range(plan.output().size())}

    return sum(n.metrics().apply("shuffleRecordsWritten").value()
               for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange" and names(n) & set(wide))


def test_only_texts_that_a_verdict_names_are_shuffled(spark):
    item = rows_of("benchmark", "item_id", "text")[0]["text"]
    texts = [clean(i) for i in range(300)] + [f"{clean(i)} end" for i in range(4)] + [f"{clean(9)} {item}"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(20, texts[20], "en", "s", len(texts[20]))]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "-1"), strict=True):  # the plan as it ran, and no table too small to shuffle
            spark.conf.set(k, v)
        docs = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "few")
        once = P.near_duplicates(spark, docs, SF)
        assert sorted(r.doc_id for r in once.collect()) == [*range(300), 304]
        assert 0 < moved_rows(once, "row", "text") < 30
        clear = P.decontamination(spark, docs, SF)
        assert sorted(r.doc_id for r in clear.collect()) == sorted([*range(304), 20])
        assert 0 < moved_rows(clear, "row", "text") < 30
        head = F.struct(F.lit(False).alias("nameless"), "doc_id", F.xxhash64("text").alias("text_hash")).alias("head")
        classes = docs.select((-F.col("doc_id")).alias("node"), head).distinct()
        ids = spark.createDataFrame([(-5,), (-20,), (-301,)], "id long")
        got = near_dup._texts_of(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), classes, ids)
        assert {r.id: r.text for r in got.collect()} == {-i: texts[i] for i in (5, 20, 301)}
        assert 0 < moved_rows(got, "text") < 30
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_batches_for_python_workers_are_bounded_in_bytes(spark):
    key = text_module.ARROW_BYTES[0]
    old = spark.conf.get(key, None)
    docs = spark.range(12_000).repartition(1).selectExpr("id", "repeat(CAST(id % 10 AS STRING), 2000) AS text")
    out = fields([("n", T.LongType())])
    try:
        spark.conf.unset(key)
        made = map_columns(docs, ["text"], out, lambda c: [pa.array([len(c)] * len(c), pa.int64())], batch_rows=10_000)
        got = made.agg(F.max("n").alias("n"), F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars")).first()
        assert (got.rows, got.chars) == (12_000, 24_000_000) and got.n < 4_000  # 8 MB; one batch of 10,000 before
        spark.conf.set(key, "1m")  # a session's own value wins
        map_columns(docs, ["text"], out, lambda c: [pa.array([0] * len(c), pa.int64())])
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def test_an_input_that_is_kept_goes_to_the_worker_once(spark):
    docs = spark.createDataFrame([(1, "ab", "x"), (2, None, "y")], "id long, text string, lang string")
    out = fields([("n", T.LongType()), ("m", T.LongType())])

    def run(*columns):
        return [pa.array([len(x or "") for x in c.to_pylist()], pa.int64()) for c in columns]

    made = map_columns(docs, ["text", "lang"], out, run)
    sent = made._jdf.queryExecution().analyzed().children().apply(0).output()
    assert sent.size() == 3
    assert sorted(map(tuple, made.collect())) == [(1, "ab", "x", 2, 1), (2, None, "y", 0, 1)]
    gone = map_columns(docs, ["lang", "TEXT"], out, run, drop=("text",))
    assert sorted(map(tuple, gone.collect())) == [(1, "x", 1, 2), (2, "y", 1, 0)]


def test_the_memo_of_words_is_bounded():
    words = [b"%d" % i for i in range(120_000)] + [b"w" * 1_000_000, b"1"]
    memo = text_module.WordHashes()
    assert [memo[w] for w in words] == [xxhash.xxh64_intdigest(w) for w in words]
    assert sum(map(sys.getsizeof, memo)) + sys.getsizeof(memo) < 8 << 20
