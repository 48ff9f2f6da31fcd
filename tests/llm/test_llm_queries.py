"""Catalogue queries against SQL or, where there is none, a plain Python version."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from hosttel.llm import catalog, pii, query_url, url_lm

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "pages", "benchmark", "labels"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def rows_of(table, *columns):
    return pq.read_table(f"{SF}/{table}.parquet", columns=list(columns)).to_pylist()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_each_operator_has_a_query():
    numbers = Counter(int(m[1]) for q in E.queries() if (m := re.match(r"op(\d+)_", q)))
    assert set(numbers) == set(range(1, 14)) and "pipeline" in E.queries()
    assert set(catalog.ORACLE) <= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    cur = duck.execute(catalog.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    order = [names.index(c) for c in df.columns]
    want = sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    assert sorted(tuple(map(_norm, r)) for r in df.collect()) == want


def test_op4_rejects_hosts_as_its_sql(spark, tmp_path):
    """Hosts of all kinds, bad ones among them: rates and verdicts equal the SQL's."""
    import random

    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    good = lambda: " ".join(rng.choices(words, k=80))
    bad = {"repeats": lambda: "spam ham eggs " * 30, "symbols": lambda: " ".join(f"{w} #" for w in rng.choices(words, k=60)),
           "dup_lines": lambda: (" ".join(rng.choices(words, k=20)) + "\n") * 5 + good(), "few": lambda: "too short"}
    rows = []
    for h in range(60):
        share, kind = (0.9, rng.choice(list(bad))) if h % 12 == 0 else (rng.random() * 0.2, rng.choice(list(bad)))
        for _ in range(rng.choice([1, 3, 25, 60, 120])):
            rows.append((len(rows), bad[kind]() if rng.random() < share else good(), None if h == 59 else f"host{h}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op4_host_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    cur = con.execute(catalog.ORACLE["op4_host_rules"])
    order = [[d[0] for d in cur.description].index(c) for c in got.columns]
    want = sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
    found = got.collect()
    assert sorted(tuple(map(_norm, r)) for r in found) == want
    assert any(r.host_rejected and not r.base_failed for r in found) and any(r.kept for r in found)
    assert len({r.host_rate for r in found}) > 30


def test_op1_equals_the_library(spark):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for r in rows_of("documents", "doc_id", "text"):
        ids = sp.encode(r["text"] or "")
        want[r["doc_id"]] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    got = catalog.QUERIES["op1_sentencepiece"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_op2_shards(spark):
    got = catalog.QUERIES["op2_communication_matrix"](spark, SF).collect()
    want = {r["doc_id"]: (len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()))
            for r in rows_of("documents", "doc_id", "text")}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == want and len(got) == len(want)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[j]) for j in range(16)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


SPEC = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_base(text):
    out = []
    for kind, pattern in SPEC.items():
        for m in pattern.finditer(text):
            digits = re.sub(r"[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and sum(
                      d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, digits[::-1]))) % 10 == 0,
                  "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_op6_base_and_added_spans(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in rows_of("documents", "doc_id", "text")}
    for r in catalog.QUERIES["op6_weak_supervision"](spark, SF).collect():
        base = plain_base(texts[r.doc_id])
        listed = [":".join(map(str, s)) for s in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        assert set(listed) <= set(filter(None, r.spans.split(",")))


def test_op7_rules_and_verdicts(spark):
    urls = {r["page_id"]: r["url"] for r in rows_of("pages", "page_id", "url")}
    got = catalog.QUERIES["op7_language_model_ratio"](spark, SF).collect()
    assert len(got) == len(urls)
    for r in got:
        url = urls[r.page_id] or ""
        rest = url.split("://", 1)[1] if "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        fits = [x for x in query_url.RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r.host, r.path, r.rule) == (host, path, best.text if best else None)
        assert r.verdict == best.verdict if best else r.verdict in ("allow", "block")


def components(texts, width, limit):
    """Brute force over all pairs that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        k = min(width, len(w))
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= limit * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
        for g in sets[i]:
            holders[g].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_op8_equals_brute_force(spark):
    want = components({r["doc_id"]: r["text"] for r in rows_of("documents", "doc_id", "text")}, 4, 80)
    got = catalog.QUERIES["op8_hyperminhash"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_op5_reads_back(spark, tmp_path):
    from hosttel.llm import query_tokens, token_shards

    folder = f"file://{tmp_path}"
    got = query_tokens.op5_feistel_order(spark, SF, folder=folder).orderBy("slot").collect()
    assert [r.slot for r in got] == list(range(len(got)))
    records = token_shards.read_slots(folder, 0, len(got))
    assert [hashlib.sha256(x.tobytes()).hexdigest() for x in records] == [r.record_sha256 for r in got]
    again = query_tokens.op5_feistel_order(spark, SF, folder=folder).orderBy("slot").collect()  # resumes
    assert again == got


def test_url_models_on_held_out_urls(spark):
    """URLs whose class shows in their spelling are told apart on rows kept out of training."""
    rows = [(i, f"https://site{i % 37}.test/{'news/article' if i % 2 else 'casino/bonus'}-{i}") for i in range(2000)]
    df = spark.createDataFrame([(u, bool(i % 2)) for i, u in rows], "url string, y boolean")
    model = url_lm.train(df.limit(1500), "url", "y")
    held = spark.createDataFrame([(u, bool(i % 2)) for i, u in rows[1500:]], "url string, y boolean")
    got = url_lm.score(held, model).collect()
    assert sum((r.score > 0) == r.y for r in got) / len(got) > 0.98
