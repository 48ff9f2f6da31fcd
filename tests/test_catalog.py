"""Every catalogue query against its DuckDB oracle (small scale), and the
driver contract."""

import hashlib
import math
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from hosttel.plans import catalog

from conftest import ROOT, SF_SMALL

SQL = catalog.ORACLE
TABLES = ["events", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows))
                          .encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_is_known():
    # trees of depth five have no SQL; tests/test_models.py compares their metrics with Spark's evaluators
    assert set(catalog.QUERIES) - set(SQL) == {"model_metrics", "model_metrics_memory"} and len(SQL) >= 70
    assert set(SQL) <= set(E.oracle_sql()) and set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["type", "total_attacks"] and len(rows) > 0


@pytest.mark.parametrize("missing", ["corpus_pipeline", "hosttel.llm", "tiktoken", "ahocorasick", "sentencepiece",
                                     "xxhash", "public_tokenizers"])
def test_entry_without_an_optional_module(missing):
    """Whatever the training-data part lacks, the telemetry queries are there."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(catalog.QUERIES)), str(len(SQL))]
