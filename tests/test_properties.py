"""Size texts and brackets: literal cases and properties."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hosttel.functions import size_to_double, size_to_long, strip_brackets

# text → (as double, as bigint)
SIZES = [
    ("12", 12.0, 12), ("3K", 3000.0, 3000), ("2M", 2000000.0, 2000000), ("4G", 4000000000.0, 4000000000),
    ("K", 0.0, 0), (" 7 8", 78.0, 78), ("1.5K", 1.5, None), ("5k", None, None), ("", None, None),
    (None, None, None), ("9999999999G", 9.999999999e18, None), ("1KM", 1e9, 1000000000),
]
BRACKETS = [("<<a>b>>", "a>b"), (">x<", ">x<"), (None, None), ("<>", ""), ("a", "a"), ("< a >", " a ")]


def test_size_cases(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _, _) in enumerate(SIZES)], "i int, s string")
    got = df.select("i", size_to_double("s").alias("d"), size_to_long("s").alias("l")).orderBy("i").collect()
    assert [(r.d, r.l) for r in got] == [(d, n) for _, d, n in SIZES]


def test_bracket_cases(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(BRACKETS)], "i int, s string")
    got = df.select("i", strip_brackets("s").alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [t for _, t in BRACKETS]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(0, 10 ** 8), min_size=30, max_size=80))
def test_whole_numbers_and_their_units(spark, numbers):
    """Digits parse to themselves; a unit multiplies a whole number; spaces do not count."""
    rows = [(n, str(n), f"{n}K", f"{n}M", f"{n}G", f" {n} K ") for n in numbers]
    df = spark.createDataFrame(rows, "n long, plain string, k string, m string, g string, spaced string")
    for r in df.select("n", *[size_to_long(c).alias(c) for c in ("plain", "k", "m", "g", "spaced")]).collect():
        assert (r.plain, r.k, r.m, r.g, r.spaced) == (r.n, r.n * 10 ** 3, r.n * 10 ** 6, r.n * 10 ** 9, r.n * 10 ** 3)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="ab<> ", max_size=8), min_size=30, max_size=80))
def test_stripped_text_is_inside_and_bare(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for r in df.select("s", strip_brackets("s").alias("t")).collect():
        assert r.t in r.s and not r.t.startswith("<") and not r.t.endswith(">")
        removed = len(r.s) - len(r.t)
        assert removed <= r.s.count("<") + r.s.count(">")


@pytest.mark.parametrize("text", ["x", "1,5K", "--1", "K K x"])
def test_unreadable_sizes_are_null(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(size_to_double("s"), size_to_long("s")).first() == (None, None)
