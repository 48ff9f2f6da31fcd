"""Splits, class totals and class-balanced sampling.

The balance ratio is computed from class totals with a *scalar subquery*
(``DataFrame.scalar()``), so the whole recipe stays one lazy plan: no
``collect()[0][1]`` round trips, and the totals are a two-number aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values from the reference's balancing recipe: keep 20 % of attack
# rows and about two normal rows per kept attack row; split 80/20, seed 0
KEEP_ATTACK = 0.2
NORMAL_PER_ATTACK = 2.0
SPLIT_WEIGHTS = (0.8, 0.2)
SEED = 0

# fixed values of the portable integer hash behind stable splits and samples:
# a prime with p % 3 == 2 (cubing permutes its residues) and, for each
# purpose, a multiplier of the key and one of the seed
_HASH_PRIME = 1000037
_HASH_OF = {"split": (7919, 15485863), "sample": (104729, 32452843)}


def class_order_counts(df: DataFrame, label: str = "attack") -> DataFrame:
    """``groupBy(label).count().orderBy(label)``."""
    return df.groupBy(label).count().orderBy(label)


def class_totals(df: DataFrame, label: str = "attack", normal=0, attack=1) -> DataFrame:
    """Both class totals in one conditional aggregate."""
    return df.agg(
        F.count_if(F.col(label) == F.lit(normal)).alias("n_normal"),
        F.count_if(F.col(label) == F.lit(attack)).alias("n_attack"),
    )


def ratio_expr(n_normal: Column, n_attack: Column, keep: float = KEEP_ATTACK,
               per_attack: float = NORMAL_PER_ATTACK) -> Column:
    """``((n_attack · keep) · per_attack) / n_normal``."""
    return (n_attack.cast("double") * F.lit(keep) * F.lit(per_attack)) / n_normal.cast("double")


def balance_fractions(df: DataFrame, label: str = "attack", keep: float = KEEP_ATTACK,
                      per_attack: float = NORMAL_PER_ATTACK) -> DataFrame:
    """One row: class totals, the raw ratio, and the sampling fractions.

    The normal-class fraction is clamped to 1 (the reference would pass a
    fraction above 1 to ``sampleBy``, which rejects it).
    """
    t = class_totals(df, label)
    raw = ratio_expr(F.col("n_normal"), F.col("n_attack"), keep, per_attack)
    return t.select("n_normal", "n_attack", raw.alias("ratio"),
                    F.least(raw, F.lit(1.0)).alias("fraction_normal"),
                    F.lit(keep).alias("fraction_attack"))


def _checked_fraction(df: DataFrame, label: str, keep: float, per_attack: float) -> Column:
    """Lazy scalar fraction for the normal class; fails clearly if a class is empty."""
    t = class_totals(df, label)
    frac = (
        t.select(
            F.when(F.col("n_attack") == 0, F.raise_error(F.lit("balance: no attack rows")))
            .when(F.col("n_normal") == 0, F.raise_error(F.lit("balance: no normal rows")))
            .otherwise(F.least(ratio_expr(F.col("n_normal"), F.col("n_attack"), keep, per_attack),
                               F.lit(1.0))).cast("double")
        ).scalar()
    )
    return frac


def hash_unit(key, seed: int = SEED, purpose: str = "split") -> Column:
    """A deterministic value in [0, 1) per integer key.

    ``x = (key · a + seed · b + 1) mod p``, then ``x³ mod p / p``: integer
    arithmetic that any SQL engine repeats (``unit_sql``). ``a`` and ``b``
    differ by ``purpose``, so a sample is independent of the split it is drawn
    from; cubing makes seeds independent too. The key is reduced modulo p
    first, so 64-bit keys cannot overflow. The value depends only on the key,
    never on partitioning.
    """
    c = F.col(key) if isinstance(key, str) else key
    a, b = _HASH_OF[purpose]
    p = F.lit(_HASH_PRIME).cast("bigint")
    x = F.pmod(F.pmod(c.cast("bigint"), p) * a + F.lit((seed * b + 1) % _HASH_PRIME), p)
    return F.pmod(F.pmod(x * x, p) * x, p) / F.lit(float(_HASH_PRIME))


def unit_sql(key: str, seed: int = SEED, purpose: str = "split") -> str:
    """``hash_unit`` of a non-negative integer key as portable SQL."""
    a, b = _HASH_OF[purpose]
    p = _HASH_PRIME
    x = f"(({key} % {p}) * {a} + {(seed * b + 1) % p}) % {p}"
    return f"((((({x}) * ({x})) % {p}) * ({x})) % {p} / {float(p)})"


def hash_unit_any(*cols, seed: int = SEED, purpose: str = "split") -> Column:
    """The same for keys of any type (``xxhash64``; Spark-specific values)."""
    return F.pmod(F.xxhash64(F.lit(purpose), F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def key_unit(df: DataFrame, key: str, seed: int = SEED, purpose: str = "split") -> Column:
    """``hash_unit`` for integer key columns, ``hash_unit_any`` otherwise."""
    integral = isinstance(df.schema[key].dataType,
                          (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return hash_unit(key, seed, purpose) if integral else hash_unit_any(F.col(key), seed=seed, purpose=purpose)


def hash_split(df: DataFrame, key: str, train: float = SPLIT_WEIGHTS[0], seed: int = SEED,
               name: str = "split") -> DataFrame:
    """Stable 80/20 split (M1, stable form): adds ``split`` ∈ {train, test}."""
    return df.withColumn(name, F.when(key_unit(df, key, seed) < F.lit(train), F.lit("train"))
                         .otherwise(F.lit("test")))


def random_split(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = SEED) -> list[DataFrame]:
    """``randomSplit`` as in the reference (M1). Depends on partitioning."""
    return df.randomSplit(list(weights), seed)


def balance(df: DataFrame, label: str = "attack", keep: float = KEEP_ATTACK,
            per_attack: float = NORMAL_PER_ATTACK, seed: int = SEED,
            method: str = "bernoulli", key: str | None = None) -> DataFrame:
    """Class-balanced sample (M2, M3): keep ``keep`` of attack rows and
    ``ratio`` of normal rows, where ratio comes from the class totals.

    ``bernoulli`` = ``sampleBy`` semantics (a per-row random draw, as in the
    reference); ``hash`` = deterministic keep/drop by ``hash_unit(key)``.
    Rows whose label is neither class are dropped, like ``sampleBy``.
    """
    frac = _checked_fraction(df, label, keep, per_attack)
    if method == "hash":
        if key is None:
            raise ValueError("hash balance needs a key column")
        u = key_unit(df, key, seed, "sample")
    elif method == "bernoulli":
        u = F.rand(seed)
    else:
        raise ValueError(method)
    lab = F.col(label)
    keep_row = ((lab == 1) & (u < F.lit(keep))) | ((lab == 0) & (u < frac))
    return df.where(keep_row)


def exact_sample(df: DataFrame, k: int, key: str, by: str | None = None, seed: int = SEED) -> DataFrame:
    """Exactly ``k`` rows of each class of ``by`` (all rows of smaller
    classes), or of the whole table (M2, V2, V3).

    Every row has a priority, a hash of its key (``key_unit``), and the ``k``
    lowest of a class are its sample, ties by key. So a sample depends on the
    keys only, samples of parts of the table merge into that of the whole
    (``exact_sample`` of their union), and a smaller sample is part of a
    larger one.

    Priorities are uniform, so the ``k``-th lies near ``k / n``: counts of the
    rows below and within a narrow band around it (a few numbers per class)
    tell which rows are in for certain; only the band, whose size goes with
    the square root of ``k``, is ordered. A band that misses is widened. Rows
    with equal keys are told apart by nothing, so which of them is taken is
    not determined. A null class is a class; null keys come last.
    """
    if k < 0:
        raise ValueError(k)
    group = F.lit(0) if by is None else F.col(by)
    u = F.coalesce(key_unit(df, key, seed, "sample"), F.lit(1.0))
    rows = df.select("*", u.alias("_u"), group.alias("_g"))
    totals = {r["_g"]: r["n"] for r in rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per class
    width = 8.0
    bands: dict = {}
    todo = dict(totals)
    while todo:
        for g, n in todo.items():
            half = width * (k ** 0.5 + 1)
            bands[g] = (max(0.0, (k - half) / n), min(2.0, (k + half) / n) if k + half < n else 2.0)
        band = rows.join(F.broadcast(_bands(df, bands, by)), F.col("_g").eqNullSafe(F.col("_bg")))
        counts = {r["_g"]: r for r in band.groupBy("_g").agg(
            F.count_if(F.col("_u") < F.col("_lo")).alias("below"),
            F.count_if(F.col("_u") < F.col("_hi")).alias("upto")).collect()}
        todo = {g: totals[g] for g, r in counts.items()
                if g in todo and (r["below"] > k or r["upto"] < min(k, totals[g]))}
        width *= 4
    if not totals:
        return df
    need = {g: (lo, hi, k - counts[g]["below"]) for g, (lo, hi) in bands.items()}
    banded = rows.join(F.broadcast(_bands(df, need, by)), F.col("_g").eqNullSafe(F.col("_bg")))
    sure = banded.where(F.col("_u") < F.col("_lo"))
    edge = banded.where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi")))
    best = Window.partitionBy("_g").orderBy("_u", F.asc_nulls_last(key))
    taken = edge.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= F.col("_need")).drop("_r")
    return sure.unionByName(taken).select(*df.columns)


def _bands(df: DataFrame, bands: dict, by: str | None) -> DataFrame:
    """One row per class: its band, and how many of the band's rows are needed."""
    kind = T.IntegerType() if by is None else df.schema[by].dataType
    schema = T.StructType([T.StructField("_bg", kind), T.StructField("_lo", T.DoubleType()),
                           T.StructField("_hi", T.DoubleType()), T.StructField("_need", T.LongType())])
    return df.sparkSession.createDataFrame([(g, b[0], b[1], b[2] if len(b) > 2 else 0) for g, b in bands.items()], schema)


def string_index(df: DataFrame, col: str, name: str | None = None, count_name: str = "n") -> DataFrame:
    """Category → index by descending frequency, ties by value (M4 twin of
    ``StringIndexer(stringOrderType='frequencyDesc')``). One row per value.

    Counting is one partial aggregate; ranking the (distinct-valued) count
    table uses the skew-safe ordinal, so no single task sorts all values.
    """
    from .ordinal import ordinal

    name = name or f"{col}_index"
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    ranked = ordinal(counts, [F.desc(count_name), F.asc(col)], [], name="_rk")
    return ranked.select(col, count_name, (F.col("_rk") - 1).cast(T.DoubleType()).alias(name))
