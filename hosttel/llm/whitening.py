"""Whitening of embeddings with MLlib's distributed block matrices.

Entries are scaled to whole numbers, so sums and deviations are exact. Centred
rows get a gapless index and become a ``BlockMatrix``; its transpose times
itself is the scatter matrix, a d x d table whose eigenvectors are taken on the
driver; the block matrix times the whitening matrix projects all rows.

The product over the long dimension is cut into splits, each its own task, so
no task meets all rows although the result is a single block.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import written
from .text import without

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries of a block (8 MB), columns of a block, and blocks that one task multiplies.
BLOCK_ENTRIES, BLOCK_COLUMNS, BLOCKS_A_TASK = 1 << 20, 1024, 8
#: Eigenvalues below this share of the largest one, times the dimensions, are rounding noise.
NOISE = 1e-13

ADDED = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.DecimalType(38, 0)),
         ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]


def _usable(v: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return v.isNotNull() & F.forall(v, finite)


def _scaled(v: Column) -> Column:
    """floor(1024 c) of each entry; the constant shift is left to the caller."""
    return F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def _longs(values: list[int]) -> Column:
    return F.lit(np.array(values, np.int64))


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, with its inner dimension dealt over ``splits`` tasks per result block."""
    made = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(made, left.rowsPerBlock, right.colsPerBlock)


def _block_matrix(rows: DataFrame, n: int, width: int, per_block: int, columns: int) -> BlockMatrix:
    """(index long, v array<double>) as blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("v")), "v")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(per_block, columns)


def whiten(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row of ``df`` and component: the columns of
    ``df`` with ``component`` (from 1, by falling eigenvalue), ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error`` as the
    module and its query define them. ``deviation`` is the exact sum over
    dimensions of (n x - S)^2.

    Rows whose vector is null or holds null, NaN or infinite entries are left
    out, and so are vectors that are not as long as most are (the longer of
    equally many), as they fit no common matrix. Repeated rows and null ids
    are rows like others. Columns of the added names are replaced. A direction
    without variance has no component, so one row, equal rows, vectors without
    entries and an empty table give no row.
    """
    spark = df.sparkSession
    names = [n for n, _ in ADDED]
    carried = without(df, names)
    out_schema = T.StructType([df.schema[c] for c in carried] + [T.StructField(n, t) for n, t in ADDED])
    own = [df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carried)]
    valid = df.where(_usable(F.col(vector))).select(*own, _scaled(F.col(vector)).alias("y"))
    lengths = valid.groupBy(F.size("y").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None or lengths["d"] == 0:
        return spark.createDataFrame([], out_schema)
    d = lengths["d"]
    kept = written(valid.where(F.size("y") == d).select(
        "*", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row")), "whitening-rows")
    counts = {r["part"]: r["count"] for r in kept.groupBy("part").count().collect()}  # one row a partition
    order = sorted(counts)
    n = sum(counts.values())
    before = np.concatenate([[0], np.cumsum([counts[p] for p in order])])[:-1]
    offsets = spark.createDataFrame([(p, int(b)) for p, b in zip(order, before, strict=True)], "part int, before long")
    indexed = kept.join(F.broadcast(offsets), "part").withColumn("index", F.col("before") + F.col("row"))

    sums = [0] * d
    for pos, total in kept.select(F.posexplode("y").alias("pos", "c")).groupBy("pos").agg(F.sum("c")).collect():
        sums[pos] = total  # d rows
    mean = F.lit(np.array([s / n for s in sums], np.float64))
    centred = indexed.select("index", F.zip_with("y", mean, lambda c, m: c - m).alias("v"))
    columns = min(d, BLOCK_COLUMNS)
    per_block = max(1, BLOCK_ENTRIES // columns)
    x = _block_matrix(centred, n, d, per_block, columns)
    blocks = -(-n // per_block)
    scatter = _times(x.transpose(), x, max(1, -(-blocks // BLOCKS_A_TASK))).toLocalMatrix().toArray()
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values > max(values[0], 0) * NOISE * d).sum()) if values[0] > 0 else 0
    some = min(components, real)
    if not some:
        return spark.createDataFrame([], out_schema)
    weights = vectors[:, :some] / np.sqrt(values[:some])
    w = _block_matrix(spark.createDataFrame([(i, row) for i, row in enumerate(weights.tolist())],
                                            "index long, v array<double>"), d, some, columns, some)
    projected = _times(x, w, 1).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    z = rows.toDF("index", "z").select("index", vector_to_array("z").alias("z"))

    exact = T.DecimalType(38, 0)
    square = F.aggregate("y", F.lit(0).cast("long"), lambda a, c: a + c * c).cast(exact)
    cross = F.aggregate(F.zip_with("y", _longs(sums), lambda c, s: c * s), F.lit(0).cast("long"), lambda a, c: a + c).cast(exact)
    total = sum(s * s for s in sums)
    by_row = indexed.select("index", *[f"c{i}" for i in range(len(carried))], square.alias("square"), cross.alias("cross"))
    whole = written(by_row.join(z, "index"), "whitening")
    pairs = [(i, j) for i in range(some) for j in range(i, some)]
    spread = whole.agg(*[F.covar_pop(F.col("z")[i], F.col("z")[j]).alias(f"v{i}_{j}") for i, j in pairs]).first()
    error = max(abs(spread[f"v{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = (values[:some] / np.trace(scatter / n)).tolist()
    deviation = (F.expr(f"CAST(square * {n}BD * {n}BD AS DECIMAL(38,0))") - F.expr(f"CAST(cross * {2 * n}BD AS DECIMAL(38,0))")
                 + F.lit(str(total)).cast(exact)).cast(exact)
    each = whole.select(*[f"c{i}" for i in range(len(carried))], deviation.alias("deviation"), F.posexplode("z").alias("i", "whitened"))
    made = {"component": (F.col("i") + 1).cast("int"), "n": F.lit(n).cast("long"), "deviation": F.col("deviation"),
            "whitened": F.col("whitened"), "explained": F.get(F.lit(np.array(shares, np.float64)), F.col("i")),
            "identity_error": F.lit(float(error))}
    return each.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *[made[c].alias(c) for c in names])
