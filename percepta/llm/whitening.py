"""Whitening of embeddings with distributed block matrices.

Vectors become integers, ``floor(SCALE * entry)``, so that sums are exact and
equal vectors are equal; the statistics are those of the distinct vectors. The
centred distinct vectors are the rows of a ``BlockMatrix``; its transpose times
itself is the scatter matrix, whose eigenvectors (numpy ``eigh``, on the driver)
give the whitening matrix; the block matrix times that projects the rows.

Scale: the driver sees sums, matrices of dimension x dimension (at most
``MAX_DIMENSION``) and the coordinates of the blocks of one stripe. A stripe is
``STRIPE_BLOCKS`` blocks of rows; each has its own block matrix, and the
scatters of the stripes are added, so neither the coordinates nor the rows of
one task grow with the table. Copies of a vector, however many, are one row of
the matrix, and join the projected row by a key that only the large side repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, materialize

SCALE = 256
#: Entries of one block: its rows are so many over the dimension.
BLOCK_ENTRIES = 1 << 17
#: Blocks of rows in one block matrix.
STRIPE_BLOCKS = 1 << 14
#: The scatter matrix of so many dimensions is a local matrix of 128 MB.
MAX_DIMENSION = 4096
#: Components with a smaller part of the variance cannot be told from rounding.
LEAST_PART = 1e-12


def integer_vector(vector: str | Column, scale: int = SCALE) -> Column:
    """``floor(scale * entry)`` of each entry as long; null for vectors that are null or hold null, NaN or infinity."""
    c = F.col(vector) if isinstance(vector, str) else vector
    doubles = c.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written, with ``idx`` from 0 without gaps."""
    held = materialize(df.withColumn("id", F.monotonically_increasing_id()), name)
    held = held.withColumn("part", F.shiftright("id", 33))
    counts = held.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # One row for each partition that was written.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    idx = F.col("offset") + F.col("id") - F.shiftleft(F.col("part"), 33)
    return held.join(offsets, "part").withColumn("idx", idx).drop("id", "part", "offset")


def column_sums(fit: DataFrame, dimension: int) -> list[int]:
    """The exact sum of each entry of ``x``."""
    entries = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at")
    sums = {r["at"]: int(r["s"]) for r in entries.agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).collect()}
    return [sums.get(k, 0) for k in range(dimension)]


@dataclass
class Whitening:
    """n distinct vectors, their sums, and the components by falling variance."""

    n: int
    sums: list[int]
    variances: np.ndarray
    vectors: np.ndarray  # one column for each component
    total: float

    @property
    def usable(self) -> int:
        """The number of components that have variance."""
        return int((self.variances > LEAST_PART * self.total).sum()) if self.total > 0 else 0

    def matrix(self, components: int) -> np.ndarray:
        return self.vectors[:, :components] / np.sqrt(self.variances[:components])


def _blocks(means: list[float], rows_per_block: int):
    """Rows (idx, v) sorted by idx, whole blocks in a partition, to (block, size, centred values by column)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = -1, []
        for batch in batches:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            values = values.reshape(batch.num_rows, len(means)) - means
            of = batch.column(0).to_numpy() // rows_per_block
            for one in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1) if len(of) else ():
                if of[one[0]] != block and held:
                    yield _block(block, held)
                    held = []
                block = int(of[one[0]])
                held.append(values[one])
        if held:
            yield _block(block, held)

    return run


def _block(block: int, held: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(held)
    arrays = [pa.array([block], pa.int32()), pa.array([len(rows)], pa.int32()), pa.array([rows.tobytes("F")])]
    return pa.RecordBatch.from_arrays(arrays, names=["block", "size", "data"])


def block_matrix(rows: DataFrame, means: list[float], rows_per_block: int, first: int, stop: int) -> BlockMatrix:
    """The rows ``first`` to ``stop`` - 1 of (idx, v), less the means, as blocks of all columns."""
    width = len(means)
    rows = rows.where((F.col("idx") >= first) & (F.col("idx") < stop))
    rows = rows.select((F.col("idx") - first).alias("idx"), "v")
    # A task of the products holds the blocks of one partition, four or so.
    parts = -(-(stop - first) // (4 * rows_per_block))
    block = F.floor(F.col("idx") / rows_per_block)
    dealt = rows.repartition(parts, block).sortWithinPartitions("idx")
    made = dealt.mapInArrow(_blocks(means, rows_per_block), "block int, size int, data binary").rdd
    made = made.map(lambda r: ((r.block, 0), Matrices.dense(r.size, width, np.frombuffer(r.data))))
    return BlockMatrix(made, rows_per_block, width, stop - first, width)


def transpose_multiply(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix: the products of two blocks a task, then their sum."""
    left = blocks.transpose()
    # All products belong to the one block of the result. How many tasks share
    # them is an argument of the JVM's method that the Python one leaves out.
    splits = -(-blocks.numRowBlocks // 2)
    product = left._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def stripes(n: int, rows_per_block: int) -> list[tuple[int, int]]:
    step = rows_per_block * STRIPE_BLOCKS
    return [(k, min(n, k + step)) for k in range(0, n, step)]


def covariance(rows: DataFrame, means: list[float], n: int, rows_per_block: int) -> np.ndarray:
    """The covariance, divisor n, of the rows (idx, v)."""
    total = np.zeros((len(means), len(means)))
    for first, stop in stripes(n, rows_per_block):
        total += transpose_multiply(block_matrix(rows, means, rows_per_block, first, stop))
    return total / n


def project(rows: DataFrame, means: list[float], matrix: np.ndarray, n: int, rows_per_block: int) -> DataFrame:
    """(idx, v): the centred rows times ``matrix``, written."""
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("idx", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType()))])
    out = None
    for first, stop in stripes(n, rows_per_block):
        blocks = block_matrix(rows, means, rows_per_block, first, stop)
        local = Matrices.dense(*matrix.shape, matrix.ravel(order="F").tolist())
        right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), *matrix.shape)
        made = blocks.multiply(right).toIndexedRowMatrix().rows
        made = made.map(lambda r, first=first: (r.index + first, r.vector.toArray().tolist()))
        part = materialize(spark.createDataFrame(made, schema), "projected")
        out = part if out is None else out.unionByName(part)
    return out


def fit_components(fit: DataFrame, dimension: int, rows_per_block: int) -> Whitening:
    """The components of the distinct vectors (idx, x); a component's largest entry is positive."""
    n = fit.count()
    sums = column_sums(fit, dimension)
    rows = fit.select("idx", F.col("x").alias("v"))
    spread = covariance(rows, [s / n for s in sums], n, rows_per_block)
    values, vectors = np.linalg.eigh((spread + spread.T) / 2)
    values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
    top = vectors[np.argmax(np.abs(vectors), axis=0), np.arange(dimension)]
    return Whitening(n, sums, values, vectors * np.where(top < 0, -1.0, 1.0), float(np.trace(spread)))


def _deviation(n: int, sums: list[int]) -> Column:
    """The sum of (n * x - S)^2, exact, as long; null if it is beyond long."""

    def whole(value) -> Column:
        return F.lit(str(value)).try_cast("decimal(38,0)")

    x = F.transform("x", lambda v: v.cast("decimal(38,0)"))
    zero = F.lit(0).cast("decimal(38,0)")
    squares = F.aggregate(x, zero, lambda a, v: F.try_add(a, F.try_multiply(v, v)))
    pairs = F.zip_with(x, F.array(*[whole(s) for s in sums]), lambda v, s: F.try_multiply(v, s))
    cross = F.aggregate(pairs, zero, lambda a, v: F.try_add(a, v))
    # n^2 * sum of x^2 - 2 * n * sum of x * S + sum of S^2
    inner = F.try_subtract(F.try_multiply(whole(n), squares), F.try_multiply(whole(2), cross))
    return F.try_add(F.try_multiply(whole(n), inner), whole(sum(s * s for s in sums))).try_cast("long")


def whiten(
    df: DataFrame,
    vector_col: str = "embedding",
    keep: tuple[str, ...] | None = None,
    components: int | None = None,
    scale: int = SCALE,
) -> DataFrame:
    """``__row`` (the ``keep`` columns; default all), n, deviation, whitened, explained, identity_error.

    ``whitened``: the row on each of the first ``components`` (default all),
    ``explained``: their parts of the variance, ``identity_error``: the largest
    entry by which the covariance of the whitened distinct vectors is off the
    identity. Vectors that are null or hold null, NaN or infinity are dropped;
    null and repeated ids stay, each row for itself; a vector shorter than the
    longest is filled up with zeros. A component without variance (copies of one
    vector alone, fewer vectors than entries) has whitened null, and so has what it
    leaves undefined; a deviation beyond long is null. Components of equal variance
    come in the order of the solver. An empty table gives no rows. A vector is
    one row of a block, so its length is bounded by ``MAX_DIMENSION``: beyond, an error.
    """
    spark = df.sparkSession
    kept = F.struct(*[F.col(f"`{c}`") for c in (keep or df.columns)]).alias(ROW)
    rows = df.select(kept, integer_vector(F.col(f"`{vector_col}`"), scale).alias("x")).where("x IS NOT NULL")
    dimension = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; at most {MAX_DIMENSION} can be whitened")
    k = dimension if components is None else min(components, dimension)
    if not dimension:
        fields = "n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
        return spark.createDataFrame([], T.StructType([df.select(kept).schema[0], *T.StructType.fromDDL(fields)]))
    zeros = F.array_repeat(F.lit(0).cast("long"), dimension - F.size("x"))
    rows = rows.withColumn("x", F.concat("x", zeros))
    rows = rows.withColumn("key", F.unhex(F.md5(F.array_join(F.col("x").cast("array<string>"), ",").cast("binary"))))
    fit = numbered(rows.groupBy("key").agg(F.first("x").alias("x")), "vectors")
    rows_per_block = max(1, BLOCK_ENTRIES // dimension)
    found = fit_components(fit, dimension, rows_per_block)
    use = min(k, found.usable)
    error, made = None, fit.select("idx", F.array().cast("array<double>").alias("v"))
    if use:
        means = [s / found.n for s in found.sums]
        made = project(fit.select("idx", F.col("x").alias("v")), means, found.matrix(use), found.n, rows_per_block)
        again = [made.agg(*[F.avg(F.col("v")[c]) for c in range(use)]).first()[c] for c in range(use)]
        error = float(np.abs(covariance(made, again, found.n, rows_per_block) - np.eye(use)).max())
    none = F.array_repeat(F.lit(None).cast("double"), k - use)
    parts = [float(v) / found.total if found.total > 0 else None for v in found.variances[:k]]
    told = fit.join(made, "idx").select(
        "key", F.concat("v", none).alias("whitened"), _deviation(found.n, found.sums).alias("deviation")
    )
    told = materialize(told, "whitened")
    return rows.select(ROW, "key").join(told, "key").select(
        ROW,
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.array(*[F.lit(p).cast("double") for p in parts]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def whitening_report(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    made = whiten(embeddings, keep=("vec_id",), components=components)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return made.select(F.col(f"{ROW}.vec_id").alias("vec_id"), each, "n", "deviation", "identity_error").select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )
