"""Embedding whitening with MLlib block matrices.

Rows become exact integers; n·x − S, still exact, over n is the centred row. Centred rows are cut into blocks where they
lie, a block number for each. The scatter matrix is the product of the block matrix's transpose with itself, summed over
many groups of blocks; its eigenvectors are found on the driver (dimensions squared numbers), and a second block product
with the whitening matrix projects all rows. The covariance of the result comes from a third product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampleloom.llm.frames import schema_of, shared_path, table
from sampleloom.llm.registry import query

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries of a block, and the most groups of blocks whose products are summed at the end.
BLOCK_ENTRIES, GROUPS = 1 << 18, 1024
#: Entries from here on count as not finite: their integers would not be exact.
TOO_LARGE = float(1 << 40)
#: Components with a smaller share of the largest eigenvalue have no spread to divide by.
FLAT = 1e-12


def integer_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, x`` of rows whose vector has only finite entries: x = floor(64 c) + 1000000."""
    v = F.col(vec_col).cast("array<double>")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < TOO_LARGE))
    return df.where(ok).select(F.col(id_col).alias("vec_id"), F.transform(v, lambda c: F.when(F.abs(c) < TOO_LARGE, F.floor(c * SCALE) + SHIFT)).alias("x"))


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(-1, dim)


def deviations(y: np.ndarray) -> list[int | None]:
    """Exact sums of squares of integer rows; null beyond the range of a long."""
    if not len(y) or float(np.abs(y).max()) ** 2 * y.shape[1] < 2 ** 62:
        return (y * y).sum(1).tolist()
    sums = [sum(a * a for a in row) for row in y.tolist()]
    return [s if s < 1 << 63 else None for s in sums]


def _numbered(rows: DataFrame, per_block: int, path: str) -> tuple[DataFrame, np.ndarray, int]:
    """Rows with their place in a written part, the number of blocks before each part (one number per part), and of all blocks."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows.select("*", F.spark_partition_id().alias("part"), place.alias("place")).write.parquet(path)
    stored = rows.sparkSession.read.parquet(path)
    sizes = {r["part"]: -(-r["count"] // per_block) for r in stored.groupBy("part").count().collect()}
    blocks = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], np.int64)
    return stored, np.cumsum(blocks) - blocks, int(blocks.sum())


def _index(b: pa.RecordBatch, first: np.ndarray, per_block: int) -> np.ndarray:
    return first[np.asarray(b.column("part"))] * per_block + np.asarray(b.column("place"))


def block_matrix(stored: DataFrame, first: np.ndarray, blocks: int, per_block: int, dim: int, total: np.ndarray, n: int) -> BlockMatrix:
    """Blocks of centred rows. The rows of a block lie in one part, in order; places without a row are zero. A part that is
    read in two pieces gives two blocks with other rows filled, which add up in every product."""
    shared = stored.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            index, x = _index(b, shared.value, per_block), _matrix(b.column("x"), dim)
            centred = (x * n - total) / n
            cut = np.flatnonzero(np.diff(index // per_block)) + 1
            for rows, places in zip(np.split(centred, cut), np.split(index, cut)):
                if not len(places):
                    continue
                k = int(places[0]) // per_block
                if k not in held:
                    yield from _given(held)
                    held[k] = np.zeros((per_block, dim))
                held[k][places % per_block] = rows
        yield from _given(held)

    wide = stored.select("part", "place", "x").mapInArrow(run, schema_of("block long, entries binary"))
    made = wide.rdd.map(lambda r: ((r["block"], 0), DenseMatrix(per_block, dim, np.frombuffer(r["entries"]), True)))
    return BlockMatrix(made, per_block, dim, blocks * per_block, dim)


def _given(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for k in list(held):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([held.pop(k).tobytes()], pa.binary())], names=["block", "entries"])


def product(a: BlockMatrix, b: BlockMatrix, groups: int, rows: int, cols: int) -> BlockMatrix:
    """a·b with the blocks along the inner side dealt to ``groups`` tasks before they are summed."""
    made = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(made, rows, cols)


def _forget(m: BlockMatrix) -> None:
    m._java_matrix_wrapper._java_model.blocks().unpersist(False)


def scatter(m: BlockMatrix, per_block: int, dim: int, groups: int) -> np.ndarray:
    return product(m.transpose(), m, groups, dim, dim).toLocalMatrix().toArray()


def whitening_matrix(cov: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors over the root of their eigenvalues as columns, by falling eigenvalue, and each share of the trace.
    The largest entry of a vector is positive, so the sign does not depend on the run."""
    e, v = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > FLAT * max(e[order].max(initial=0.0), 1e-300)]
    e_, v = e[order], v[:, order]
    v = v * np.sign(v[np.abs(v).argmax(0), np.arange(len(e_))]) if len(e_) else v
    return v / np.sqrt(e_), e_ / max(np.trace(cov), 1e-300)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row and component.

    Rows without a vector, or whose vector is empty or holds null, NaN, infinite entries or entries from 2^40 on, take no part, nor do
    vectors of another length than most (of equally many, the longer). Repeated rows and rows with a null id are rows of
    their own. Components without spread (an eigenvalue below 10^-12 of the largest) are left out, so a single row, equal rows and an
    empty table give no rows. ``deviation`` is null where it exceeds a long. Other columns are not read.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    rows = integer_rows(df, id_col, vec_col)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return empty
    dim, n = lengths["d"], lengths["count"]
    rows = rows.where(F.size("x") == dim)
    sums = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("s")).collect()  # one row per dimension
    total = np.array([r["s"] for r in sorted(sums, key=lambda r: r["at"])], np.int64)
    per_block = max(1, BLOCK_ENTRIES // dim) if n * dim > BLOCK_ENTRIES * 8 else max(1, -(-n // 8))

    stored, first, blocks = _numbered(rows, per_block, shared_path(spark, "vectors"))
    m = block_matrix(stored, first, blocks, per_block, dim, total, n)
    groups = max(1, min(GROUPS, blocks))
    m.persist(StorageLevel.MEMORY_AND_DISK)
    w, share = whitening_matrix(scatter(m, per_block, dim, groups) / n, components)
    if not len(share):
        _forget(m)
        return empty
    k = len(share)
    local = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(dim, k, w.T.ravel()))], 1), dim, k, dim, k)
    z = product(m, local, 1, per_block, k)
    z.persist(StorageLevel.MEMORY_AND_DISK)
    error = float(np.abs(scatter(z, per_block, k, groups) / n - np.eye(k)).max())
    path = shared_path(spark, "whitened")
    made = callMLlibFunc("getIndexedRows", z.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    made.select("index", vector_to_array("vector").alias("z")).write.parquet(path)
    _forget(m)
    _forget(z)
    shared = spark.sparkContext.broadcast(first)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = deviations(_matrix(b.column("x"), dim) * n - total)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_index(b, shared.value, per_block)), pa.array(d, pa.int64())],
                                             names=["vec_id", "index", "deviation"])

    left = stored.select("vec_id", "part", "place", "x").mapInArrow(exact, schema_of(f"vec_id {kind}, index long, deviation long"))
    got = left.join(spark.read.parquet(path), "index")
    shares = F.array(*[F.lit(float(s)) for s in share])
    long = got.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


@query("op11_embedding_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
