"""Embedding whitening with MLlib's distributed block matrices.

1. Every usable vector becomes integers x = floor(64 * c) + 1000000, stored as
   the narrowest bytes that hold x - 1000000, so equal vectors have equal bytes.
2. The fit list is each distinct vector once; its count n and sums S are exact
   (decimal sums over partial sums of the tasks).
3. The fit list's rows, centred as (n * x - S) / n from exact integers, fill the
   blocks of a BlockMatrix A. Aᵀ A is the scatter; its product is split along
   the rows (``numMidDimSplits``), so no task gets the whole matrix.
4. The scatter (one row and column per dimension) is decomposed on the driver.
   The whitening matrix W has the unit eigenvectors over the square roots of
   the eigenvalues; the block product A W projects the fit list, whose own
   scatter gives the identity error, and the same product projects all rows.

Cases: null vectors and those with null, NaN or infinite entries, or with
entries whose integer would pass 2^53, are left out; so are vectors of another
length than the most frequent one (ties: the longer). A null id keeps its rows,
repeated rows each get theirs, though the fit list counts a vector once. A
component without variance (eigenvalue below the rounding of the largest) has
whitened 0 and is not part of the identity error; a deviation of more than 63
bits is null. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import with_package, written

SCALE, OFFSET, MOST = 64, 1_000_000, 1 << 53
#: Rows of a block, and its columns at most.
ROWS, COLUMNS = 1024, 1024
KINDS = ("<i2", "<i4", "<i8")
OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(64 * c) for finite rows of doubles."""
    return np.floor(SCALE * vectors).astype(np.int64)


def packed(rows: np.ndarray) -> list[bytes]:
    """Each row of integers as a tag and the narrowest bytes that hold it."""
    most = np.maximum(np.abs(rows.min(axis=1, initial=0)), rows.max(axis=1, initial=0) + 1)
    kind = np.searchsorted([1 << 15, 1 << 31], most)
    out: list = [None] * len(rows)
    for k, name in enumerate(KINDS):
        at = np.flatnonzero(kind == k)
        for i, row in zip(at.tolist(), np.ascontiguousarray(rows[at].astype(name))):
            out[i] = bytes([k]) + row.tobytes()
    return out


def unpacked(rows: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(r, KINDS[r[0]], offset=1) for r in rows], np.int64)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, dim, x`` of each row that has a usable vector. Narrow."""
    own = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            v = b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            flat = v.flatten()                                # without what lies under null vectors
            usable = ~v.is_null().to_numpy(zero_copy_only=False)
            start = np.r_[0, np.cumsum(sizes * usable)]
            entries = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[usable]).tolist():
                at = np.flatnonzero(usable & (sizes == dim))
                rows = entries[start[at][:, None] + np.arange(dim)]
                fine = (np.abs(rows) < MOST / SCALE).all(axis=1)          # false for NaN and infinities
                at, x = at[fine], integers(rows[fine])
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)),
                     pa.array(packed(x), pa.binary())], ["vec_id", "dim", "x"])
    return with_package(own).mapInArrow(run, "vec_id long, dim int, x binary")


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Count of the vectors and the exact sum of each dimension of x."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = unpacked(b.column("x").to_pylist())
                exact = x.astype(object) if int(np.abs(x).max(initial=0)) >= (1 << 62) // len(x) else x
                sums = [int(s) + OFFSET * len(x) for s in exact.sum(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(-1, dim), pa.int32()), pa.array([len(x), *sums], pa.decimal128(38, 0))], ["k", "s"])
    got = with_package(fit).mapInArrow(run, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()
    sums = {r.k: int(r.s) for r in got}                       # one row per dimension
    return sums.get(-1, 0), [sums.get(k, 0) for k in range(dim)]


def _deviations(shifted: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly; null where it passes 63 bits."""
    most = int(np.abs(shifted).max(initial=0))
    if most * most * max(1, shifted.shape[1]) >= 1 << 63:
        shifted = shifted.astype(object)
    return [int(s) if s < 1 << 63 else None for s in (shifted * shifted).sum(axis=1)]


def centred_blocks(rows: DataFrame, n: int, sums: list[int], name: str) -> DataFrame:
    """``vec_ids, deviations, block, block_row``: the centred rows in blocks
    of ROWS, the last of a task filled with zeros; ``block`` is column-major.
    The blocks are stored, so their numbers cannot change between two scans."""
    dim = len(sums)

    def run(batches):
        seq, ids, held = 0, [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            held += b.column("x").to_pylist()
            while len(held) >= ROWS:
                yield block(seq, ids[:ROWS], held[:ROWS])
                seq, ids, held = seq + 1, ids[ROWS:], held[ROWS:]
        if held:
            yield block(seq, ids, held)

    def block(seq, ids, held):
        x = unpacked(held) + OFFSET
        wide = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0) >= 1 << 63
        shifted = x.astype(object) * n - np.array(sums, object) if wide else x * n - np.array(sums, np.int64)
        centred = np.zeros((ROWS, dim))
        centred[:len(held)] = (shifted / n).astype(np.float64)
        return pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([seq], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([_deviations(shifted)], pa.list_(pa.int64())), pa.array([centred.tobytes("F")], pa.binary())],
            ["part", "seq", "vec_ids", "deviations", "block"])
    stored = written(with_package(rows).mapInArrow(
        run, "part int, seq int, vec_ids array<long>, deviations array<long>, block binary"), name)
    parts = stored.agg(F.coalesce(F.max("part") + 1, F.lit(1))).first()[0]
    return stored.withColumn("block_row", F.col("seq") * F.lit(parts) + F.col("part")).drop("part", "seq")


def block_matrix(blocks: DataFrame, dim: int) -> tuple[BlockMatrix, int]:
    """The blocks as a BlockMatrix (blocks that do not exist are zero), and the
    number of its block rows."""
    count = blocks.agg(F.coalesce(F.max("block_row") + 1, F.lit(1))).first()[0]
    wide = min(dim, COLUMNS)

    def cut(row):
        m = np.frombuffer(row.block).reshape(ROWS, dim, order="F")
        for j in range(0, dim, wide):
            part = m[:, j:j + wide]
            yield (row.block_row, j // wide), DenseMatrix(ROWS, part.shape[1], part.ravel(order="F"))
    return BlockMatrix(blocks.select("block_row", "block").rdd.flatMap(cut), ROWS, wide, count * ROWS, dim), count


def times(a: BlockMatrix, b: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """a b; ``splits`` cuts the inner dimension, whose parts are summed."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def scatter(a: BlockMatrix, count: int, spark: SparkSession) -> np.ndarray:
    """aᵀ a, one row and column per column of a: small enough for the driver."""
    splits = max(1, min(count, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return times(a.transpose(), a, splits).toLocalMatrix().toArray()


def whitening_matrix(cov: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(W, explained shares, which components have variance) by falling
    eigenvalue; columns without variance are zero."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[:top]
    e, u = values[order], vectors[:, order]
    real = e > max(0.0, values.max(initial=0.0)) * len(cov) * np.finfo(float).eps
    total = np.trace(cov)
    w = np.where(real, u / np.sqrt(np.where(real, e, 1.0)), 0.0)
    return w, np.where(real, e, 0.0) / (total if total > 0 else 1.0), real


def local_blocks(spark: SparkSession, m: np.ndarray, rows: int) -> BlockMatrix:
    parts = [((i // rows, 0), DenseMatrix(len(m[i:i + rows]), m.shape[1], m[i:i + rows].ravel(order="F")))
             for i in range(0, len(m), rows)]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows, m.shape[1], len(m), m.shape[1])


def whiten(df: DataFrame, id_col: str, vec_col: str, top: int = 16) -> DataFrame:
    """One row per usable vector and component (``top`` at most), columns as in OUT."""
    spark = df.sparkSession
    usable = written(integer_vectors(df, id_col, vec_col), "integer-vectors")
    best = usable.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if best is None or best.dim == 0:
        return spark.createDataFrame([], OUT)
    dim = best.dim
    rows = usable.where(F.col("dim") == dim).select("vec_id", "x")
    fit = written(rows.select("x").distinct().select(F.lit(None).cast("long").alias("vec_id"), "x"), "fit-list")
    n, sums = exact_sums(fit, dim)

    a, count = block_matrix(centred_blocks(fit, n, sums, "fit-blocks"), dim)
    w, explained, real = whitening_matrix(scatter(a, count, spark) / n, top)
    project = local_blocks(spark, w, min(dim, COLUMNS))
    error = scatter(times(a, project), count, spark) / n - np.eye(w.shape[1])
    worst = float(np.abs(error[np.ix_(real, real)]).max(initial=0.0))

    blocks = centred_blocks(rows, n, sums, "row-blocks")
    all_rows, _ = block_matrix(blocks, dim)
    projected = times(all_rows, project).blocks.map(
        lambda b: (b[0][0], bytearray(b[1].toArray().astype("<f8").tobytes()))).toDF("at long, y binary")
    k = w.shape[1]

    def run(batches):
        for b in batches:
            for ids, devs, y in zip(*(b.column(c).to_pylist() for c in ("vec_ids", "deviations", "y"))):
                m = len(ids)
                each = pa.array(np.repeat(np.arange(m), k))
                y = np.frombuffer(y).reshape(ROWS, k)[:m] + 0.0               # no negative zeros
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()).take(each),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     pa.array(devs, pa.int64()).take(each), pa.array(y.reshape(-1)),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * k, worst))],
                    [c.split()[0] for c in OUT.split(", ")])
    joined = blocks.join(projected, F.col("block_row") == F.col("at")).select("vec_ids", "deviations", "y")
    return with_package(joined).mapInArrow(run, OUT)
