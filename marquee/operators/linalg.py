"""Tall-and-skinny matrices: one row of a frame is one row of the matrix,
its numbers an array column.  Vectors stay arrays; a task works on blocks
of rows with numpy and hands on small square matrices, which are combined
pairwise (a tree of ``FAN`` at a time), never row by row.

* ``tsqr`` — R of the QR factorisation: every task factors its blocks one
  after the other, the tree factors the stacked R of its children;
* ``svd`` — singular values and right vectors from R, left vectors per
  block of rows as X V / s;
* ``gram`` — X'X as a tree of sums; ``column_similarities`` divides it by
  the columns' norms; ``pca`` factors the centred rows.

Rows whose vector is NULL or holds a NULL are left out of the factors and
keep a NULL left vector.  Vectors of another length than the first are an
error.  An empty matrix has no columns: its results are empty.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 16              # matrices combined by one task of the tree
BLOCK_ROWS = 4_096    # rows of a block
#: Columns of a matrix: a d x d matrix is what a task and the driver hold.
MAX_COLUMNS = 4_096


def dense(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column as a matrix, and the places they come from."""
    size = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size >= 0)
    flat = column.flatten()
    if flat.null_count:
        owner = np.repeat(np.arange(len(column)), np.maximum(size, 0))
        bad = np.unique(owner[flat.is_null().to_numpy(zero_copy_only=False)])
        keep = np.setdiff1d(at, bad)
        mask = np.isin(owner, keep)
        flat, at = flat.filter(pa.array(mask)), keep
    if not len(at):
        return np.empty((0, 0)), at
    if len(set(size[at].tolist())) > 1:
        raise ValueError("vectors of different lengths")
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(at), -1), at


def _blocks(batches, column: int = 0):
    for b in batches:
        for i in range(0, b.num_rows, BLOCK_ROWS):
            x, _ = dense(b.column(column).slice(i, BLOCK_ROWS))
            if x.size:
                if x.shape[1] > MAX_COLUMNS:
                    raise ValueError(f"{x.shape[1]} columns, {MAX_COLUMNS} at most")
                yield x


def _one(m: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([m.tolist()], pa.list_(pa.list_(pa.float64())))], names=["m"])


def _tree(rows: DataFrame, vec: str, leaf, combine) -> np.ndarray | None:
    """``leaf`` of each block, combined within the tasks and then over ever
    fewer tasks; only the last matrix reaches the driver."""
    schema = "m array<array<double>>"

    def reduce(found):
        out = None
        for m in found:
            out = m if out is None else combine(out, m)
        if out is not None:
            yield _one(out)

    parts = rows.select(vec).mapInArrow(lambda batches: reduce(leaf(x) for x in _blocks(batches)), schema)
    widest = min(FAN * FAN, rows.sparkSession.sparkContext.defaultParallelism)
    for width in (widest, *([FAN] if widest > FAN else []), 1):
        parts = parts.repartition(width).mapInArrow(lambda batches: reduce(np.array(m.as_py(), float) for b in batches for m in b.column(0)), schema)
    last = parts.first()
    return None if last is None else np.array(last.m, float)


def _r(x: np.ndarray) -> np.ndarray:
    return np.linalg.qr(x, mode="r")


def tsqr(df: DataFrame, vec: str) -> np.ndarray | None:
    """R of X = QR with a positive diagonal (None: no rows)."""
    r = _tree(df, vec, _r, lambda a, b: _r(np.vstack([a, b])))
    return None if r is None else r * np.where(np.diag(r) < 0, -1.0, 1.0)[:, None] if r.shape[0] == r.shape[1] else r


def gram(df: DataFrame, vec: str) -> np.ndarray | None:
    """X'X (None: no rows)."""
    return _tree(df, vec, lambda x: x.T @ x, np.add)


@dataclass
class SVD:
    """X = U diag(s) V': ``u`` is the input with the column of left vectors."""

    u: DataFrame | None
    s: np.ndarray
    v: np.ndarray


def _signs(v: np.ndarray) -> np.ndarray:
    """The component of largest size of each right vector is positive."""
    if not v.size:
        return v
    top = v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])]
    return v * np.where(top < 0, -1.0, 1.0)


def svd(df: DataFrame, vec: str, k: int | None = None, compute_u: bool = True, r_cond: float = 1e-9, out: str = "u") -> SVD:
    """The ``k`` largest singular values (all: None) over ``r_cond`` times
    the largest one, their right and, row by row, their left vectors."""
    r = tsqr(df, vec)
    if r is None:
        return SVD(df.withColumn(out, F.lit(None).cast("array<double>")) if compute_u else None, np.empty(0), np.empty((0, 0)))
    _, s, vt = np.linalg.svd(r)
    keep = int((s > r_cond * s[0]).sum()) if len(s) and s[0] > 0 else 0
    keep = min(keep, k) if k is not None else keep
    s, v = s[:keep], _signs(vt[:keep].T)
    return SVD(project(df, vec, v / s if keep else v, out) if compute_u else None, s, v)


def project(df: DataFrame, vec: str, m: np.ndarray, out: str, shift: np.ndarray | None = None) -> DataFrame:
    """``df`` with X M (or (X - shift) M) as array column ``out``; M has at
    most MAX_COLUMNS x MAX_COLUMNS numbers."""
    shared = df.sparkSession.sparkContext.broadcast((m, shift))
    at = df.columns.index(vec)
    schema = df.withColumn(out, F.lit(None).cast("array<double>")).schema

    def run(batches):
        m, shift = shared.value
        for b in batches:
            for i in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(i, BLOCK_ROWS)
                x, rows = dense(part.column(at))
                value: list = [None] * part.num_rows
                if x.size:
                    y = (x if shift is None else x - shift) @ m
                    for j, r in zip(rows.tolist(), y.tolist()):
                        value[j] = r
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value, pa.list_(pa.float64()))], names=schema.names)
    return df.mapInArrow(run, schema)


def means(df: DataFrame, vec: str) -> tuple[int, np.ndarray]:
    """Number of rows and mean of each column."""
    total = _tree(df, vec, lambda x: np.append(x.sum(axis=0), len(x))[None, :], np.add)
    return (0, np.empty(0)) if total is None else (int(total[0, -1]), total[0, :-1] / total[0, -1])


@dataclass
class PCA:
    mean: np.ndarray
    components: np.ndarray        # a column for each component
    variance: np.ndarray          # sample variance along it
    ratio: np.ndarray


def pca(df: DataFrame, vec: str, k: int) -> PCA:
    """``k`` principal components from R of the centred rows."""
    n, mean = means(df, vec)
    if not n:
        return PCA(mean, np.empty((0, 0)), np.empty(0), np.empty(0))
    r = _tree(df, vec, lambda x: _r(x - mean), lambda a, b: _r(np.vstack([a, b])))
    _, s, vt = np.linalg.svd(r)
    variance = s ** 2 / max(1, n - 1)
    total = variance.sum()
    return PCA(mean, _signs(vt[:k].T), variance[:k], variance[:k] / total if total > 0 else np.zeros(min(k, len(variance))))


def column_similarities(df: DataFrame, vec: str) -> DataFrame:
    """Rows (i, j, sim), i < j: cosine of two columns (NULL: a zero column)."""
    g = gram(df, vec)
    spark = df.sparkSession
    d = 0 if g is None else len(g)
    norm = np.sqrt(np.diag(g)) if d else np.empty(0)
    shared = spark.sparkContext.broadcast((g, norm))

    def run(batches):
        g, norm = shared.value
        for b in batches:
            for i in b.column(0).to_pylist():
                j = np.arange(i + 1, len(norm))
                with np.errstate(divide="ignore", invalid="ignore"):
                    sim = g[i, j] / (norm[i] * norm[j])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), i), pa.int32()), pa.array(j, pa.int32()), pa.array(sim, mask=~np.isfinite(sim))], names=["i", "j", "sim"])
    return spark.range(d).mapInArrow(run, "i int, j int, sim double")
