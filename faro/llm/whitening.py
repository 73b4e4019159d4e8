"""Embedding whitening with refined eigenvectors.

Every vector entry c becomes the integer x = floor(scale * c) + offset.  One
scan gives the number of rows, the exact sums and the centred scatter of x:
each task centres its batches by their own exact means, partial results are
merged pairwise (with the exact difference of their means) in a tree of at
most ``FAN`` a group, so the driver receives one d x d matrix.

The eigenvectors of that covariance start in float32 and are corrected by
Ogita-Aishima iterations, which need matrix products only and are done in
extended precision; each iteration roughly doubles the correct digits.
Eigenvalues closer than the iteration can tell apart form a cluster: the
covariance, shifted by the cluster's mean, is projected on the cluster's
vectors and solved there, so the vectors turn within their subspace before
the iterations go on.

Defined results.  A vector that is null or empty, or that holds a null, a
non-finite entry or one of 2**40 or more in size, is dropped; so is one whose
length is not the commonest in the table (ties: the longer).  Null and
repeated ids and repeated rows stay and count as often as they occur.
Components without variance (share below ``LEAST_SHARE``) do not exist: an
empty table, or one with equal vectors only, gives no rows.  Other columns of
the table are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faro.llm.common import stage

FAN = 16                # partial results merged by one task
MOST = 2.0 ** 40        # larger entries count as not finite
LEAST_SHARE = 1e-11     # smallest share of the variance a component must have
CLOSE = 1e-9            # gaps below this share of the largest eigenvalue are left to sub-solves: a step divides by the gap
PARTIAL = "d int, part long, n long, sums array<decimal(38,0)>, scatter binary"


def integer_blocks(column: pa.Array, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer matrix) for every vector length in a batch; rows that the docstring drops are left out."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(column.flatten(), pa.float64(), safe=False).to_numpy(zero_copy_only=False)   # null entries turn into NaN
    ends = np.cumsum(size)
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        c = flat if len(rows) * d == len(flat) else flat[(ends[rows] - d)[:, None] + np.arange(d)]
        c = c.reshape(len(rows), d)
        fine = (np.abs(c) < MOST).all(axis=1)
        if fine.any():
            yield rows[fine], np.floor(c[fine] * scale).astype(np.int64) + offset


@dataclass
class Moments:
    """Row count, exact integer sums and centred scatter of integer vectors."""

    n: int
    sums: np.ndarray      # Python integers
    scatter: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        n, d = x.shape
        safe = int(np.abs(x).max()) * n < 1 << 62
        sums = x.sum(axis=0).astype(object) if safe else x.astype(object).sum(axis=0)
        c = centred(x, n, sums)
        return Moments(n, sums, c.T @ c)

    def plus(self, other: Moments) -> Moments:
        gap = self.sums * other.n - other.sums * self.n           # n1 n2 (mean1 - mean2), exact
        gap = np.array([float(g) for g in gap]) / (float(self.n) * float(other.n))
        weight = float(self.n) * float(other.n) / float(self.n + other.n)
        return Moments(self.n + other.n, self.sums + other.sums, self.scatter + other.scatter + weight * np.outer(gap, gap))


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n in double precision, subtracted as integers before the division."""
    return deviations(x, n, sums).astype(np.float64) / float(n)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exact: 64-bit integers, or Python integers where those could overflow."""
    top = max((abs(int(s)) for s in sums), default=0)
    if n * int(np.abs(x).max(initial=0)) + top < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def squared_lengths(dev: np.ndarray) -> pa.Array:
    """Exact sum of squares of every row as decimal(38, 0); null beyond 38 digits."""
    if dev.dtype != object and int(np.abs(dev).max(initial=0)) < 1 << 56 and dev.shape[1] <= 64:
        hi, lo = dev >> 28, dev & ((1 << 28) - 1)
        a, b, c = (hi * hi).sum(axis=1), (hi * lo).sum(axis=1), (lo * lo).sum(axis=1)
        if not len(a) or int(a.max()) < 1 << 6:
            return pc.cast(pa.array((a << 56) + (b << 29) + c), pa.decimal128(38, 0))
        total = [(p << 56) + (q << 29) + r for p, q, r in zip(a.tolist(), b.tolist(), c.tolist())]
    else:
        total = (dev.astype(object) ** 2).sum(axis=1).tolist()
    return pa.array([Decimal(t) if t < 10 ** 38 else None for t in total], pa.decimal128(38, 0))


def moments(df: DataFrame, vec_col: str, scale: int, offset: int) -> Moments | None:
    """Moments over all usable vectors of the commonest length; one scan."""
    vectors = df.select(F.col(f"`{vec_col}`").alias("v"), F.spark_partition_id().cast("long").alias("part"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, Moments] = {}
        part = 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column(1)[0].as_py()
            for _, x in integer_blocks(batch.column(0), scale, offset):
                new = Moments.of(x)
                d = x.shape[1]
                have[d] = have[d].plus(new) if d in have else new
        yield pa.RecordBatch.from_arrays([
            pa.array(list(have), pa.int32()), pa.array([part] * len(have), pa.int64()), pa.array([m.n for m in have.values()], pa.int64()),
            pa.array([[Decimal(int(s)) for s in m.sums] for m in have.values()], pa.list_(pa.decimal128(38, 0))),
            pa.array([m.scatter.tobytes() for m in have.values()], pa.binary())], names=["d", "part", "n", "sums", "scatter"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        total = None
        for r in pdf.itertuples():
            m = moments_of(r)
            total = m if total is None else total.plus(m)
        return pd.DataFrame({"d": [int(pdf.d.iloc[0])], "part": [int(pdf.part.iloc[0]) // FAN], "n": [total.n],
                             "sums": [[Decimal(int(s)) for s in total.sums]], "scatter": [total.scatter.tobytes()]})

    left = vectors.rdd.getNumPartitions()
    partial = vectors.mapInArrow(gather, PARTIAL)
    while left > 1:
        partial = partial.groupBy("d", F.floor(F.col("part") / FAN).alias("p")).applyInPandas(merge, PARTIAL)
        left = -(-left // FAN)
    best = partial.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return moments_of(best[0]) if best else None


def moments_of(row) -> Moments:
    d = int(row.d)
    return Moments(int(row.n), np.array([int(s) for s in row.sums], dtype=object), np.frombuffer(row.scatter).reshape(d, d))


def eigen(a: np.ndarray, most_rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Float32 start, Ogita-Aishima iterations in extended precision, sub-solves
    for clustered eigenvalues.  The entry of largest size of every vector is
    positive.
    """
    d = len(a)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(d), np.eye(d)
    big = (a / size).astype(np.longdouble)
    big = (big + big.T) / 2
    x = np.linalg.eigh(big.astype(np.float32))[1].astype(np.longdouble)
    eps = np.finfo(np.longdouble).eps
    norm = np.linalg.norm(big.astype(np.float64), 2)
    moved = np.inf
    for _ in range(most_rounds):
        lam, step, near = correction(big, x, norm)
        x = x + x @ step
        for group in clusters(lam, near):
            x[:, group] = within(big, x[:, group])
        last, moved = moved, np.abs(step).max()
        if moved <= 4 * d * eps or last < 1e-8 and moved > last / 4:     # done, or down to the rounding of the products
            break
    lam = correction(big, x, norm)[0]
    order = np.argsort(-lam, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    x = x * np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return (lam[order] * size).astype(np.float64), x.astype(np.float64)


def correction(a: np.ndarray, x: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Ogita-Aishima step: eigenvalues, the matrix E of the update x + x E, and the gap below which two eigenvalues count as one cluster."""
    d = len(a)
    r = np.eye(d, dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2          # both symmetric to the last digit, or close eigenvalues would skew the vectors
    lam = np.diag(s) / (1 - np.diag(r))
    off = (s - np.diag(lam)).astype(np.float64)
    near = 2 * (np.linalg.norm(off, 2) + norm * np.linalg.norm(r.astype(np.float64), 2))
    near = max(near, CLOSE * norm)
    gap = lam[None, :] - lam[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + lam[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return lam, e, near


def clusters(lam: np.ndarray, near: float) -> list[np.ndarray]:
    """Index groups of two or more eigenvalues that follow each other within ``near``."""
    order = np.argsort(lam, kind="stable")
    cut = np.flatnonzero(np.diff(lam[order]) > near) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def within(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cluster's vectors turned to the eigenvectors of the shifted, projected matrix."""
    mid = (y * (a @ y)).sum() / (y * y).sum()
    t = y.T @ (a @ y - mid * y)
    size = np.abs(t).max()
    if not size:
        return y
    turn = np.linalg.eigh(((t + t.T) / (2 * size)).astype(np.float64))[1].astype(a.dtype)
    turn = turn + turn @ (np.eye(len(t), dtype=a.dtype) - turn.T @ turn) / 2      # the double-precision turn made orthogonal in extended precision
    return y @ turn


@dataclass
class Whitener:
    """Fitted state, bounded by the dimension: moments, eigenvalues, directions."""

    n: int
    sums: np.ndarray
    values: np.ndarray      # all eigenvalues, falling
    vectors: np.ndarray     # d x components
    trace: float
    scale: int
    offset: int


def fit(df: DataFrame, vec_col: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000) -> Whitener | None:
    """Whitener of all usable vectors; None where there are none."""
    m = moments(df, vec_col, scale, offset)
    if m is None:
        return None
    v = m.scatter / m.n
    values, vectors = eigen(v)
    trace = float(np.trace(v))
    keep = int((values[:components] > LEAST_SHARE * trace).sum())
    return Whitener(m.n, m.sums, values, vectors[:, :keep], trace, scale, offset)


def project(df: DataFrame, w: Whitener, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (id, ``deviation`` decimal, ``whitened`` array of all components) of the usable vectors."""
    id_type = df.schema[id_col].dataType.simpleString()
    d, axes = len(w.sums), w.vectors / np.sqrt(w.values[:w.vectors.shape[1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integer_blocks(batch.column(1), w.scale, w.offset):
                if x.shape[1] != d:
                    continue
                dev = deviations(x, w.n, w.sums)
                out = (dev.astype(np.float64) / float(w.n)) @ axes
                k = axes.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(out.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), squared_lengths(dev), lists], names=["id", "deviation", "whitened"])

    pairs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    return pairs.mapInArrow(run, f"id {id_type}, deviation decimal(38,0), whitened array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (divisor n) minus the identity; one aggregation.

    The values are centred when they are made (x less its mean, before the
    products), so their own means are rounding errors, taken off once more.
    """
    at = [F.col("whitened")[i] for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    got = projected.agg(F.count(F.lit(1)), *[F.avg(c) for c in at], *[F.avg(at[i] * at[j]) for i, j in pairs]).first()
    mean = got[1:1 + components]
    return max(abs(got[1 + components + k] - mean[i] * mean[j] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """One row per usable vector and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``deviation`` is the exact sum over the dimensions of (n x - S)^2 as
    decimal(38, 0).  Nulls, empty tables, odd lengths and repeats: see the
    module's docstring.
    """
    spark = df.sparkSession
    schema = (f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    w = fit(df, vec_col, components, scale, offset)
    if w is None or not w.vectors.shape[1]:
        return spark.createDataFrame([], schema)
    k = w.vectors.shape[1]
    rows = stage(project(df, w, id_col, vec_col), "whitened")
    error = identity_error(rows, k)
    share = F.array(*[F.lit(float(e / w.trace)) for e in w.values[:k]])
    return rows.select(F.col("id"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
