"""Embedding whitening by principal components of exact integer covariances.

Entries become integers x = floor(64 * c) + 1000000. A task cuts its vectors into blocks of rows, shifts every
dimension of a block by its smallest entry and packs each bit of the rest across rows into 64-bit words; the
cross-product of two dimensions is the sum of 2^(a+b) times the bits that plane a of one and plane b of the other
share. Blocks add up to counts, sums and cross-products that are exact integers, whatever the blocks. Spark adds them
by matrix entry; the driver gets one matrix (dimensions squared), centres it in integers and solves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import hidden, settle, shown

SCALE, OFFSET = 64, 1_000_000
# Larger entries have no place in sums of 2^38 rows that must fit decimal(38, 0).
LARGEST = 2.0 ** 42
BLOCK_ROWS = 8192
WHITE = ["component", "n", "deviation", "whitened", "explained", "identity_error"]


@dataclass(frozen=True)
class Fit:
    """What the fit list gives: n rows, sums of x - OFFSET, components as columns scaled to unit variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def _usable(embedding: Column) -> Column:
    """The vector as doubles; null if it is null or empty or has an entry that is null, not finite or too large."""
    v = embedding.cast("array<double>")
    return F.when((F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE >= LARGEST)), v)


def _integers(column: pa.Array, dimension: int) -> np.ndarray:
    """x - OFFSET of every vector; floor(64 c) is exact in doubles."""
    return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension) * SCALE).astype(np.int64)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of y[:, j] * y[:, k] (Python integers), by AND and popcount of bit planes."""
    rows, dims = y.shape
    low = [int(v) for v in y.min(axis=0)]
    u = (y - y.min(axis=0)).astype(np.uint64)
    bits = max(int(u.max()).bit_length(), 1)
    words = -(-rows // 64)
    planes = np.zeros((bits, dims, words), np.uint64)
    for b in range(bits):
        bit = np.zeros((dims, words * 64), np.uint8)
        bit[:, :rows] = (u.T >> np.uint64(b)) & np.uint64(1)
        planes[b] = np.packbits(bit, axis=1, bitorder="little").view(np.uint64)
    exact = 2 * bits + rows.bit_length() >= 62
    total = np.zeros((dims, dims), object if exact else np.int64)
    for a in range(bits):
        for b in range(a + 1):
            shared = np.empty((dims, dims), np.int64)
            for j in range(dims):
                shared[j] = np.bitwise_count(planes[a, j] & planes[b]).sum(axis=1, dtype=np.int64)
            both = shared + shared.T if a != b else shared
            total += (both.astype(object) if exact else both) << (a + b)
    plain = [int(s) for s in u.sum(axis=0, dtype=np.uint64)] if bits + rows.bit_length() < 63 else [sum(map(int, c)) for c in u.T]
    # sum (u + s)(v + t) = sum uv + t sum u + s sum v + rows s t
    low_, plain_ = np.array(low, object), np.array(plain, object)
    return (total.astype(object) + np.outer(plain_, low_) + np.outer(low_, plain_) + rows * np.outer(low_, low_))


def _moments(vectors: DataFrame) -> DataFrame:
    """_n (dimension), i, j, total: exact sums by matrix entry. i = j = -1: rows; i = -1: sums of dimension j;
    else cross-products for i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def add(d: int, y: np.ndarray) -> None:
            old = held.setdefault(d, [0, np.zeros(d, object), np.zeros((d, d), object)])
            old[0] += len(y)
            old[1] += np.array([int(s) for s in y.sum(axis=0)], object)
            old[2] += cross_products(y)

        for batch in batches:
            sizes = batch.column("_n").to_numpy()
            for d in np.unique(sizes).tolist():
                column = batch.column("_v").filter(pa.array(sizes == d))
                step = max(64, min(BLOCK_ROWS, 2 ** 22 // d))
                for at in range(0, len(column), step):
                    add(d, _integers(column.slice(at, step), d))
        for d, (n, sums, cross) in held.items():
            i, j = np.triu_indices(d)
            one = np.full(d + 1, -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i) + d + 1, d, np.int32)), pa.array(np.concatenate([one, i]).astype(np.int32)),
                 pa.array(np.concatenate([np.arange(-1, d), j]).astype(np.int32)),
                 pa.array([str(v) for v in [n, *sums, *cross[i, j]]])], names=["_n", "i", "j", "total"])

    parts = vectors.mapInArrow(run, "_n int, i int, j int, total string")
    return parts.groupBy("_n", "i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def fit(vectors: DataFrame, embedding: str = "embedding", components: int = 32) -> tuple[int, Fit | None]:
    """(dimension, fit) of the usable vectors of the commonest dimension (the smaller one on a tie); (0, None)
    without any. Components have eigenvalues above rounding: fewer than asked for where vectors span fewer."""
    usable = vectors.select(_usable(F.col(embedding)).alias("_v")).where(F.col("_v").isNotNull()).withColumn("_n", F.size("_v"))
    moments = settle(_moments(usable), "whitening-moments")  # one matrix for every dimension that occurs
    sizes = moments.where("i = -1 and j = -1").orderBy(F.desc("total"), "_n").limit(1).collect()
    if not sizes:
        return 0, None
    d, n = sizes[0]["_n"], int(sizes[0]["total"])
    sums, cross = [0] * d, np.zeros((d, d), object)
    for r in moments.where(f"_n = {d} and j >= 0").collect():
        if r["i"] < 0:
            sums[r["j"]] = int(r["total"])
        else:
            cross[r["i"], r["j"]] = cross[r["j"], r["i"]] = int(r["total"])
    s = np.array(sums, object)
    centred = n * cross - np.outer(s, s)  # n^2 times the covariance, exact
    covariance = np.array([[float(v) for v in row] for row in centred]) / float(n) ** 2
    values, vectors_ = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    order = [k for k in order if values[k] > d * np.finfo(float).eps * max(values[order[0]], 0)][:components]
    axes = vectors_[:, order] / np.sqrt(values[order])
    trace = float(sum(centred[i, i] for i in range(d))) / float(n) ** 2
    error = np.abs(axes.T @ covariance @ axes - np.eye(len(order))).max(initial=0.0)
    return d, Fit(n, sums, axes, values[order] / trace if len(order) else np.empty(0), float(error))


def whiten(vectors: DataFrame, embedding: str = "embedding", components: int = 32) -> DataFrame:
    """One row per usable vector of vectors and component: its columns, then component, n, deviation, whitened,
    explained, identity_error (columns of these names are replaced).

    Rows whose vector is null, empty, of another than the commonest dimension, or has an entry that is null, not
    finite or of magnitude 2^36 and more, give nothing; so do vectors without any spread (no component) and
    empty tables. Repeated rows count and return as often as they stand. deviation is null beyond 64 bits.
    identity_error is that of the covariance of the projections, worked out from the exact covariance.
    """
    rest = [c for c in vectors.columns if c not in WHITE or c == embedding]
    rows = vectors.select([F.col(f"`{c}`") for c in rest])
    d, model = fit(rows, embedding, components)
    rows = rows.select(*hidden(rows))
    rows = rows.withColumn("_v", _usable(F.col(f"_in{rest.index(embedding)}"))).where(F.size("_v") == d)
    many = 0 if model is None else model.axes.shape[1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.array(model.sums, object)
        for batch in batches:
            column = batch.column("_v")
            y = _integers(column, d)
            bound = model.n * max(int(np.abs(y).max(initial=0)), 1) + max(abs(int(v)) for v in model.sums)
            if d * bound ** 2 < 2 ** 63:
                shift = model.n * y - sums.astype(np.int64)
                deviation = [int(v) for v in (shift * shift).sum(axis=1)]
            else:
                shift = model.n * y.astype(object) - sums
                deviation = [v if v < 2 ** 63 else None for v in (int((r * r).sum()) for r in shift)]
            white = (shift.astype(float) / model.n) @ model.axes
            kept = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_v"]
            names = [name for name in batch.schema.names if name != "_v"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(deviation, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))],
                names=[*names, "_deviation", "_white"])

    if not many:
        done = rows.where("false").drop("_v").withColumns({"_deviation": F.lit(0).cast("long"), "_white": F.array(F.lit(0.0))})
        model = Fit(0, [], np.empty((0, 0)), np.zeros(1), 0.0)
    else:
        done = rows.mapInArrow(run, f"{schema}, _deviation long, _white array<double>")
    done = done.select("*", F.posexplode("_white").alias("_at", "_one"))
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    return done.select(*shown(vectors.select([F.col(f"`{c}`") for c in rest])), (F.col("_at") + 1).cast("int").alias("component"),
                       F.lit(model.n).cast("long").alias("n"), F.col("_deviation").alias("deviation"), F.col("_one").alias("whitened"),
                       F.get(shares, F.col("_at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))


def whitened_components(vectors: DataFrame) -> DataFrame:
    """vec_id and the columns of whiten() for the first 32 components."""
    return whiten(vectors.select("vec_id", "embedding")).select("vec_id", *WHITE)
