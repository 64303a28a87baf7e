"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SCALE, SHIFT = 1024, 100_000
#: Bytes of a block of vectors.
BLOCK_BYTES = 1 << 20
BLOCKS = "size int, n int, ids array<bigint>, x binary"


def _pack(it):
    """(id, vector) -> blocks of equally long valid vectors, entries floor(SCALE * c) + SHIFT as 64-bit integers."""
    schema = pa.schema([("size", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int64())), ("x", pa.binary())])
    for batch in it:
        ids, vectors = batch.column(0), batch.column(1)
        known = np.flatnonzero(np.asarray(vectors.is_valid()))
        ids, vectors = ids.take(pa.array(known)), vectors.take(pa.array(known))
        entries = pc.fill_null(vectors.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
        end = np.cumsum(sizes)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
        good = bad[end] == bad[end - sizes] if sizes.size else np.zeros(0, bool)
        for size in np.unique(sizes[good]):
            rows = np.flatnonzero(good & (sizes == size))
            step = max(1, BLOCK_BYTES // (8 * max(int(size), 1)))
            for lo in range(0, rows.size, step):
                r = rows[lo:lo + step]
                c = entries[(end[r] - size)[:, None] + np.arange(size)] * SCALE
                if c.size and np.abs(c).max() >= 2.0 ** 62:
                    raise OverflowError("a vector entry is too large for a 64-bit integer")
                x = np.floor(c).astype("<i8") + SHIFT
                yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([r.size], pa.int32()),
                                                  pa.array([ids.take(pa.array(r)).to_pylist()], pa.list_(pa.int64())),
                                                  pa.array([x.tobytes()], pa.binary())], schema=schema)


def _matrices(it, size: int):
    """The blocks of a task as (ids, integer matrix)."""
    for batch in it:
        for ids, x in zip(batch.column(0), batch.column(1)):
            yield ids.values, np.frombuffer(x.as_buffer(), "<i8").reshape(-1, size)


def _sums(blocks: DataFrame, size: int, work, parts: int, kind: str = "double") -> np.ndarray:
    """Sum over all blocks of ``work(matrix)``, vectors of ``parts`` numbers: added up in each task, then by Spark."""
    def run(it):
        total = None
        for _, x in _matrices(it, size):
            got = work(x)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts)), pa.array(total)], names=["i", "v"])
    rows = blocks.select("ids", "x").mapInArrow(run, f"i long, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(parts, np.int64 if kind == "long" else np.float64)
    for r in rows:
        out[r.i] = r.v
    return out


def bidiagonalise(product, size: int, wanted: int, steps: int | None = None, tol: float = 4 * np.finfo(float).eps):
    """Leading right singular vectors of a tall matrix B: (values, vectors as columns).

    ``product(q, w)`` makes one pass over the rows of B and returns Bᵀ(Bq),
    (Bw)ᵀ(Bq) and |Bq|².  Left vectors are as long as B, so each is held as the
    combination u = Bw of the rows' entries and formed anew in the pass, next
    to the product Bq; full reorthogonalisation of both sides takes their
    products with Bq from the same pass, and Bᵀu of the corrected vector from
    those of the vectors taken away.  A second pass follows where most of a
    vector was taken away.  A zero diagonal or superdiagonal entry starts a new
    block from a vector orthogonal to all others.  ``size`` steps exhaust the
    space, so that equal eigenvalues are found as often as they occur; with
    ``steps`` it ends after so many, or earlier once the leading vectors are
    exact to ``tol``.
    """
    draw = np.random.default_rng(size)
    v = draw.standard_normal(size)
    right, left, images = np.zeros((size, 0)), np.zeros((size, 0)), np.zeros((size, 0))
    alphas, betas, beta, top = [], [], 0.0, 0.0

    def clear(x):
        for _ in range(2):
            x = x - right @ (right.T @ x)
        return x

    v /= np.linalg.norm(v)
    while True:
        q = v - beta * left[:, -1] if beta else v
        for _ in range(2):
            image, with_left, square = product(q, left)
            rest = square - with_left @ with_left
            q, image = q - left @ with_left, image - images @ with_left
            if rest > 0.5 * square or not square:
                break
        top = max(top, np.sqrt(square))
        alpha = np.sqrt(max(rest, 0.0))
        alpha = alpha if alpha > size * tol * top else 0.0
        u, image = (q / alpha, image / alpha) if alpha else (0 * q, 0 * image)
        right, left, images = (np.column_stack(x) for x in ((right, v), (left, u), (images, image)))
        alphas.append(alpha)
        r = clear(image - alpha * v) if alpha else 0 * v
        beta = np.linalg.norm(r)
        k = len(alphas)
        p, s, qt = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        settled = steps and k > wanted and beta * np.abs(p[-1, :wanted]).max() <= tol * s[0]
        if k == min(steps or size, size) or settled:
            return s[:wanted], right @ qt[:wanted].T
        if beta <= size * tol * top:
            beta, r = 0.0, clear(draw.standard_normal(size))
        v = clear(r) / np.linalg.norm(r)
        v /= np.linalg.norm(v)
        betas.append(beta)


def _exact_squares(d: np.ndarray) -> pa.Array:
    """Row sums of squares of 64-bit integers as decimals, exact at any size that 38 digits hold."""
    top = int(np.abs(d).max()) if d.size else 0
    if d.shape[1] * top * top < 2 ** 63:
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    low, high = d & 0x7FFFFFF, d >> 27  # d = high * 2^27 + low
    out = None
    for a, b, shift in ((high, high, 54), (high, low, 28), (low, low, 0)):
        part = (a.astype(object) * b.astype(object)).sum(axis=1) * 2 ** shift
        out = part if out is None else out + part
    from decimal import Context
    exact = Context(prec=76)
    return pa.array([exact.create_decimal(int(v)) for v in out], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, components: int = 8, steps: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Whitened coordinates of every valid vector, one row per vector and component.

    Columns: vec_id, component (from 1, by falling eigenvalue), n (vectors),
    deviation (decimal: sum over dimensions of (n*x - S)², exact), whitened,
    explained (share of the trace), identity_error (largest entry of the
    whitened covariance minus the identity).

    Vectors are packed into integer blocks once; each bidiagonalisation step is
    one pass over the blocks, whose sums of a few hundred numbers come to the
    driver.  Nothing that grows with the rows leaves the tasks.  By default there
    are as many steps as dimensions; ``steps`` bounds them for wide vectors.

    Null vectors and vectors with null or non-finite entries are dropped, and
    so are vectors shorter than the longest one (they lie in another space).
    Rows without an id and repeated rows are vectors like others.  Fewer
    dimensions than ``components`` give fewer components; a component without
    variance (equal vectors, or a single one) gets whitened 0.0.  A table
    without vectors, or with empty ones only, gives no rows.  Extra columns are
    ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    blocks = cut(rows.mapInArrow(_pack, BLOCKS), "blocks", "zstd")
    size = blocks.agg(F.max("size").alias("m")).first().m
    if not size:
        return vectors.sparkSession.createDataFrame([], schema)
    blocks = blocks.filter(F.col("size") == size)

    def count(x):
        return np.concatenate([[x.shape[0]], x.sum(axis=0)])

    n, *total = (int(v) for v in _sums(blocks, size, count, size + 1, "long"))
    mean = np.array([s / n for s in total])

    def product(q, w):
        k = w.shape[1]

        def step(x):
            b = (x - mean) / np.sqrt(n)
            u = b @ q
            return np.concatenate([u @ b, u @ (b @ w), [u @ u]])
        got = _sums(blocks, size, step, size + k + 1)
        return got[:size], got[size:size + k], got[-1]

    values, axes = bidiagonalise(product, size, min(components, size), steps)
    k = values.size
    live = values > 1e-12 * max(values[0], 1e-300)
    factors = np.where(live, axes / np.where(live, values, 1.0), 0.0)

    def spread(x):
        b = x - mean
        w = b @ factors
        return np.concatenate([[(b * b).sum()], w.sum(axis=0), (w.T @ w).ravel()])

    got = _sums(blocks, size, spread, 1 + k + k * k)
    trace, centre = got[0] / n, got[1:1 + k] / n
    error = float(np.abs(got[1 + k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max())
    explained = values ** 2 / trace if trace else np.zeros(k)
    sums = np.array(total, np.int64)

    def project(it):
        for ids, x in _matrices(it, size):
            m, top = x.shape[0], int(np.abs(x).max())
            if 2 * n * top < 2 ** 63:
                deviation = _exact_squares(n * x - sums)
            else:
                from decimal import Context
                far = ((n * x.astype(object) - np.array(total, object)) ** 2).sum(axis=1)
                deviation = pa.array([Context(prec=76).create_decimal(int(v)) for v in far], pa.decimal128(38, 0))
            of = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [ids.take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 deviation.take(of), pa.array(((x - mean) @ factors).ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return blocks.select("ids", "x").mapInArrow(project, schema)
