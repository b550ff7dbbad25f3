"""Whitening of embeddings by block Jacobi-Davidson (operator 12).

The covariance is never formed. All that is known of it are products with a few vectors: every task
centres its rows, multiplies them by the vectors, then by their own transpose, and the sums of the
tasks' products are added up. The largest eigenvalues come from a small search space:

1. Rayleigh-Ritz in the space gives the best approximations and their residuals;
2. approximations whose residual is as small as double precision allows are locked: the space is kept
   orthogonal to them from then on;
3. for the others the correction equation, projected away from all locked and present
   approximations, is solved roughly by MINRES, all of them in step so that one pass over the data
   serves the whole block; the corrections widen the space, which is cut back to its best vectors
   when it is full.

The driver holds the search space (width times a few dozen numbers) and sums of that size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ship
from barloom.session import materialize

SCALE, SHIFT = 64, 1_000_000
#: Entries whose scaled size is beyond this count as not finite.
HUGE = float(1 << 52)
COMPONENTS = 16
#: Search space in multiples of the wanted number, steps of an inner solution, rounds at most.
SPACE, INNER, ROUNDS = 4, 6, 200
#: Residuals are small enough at this many units of the last place of the largest eigenvalue.
ULPS = 64
SEED = 12
EPS = np.finfo(np.float64).eps

Product = Callable[[np.ndarray], np.ndarray]


def usable(vector: Column) -> Column:
    """Not null or empty, no null, non-finite or huge entry."""
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < HUGE))
    return F.coalesce(fits & (F.size(vector) > 0), F.lit(False))


def scaled(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): the usable rows' vectors as whole numbers; of the width that most rows have."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    held = vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).where(usable(F.col("v")))
    whole = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    held = materialize(held.select("id", whole.alias("x")), "scaled")
    widths = held.groupBy(F.size("x").alias("w")).count().orderBy(F.desc("count"), "w").first()
    return held.where(F.size("x") == (widths.w if widths else 0))


def rows_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def summed(fit: DataFrame, shape: tuple[int, int], work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of ``work`` of a batch of rows, an array of ``shape``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(rows_of(batch))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "value"])

    parts = fit.mapInArrow(run, "at long, value double")
    got = parts.groupBy("at").agg(F.sum("value").alias("value")).toArrow()  # rows: the size of the array
    out = np.zeros(shape[0] * shape[1])
    out[got.column("at").to_numpy()] = got.column("value").to_numpy()
    return out.reshape(shape)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean, from whole numbers: exact up to one rounding while n * x fits a long."""
    if n <= (1 << 62) // (abs(x).max() + abs(sums).max() // max(1, n) + 1):
        return (n * x - sums) / n
    base = np.array([int(s) // n for s in sums.tolist()])
    return (x - base) - np.array([(int(s) - int(b) * n) / n for s, b in zip(sums.tolist(), base.tolist())])


def orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """The part of ``new`` outside ``against``, orthonormal; dependent directions are left out."""
    for _ in range(2):
        new = new - against @ (against.T @ new)
    kept = []
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(2):
            for other in kept:
                column = column - other * (other @ column)
            column = column - against @ (against.T @ column)
        left = np.linalg.norm(column)
        if left > 1e-8 * max(size, 1e-300) and left > 1e-300:
            kept.append(column / left)
    return np.array(kept).T if kept else np.zeros((len(new), 0))


def corrections(product: Product, values: np.ndarray, residuals: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Rough solutions t of P (V - value) P t = -residual, P projecting away from ``outside``: MINRES for
    every column, each with its own value, in step."""

    def project(y: np.ndarray) -> np.ndarray:
        for _ in range(2):
            y = y - outside @ (outside.T @ y)
        return y

    b = project(-residuals)
    beta = np.linalg.norm(b, axis=0)
    target = beta.copy()
    safe = lambda y: np.where(np.abs(y) > 1e-300, y, 1)
    v_old, v = np.zeros_like(b), b / safe(beta)
    t, d_old, d_older = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c, s, c_old, s_old = (np.ones(len(beta)), np.zeros(len(beta)), np.ones(len(beta)), np.zeros(len(beta)))
    phi, beta_k = beta.copy(), np.zeros(len(beta))
    for _ in range(INNER):
        w = project(product(v) - values * v) - beta_k * v_old
        alpha = (v * w).sum(0)
        w = project(w - alpha * v)
        beta_next = np.linalg.norm(w, axis=0)
        # Two earlier rotations act on the new column of the tridiagonal matrix, a third one ends it.
        r3, r2 = s_old * beta_k, c_old * c * beta_k + s * alpha
        r1_bar = c * alpha - c_old * s * beta_k
        r1 = np.hypot(r1_bar, beta_next)
        c_new, s_new = np.where(r1 > 1e-300, r1_bar / safe(r1), 1), np.where(r1 > 1e-300, beta_next / safe(r1), 0)
        d = (v - r2 * d_old - r3 * d_older) / safe(r1)
        t = t + c_new * phi * d
        phi = -s_new * phi
        d_older, d_old = d_old, d
        c_old, s_old, c, s = c, s, c_new, s_new
        v_old, v, beta_k = v, w / safe(beta_next), beta_next
        if (np.abs(phi) <= 1e-3 * target).all():
            break
    return np.where(np.linalg.norm(t, axis=0) > 0, t, b)


def largest(product: Product, width: int, wanted: int, inner: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix known by its products, the ``wanted``
    largest in falling order. Raises if the residuals do not reach double precision."""
    rng = np.random.default_rng(SEED)
    locked, locked_values = np.zeros((width, 0)), np.zeros(0)
    most = min(width, max(SPACE * wanted, wanted + 2))
    space = orthonormal(rng.standard_normal((width, wanted)), locked)
    image = product(space)
    best, stalled = np.inf, 0
    for _ in range(ROUNDS):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        open_ = min(wanted - locked.shape[1], space.shape[1])
        residuals = image[:, :open_] - space[:, :open_] * values[:open_]
        # What locked vectors take out of a residual is their own error, not this vector's.
        residuals = residuals - locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        top = max(np.abs(values).max(initial=0), np.abs(locked_values).max(initial=0))
        whole = space.shape[1] + locked.shape[1] == width
        enough = ULPS * EPS * top
        # A space that is complete cannot grow; neither does a residual shrink below its rounding.
        stalled = stalled + 1 if sizes.max(initial=0) >= 0.5 * best else 0
        best = min(best, sizes.max(initial=0))
        if whole or stalled >= 4:
            enough *= 16
        done = int(np.argmin(np.append(sizes <= enough, False)))
        if done:
            locked = np.hstack([locked, space[:, :done]])
            locked_values = np.append(locked_values, values[:done])
            space, image = space[:, done:], image[:, done:]
            residuals, values = residuals[:, done:], values[done:]
            best, stalled = np.inf, 0
        if locked.shape[1] == wanted:
            order = np.argsort(-locked_values, kind="stable")
            return locked_values[order], locked[:, order]
        open_ = min(wanted - locked.shape[1], space.shape[1])
        if space.shape[1] + open_ > most - locked.shape[1]:
            keep = max(open_, min(space.shape[1], most - locked.shape[1] - open_))
            space, image = space[:, :keep], image[:, :keep]
        outside = np.hstack([locked, space[:, :open_]])
        step = corrections(product, values[:open_], residuals[:, :open_], outside) if open_ else np.zeros((width, 0))
        basis = np.hstack([locked, space])
        fresh = orthonormal(step, basis)
        if fresh.shape[1] == 0:
            fresh = orthonormal(rng.standard_normal((width, wanted)), basis)[:, : max(1, width - basis.shape[1])]
        if fresh.shape[1]:
            space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"residuals {sizes} do not reach double precision")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: the id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    Vectors become whole numbers ``floor(64 * c) + 1000000``. Each distinct one counts once in the
    covariance (divisor n); ``deviation`` is the sum of (n * x - S)^2 over the dimensions, exact (null
    where it does not fit a long); ``whitened`` the projection on the component over the square root of
    its eigenvalue, ``explained`` the eigenvalue over the trace and ``identity_error`` the largest entry of
    the whitened covariance less the identity. Rows whose vector is null, empty, of another width than
    most rows, or holds null, non-finite or huge entries take no part. Components without variance do not
    appear (a table of one distinct vector gives no rows). Repeated rows are whitened each; other columns
    are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = scaled(vectors, id_col, vector_col)
    fit = materialize(rows.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit")
    schema = f"`{id_col}` {dict(vectors.dtypes)[id_col]}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    totals = fit.select(F.posexplode("x").alias("at", "value")).groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    got = sorted(totals.collect())  # a row per dimension
    if not got or got[0].n < 2:
        return spark.createDataFrame([], schema)
    n, width, exact_sums = got[0].n, len(got), [int(r.s) for r in got]
    sums = np.array(exact_sums, np.int64 if max(map(abs, exact_sums)) < 1 << 62 else object)

    def product(block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            z = centred(x, n, sums)
            return z.T @ (z @ block) / n

        return summed(fit, block.shape, work)

    wanted = min(components, width, n - 1)
    trace = float(summed(fit, (1, 1), lambda x: np.array([[(centred(x, n, sums) ** 2).sum() / n]]))[0, 0])
    values, basis = largest(product, width, wanted)
    there = values > trace * EPS * width
    values, basis = values[there], basis[:, there]
    count = len(values)
    project = basis / np.sqrt(values)
    mean = summed(fit, (1, count), lambda x: (centred(x, n, sums) @ project).sum(0, keepdims=True) / n)

    def squares(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ project - mean
        return w.T @ w / n

    error = float(np.abs(summed(fit, (count, count), squares) - np.eye(count)).max())
    explained = values / trace

    def deviations(x: np.ndarray) -> list[int | None]:
        most = n * abs(int(abs(x).max())) + max(map(abs, exact_sums))
        if most * most * width < 1 << 63:
            return ((n * x - sums) ** 2).sum(1).tolist()
        held = [sum((n * c - s) ** 2 for c, s in zip(row, exact_sums)) for row in x.tolist()]
        return [h if h < 1 << 63 else None for h in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                batch = whole.slice(begin, 2048)
                x, m = rows_of(batch), batch.num_rows
                owner = pa.array(np.repeat(np.arange(m), count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(owner), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * count, n)), pa.array(deviations(x), pa.int64()).take(owner),
                        pa.array((centred(x, n, sums) @ project).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * count, error)),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, schema)
