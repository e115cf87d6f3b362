"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Every entry c becomes the integer x = floor(``SCALE`` * c) + ``OFFSET``. With n
rows and the exact sums S of every dimension, the matrix A has the rows
(n*x - S) / n: centred in integers before anything is multiplied.

Each Lanczos step is an alternation of two distributed products, made in one
pass over the rows:

* A v for the newest right vector v, orthogonalised against all left vectors;
* Aᵀu for the left vector u this gives, orthogonalised against all right vectors.

Right vectors have one entry a dimension and stay on the driver. A left vector
has one entry a row; it is held as u = A w with a w of one entry a dimension,
so a row's entry is made from the row when it is needed: the n-vectors are
neither stored nor moved, and a lost task is simply run again. Every product
returns one row of sums a task, added up by key before it reaches the driver:
what arrives has as many numbers as there are dimensions and steps.

The singular values of the small (bi)diagonal matrix are sqrt(n) times the
deviations along the components, and its right vectors make the components.
When all wanted ones have converged, a random direction is taken up as the
next right vector, so that further components of a repeated eigenvalue, which
one Krylov space cannot hold, are found too; the steps end when the first
component that is not wanted has converged as well, or the space is used up.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries take no part; nor do those whose length is not the commonest one (of
equally common ones the longest); rows that repeat an id, or have none, each
count and are returned; x is held within ±2^62; directions without variance
are no components, so a table of equal rows, of one row, or an empty one gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import drop_stored, stored

SCALE, OFFSET = 1024, 100_000
LIMIT = float(1 << 62)
CONVERGED = 1e-13  # residual of a wanted pair, in units of the largest singular value
SEPARATED = 1e-2  # residual of the first unwanted pair, in units of its distance to the wanted ones
LOW_BITS = 24


@dataclass(frozen=True)
class Fit:
    """What the rows say: count, exact sums, largest entry, eigenvalues, components (one a row), trace."""
    n: int
    sums: list[int]
    largest: int
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    steps: int


def integer_rows(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Stored (id, x: array<long>): the rows that take part."""
    v = F.col(f"`{vec_col}`").cast("array<double>")

    def whole(c):
        x = F.floor(F.least(F.greatest(c * F.lit(float(SCALE)), F.lit(-LIMIT)), F.lit(LIMIT))) + F.lit(OFFSET).cast("long")
        return x.cast("long")

    rows = (df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
            .where("v is not null and size(v) > 0")
            .where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
            .select("id", F.transform("v", whole).alias("x")))
    rows = stored(rows, "whiten-rows")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    out = rows.where(F.size("x") == F.lit(common["d"] if common else 0))
    out._stored_path = rows._stored_path
    return out


def _matrix(column: pa.ListArray) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _spread(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    """n*x - S, exactly: 64-bit integers where they hold it, else Python's."""
    if 2 * n * max(largest, 1) < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int], largest: int) -> np.ndarray:
    return _spread(x, n, sums, largest).astype(np.float64) / n


def _totals(rows: DataFrame, work, kind: str) -> dict[int, float]:
    """The sum of the vectors that ``work`` makes of each batch's matrix, added by task, then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = work(_matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist())], names=["k", "s"])

    each = rows.select("x").mapInArrow(run, f"k int, s {kind}")
    s = F.sum(F.col("s").cast("decimal(38,0)")) if kind == "long" else F.sum("s")
    return {r["k"]: r["s"] for r in each.groupBy("k").agg(s.alias("s")).collect()}


def exact_sums(rows: DataFrame) -> tuple[int, list[int], int]:
    """(n, S of every dimension, largest absolute entry) as exact integers."""

    def work(x):
        # High and low parts are summed apart, so that no sum of a task leaves 64 bits.
        high, low = x >> LOW_BITS, x & ((1 << LOW_BITS) - 1)
        return np.concatenate([[len(x)], high.sum(axis=0), low.sum(axis=0)]).astype(np.int64)

    got = _totals(rows, work, "long")
    if not got:
        return 0, [], 0
    d = (len(got) - 1) // 2
    sums = [(int(got[1 + i]) << LOW_BITS) + int(got[1 + d + i]) for i in range(d)]
    top = rows.agg(F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("m")).first()["m"]
    return int(got[0]), sums, int(top)


def fit(rows: DataFrame, wanted: int = 8, seed: int = 1) -> Fit:
    """The leading components of the rows' covariance."""
    n, sums, largest = exact_sums(rows)
    d = len(sums)
    none = Fit(n, sums, largest, np.zeros(0), np.zeros((0, d)), 0.0, 0)
    if n < 2:
        return none

    def products(w, basis) -> tuple[np.ndarray, np.ndarray, float]:
        """Uᵀ(A w), Aᵀ(A w) and |A w|², in one pass over the rows."""
        def work(x):
            a = _centred(x, n, sums, largest)
            z = a @ w
            return np.concatenate([[z @ z], (a @ basis).T @ z, a.T @ z])

        got = _totals(rows, work, "double")
        out = np.array([got[i] for i in range(len(got))])
        k = basis.shape[1]
        return out[1:1 + k], out[1 + k:], float(out[0])

    def variance(x):
        a = _centred(x, n, sums, largest)
        return np.array([np.einsum("ij,ij->", a, a)])

    trace = _totals(rows, variance, "double")[0] / n
    if trace <= 0:
        return none

    rng = np.random.default_rng(seed)
    right, left, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # V, W with U = A W, and Aᵀ U
    small = np.zeros((0, 0))
    floor = np.sqrt(trace * n) * 1e-14  # below this a length is rounding

    def orthogonal(v):
        for _ in range(2):
            v = v - right @ (right.T @ v)
        return v

    def fresh():
        for _ in range(20):
            v = orthogonal(rng.standard_normal(d))
            if np.linalg.norm(v) > 1e-6:
                return v / np.linalg.norm(v)
        return None

    v, probing = fresh(), False
    while v is not None:
        right = np.column_stack([right, v])
        k = right.shape[1] - 1
        c = back.T @ v  # Uᵀ(A v), as Aᵀ U is at hand
        w = v - left @ c
        c2, g, square = products(w, left)  # c2: what rounding left of the left vectors
        alpha = np.sqrt(max(square - float(c2 @ c2), 0.0))
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k], grown[:k, k] = small, c + c2
        if alpha > floor:
            left = np.column_stack([left, (w - left @ c2) / alpha])
            back = np.column_stack([back, (g - back @ c2) / alpha])
            grown[k, k] = alpha
        else:  # A v lies in the space of the left vectors
            left, back = np.column_stack([left, np.zeros(d)]), np.column_stack([back, np.zeros(d)])
        small = grown
        p, sigma, qt = np.linalg.svd(small)
        residual = np.linalg.norm(back @ p - (right @ qt.T) * sigma, axis=0)
        done = k + 1 >= wanted and bool((residual[:wanted] <= CONVERGED * sigma[0]).all())
        if k + 1 == d:
            break
        if done and probing and k + 1 > wanted and residual[wanted] <= SEPARATED * (sigma[wanted - 1] - sigma[wanted]):
            break
        r = orthogonal(back[:, k])
        if (done and not probing) or np.linalg.norm(r) <= floor:
            probing, v = probing or done, fresh()
        else:
            v = r / np.linalg.norm(r)
    keep = min(wanted, int((sigma > max(floor, sigma[0] * np.sqrt(d * np.finfo(float).eps) * 1e-4)).sum()))
    components = (right @ qt.T)[:, :keep].T
    components /= np.linalg.norm(components, axis=1, keepdims=True)
    return Fit(n, sums, largest, sigma[:keep] ** 2 / n, components, trace, small.shape[0])


def identity_error(rows: DataFrame, f: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(f.eigenvalues)
    if not k:
        return 0.0
    turn = (f.components / np.sqrt(f.eigenvalues)[:, None]).T

    def white(x):
        return _centred(x, f.n, f.sums, f.largest) @ turn

    got = _totals(rows, lambda x: white(x).sum(axis=0), "double")
    mean = np.array([got[i] for i in range(k)]) / f.n

    def moments(x):
        y = white(x) - mean
        return (y.T @ y).ravel()

    got = _totals(rows, moments, "double")
    cov = np.array([got[i] for i in range(k * k)]).reshape(k, k) / f.n
    return float(np.abs(cov - np.eye(k)).max())


def whitened(rows: DataFrame, f: Fit) -> DataFrame:
    """(id, deviation: decimal, whitened: array<double>): every row on the components, in units of their deviations."""
    turn = (f.components / np.sqrt(f.eigenvalues)[:, None]).T if len(f.eigenvalues) else np.zeros((len(f.sums), 0))
    n, sums, largest = f.n, f.sums, f.largest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            s = _spread(_matrix(b.column(1)), n, sums, largest)
            y = (s.astype(np.float64) / n) @ turn
            widest = int(max(abs(s.max()), abs(s.min())))
            exact = s if widest * widest * s.shape[1] < 1 << 62 else s.astype(object)
            dev = pa.array([int(t) for t in (exact * exact).sum(axis=1)], pa.decimal128(38, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * turn.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), dev, lists], names=["id", "deviation", "whitened"])

    return rows.select("id", "x").mapInArrow(run, "id long, deviation decimal(38,0), whitened array<double>")


def whiten(df: DataFrame, wanted: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each row and component: id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is the exact sum over the dimensions of (n*x - S)^2.
    """
    rows = integer_rows(df, id_col, vec_col)
    f = fit(rows, wanted)
    error = identity_error(rows, f)
    share = F.array(*[F.lit(float(e / f.trace)) for e in f.eigenvalues]) if len(f.eigenvalues) else F.array().cast("array<double>")
    done = stored(whitened(rows, f), "whiten-result")
    drop_stored(rows)
    out = done.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select("id", (F.col("at") + 1).cast("int").alias("component"), F.lit(f.n).cast("long").alias("n"), "deviation",
                      "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
