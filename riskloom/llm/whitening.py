"""Whitening of embeddings by an incremental eigendecomposition.

Each partition holds the spectrum of its own scatter matrix and takes its vectors in one by one: the vector less the
running mean is a rank-one change, whose new eigenvalues are the roots of a secular equation. Small entries and equal
eigenvalues are deflated first, and the changed eigenvectors come from a recomputed update vector (Loewner's formula), which keeps
them orthogonal. Spectra of partitions are combined, a bounded number at a time, by rank-one changes with each
eigenpair of the other and one with the difference of the means. The result is a basis close to the eigenvectors; a last distributed pass
projects all centred vectors on it and solves the small Rayleigh-Ritz problem, which gives them to double precision.

How it holds at scale: vectors never move and are read once per pass (lengths, spectra, refinement, check, result).
A partition gives one matrix of the vectors' length squared; matrices are folded ``vectors.FAN`` at a time. The driver
sees one matrix.

Defined cases: null vectors and those with null or non-finite entries, or entries beyond ``LARGEST`` after scaling,
are left out; so are vectors of another length than most have (of equally frequent lengths the greatest; empty vectors never count).
Components whose eigenvalue is not above ``FLAT`` times the largest cannot be whitened and are left out, so equal or single vectors give
no rows. No vector gives an empty result. Repeated rows each count; rows keep their id, null or not. Equal eigenvalues leave the choice
of their eigenvectors open, as it is. ``deviation`` is exact in up to 38 digits.
"""

import decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_batches
from riskloom.llm.vectors import fold, whole_rows

LARGEST = float(1 << 40)
FLAT = 1e-13
EPS = np.finfo(float).eps
_SPECTRUM = "slot bigint, n bigint, sums array<bigint>, lambdas array<double>, basis array<double>"
_MATRIX = "slot bigint, entries array<double>"


def secular_roots(poles, z, rho):
    """Distances ``poles[i] - root[j]`` as a matrix [j, i], and the roots, of 1/rho + sum z^2 / (poles - root) = 0.

    ``poles`` rise strictly, no ``z`` is zero. Every root is sought as an offset from its nearer pole, by interpolation
    with the two poles beside it, inside a bracket that shrinks.
    """
    count = len(poles)
    if count == 1:
        root = poles + rho * z * z
        return (poles - root).reshape(1, 1), root
    weight, rows = z * z, np.arange(count)
    width = np.append(np.diff(poles), rho * weight.sum())
    apart = poles[None, :] - poles[:, None]
    half = 1 / rho + (weight / (apart - width[:, None] / 2)).sum(axis=1)
    right = (half < 0) & (rows < count - 1)
    origin = rows + right
    apart = poles[None, :] - poles[origin][:, None]
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, width / 2)
    high[-1] = width[-1]
    low[-1], high[-1] = (width[-1] / 2, width[-1]) if half[-1] < 0 else (0.0, width[-1] / 2)
    offset = np.where(right, -width / 2, width / 2)
    left_pole = np.minimum(rows, count - 2)
    lower = (rows[None, :] <= left_pole[:, None]).astype(float)
    live = rows
    for _ in range(200):
        at, left, lo, hi = offset[live], left_pole[live], low[live], high[live]
        delta = apart[live] - at[:, None]
        part = z / delta
        terms = part * z
        value = 1 / rho + terms.sum(axis=1)
        going = np.abs(value) > 64 * EPS * (1 / rho + np.abs(terms).sum(axis=1))
        lo, hi = np.where(value < 0, at, lo), np.where(value < 0, hi, at)
        np.square(part, out=part)
        slope = part.sum(axis=1)
        below = np.einsum("ij,ij->i", part, lower[live])
        here = np.arange(len(live))
        one, two = delta[here, left], delta[here, left + 1]
        a = (one + two) * value - one * two * slope
        b = one * two * value
        c = value - one * below - two * (slope - below)
        last = live == count - 1
        c = np.where(last, np.abs(c), c)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            root = np.sqrt(np.abs(a * a - 4 * b * c))
            minus = (a <= 0) != last
            step = at + np.where(minus, (a - np.where(last, -root, root)) / (2 * c), 2 * b / (a + np.where(last, -root, root)))
        step = np.where((step > lo) & (step < hi), step, (lo + hi) / 2)
        going &= (step != at) & (step > lo) & (step < hi)
        moving = live[going]
        low[live], high[live], offset[moving] = lo, hi, step[going]
        live = moving
        if not len(live):
            break
    return apart - offset[:, None], poles[origin] + offset


def _deflate(values, basis, z, rho, tolerance):
    """Rotate nearly equal eigenvalues so that one of each pair keeps no share of ``z``; which entries stay open."""
    small = rho * np.abs(z) <= tolerance
    z[small] = 0.0
    open_ = np.flatnonzero(~small)
    if len(open_) > 1:
        a, b = z[open_[:-1]], z[open_[1:]]
        if (np.diff(values[open_]) * np.abs(a * b) <= tolerance * (a * a + b * b)).any():
            before = open_[0]
            for here in open_[1:]:
                length = np.hypot(z[before], z[here])
                cos, sin = z[here] / length, -z[before] / length
                if abs((values[here] - values[before]) * cos * sin) <= tolerance:
                    z[before], z[here] = 0.0, length
                    left, other = basis[:, before].copy(), basis[:, here].copy()
                    basis[:, before], basis[:, here] = cos * left + sin * other, cos * other - sin * left
                    low, high = values[before], values[here]
                    values[before] = low * cos * cos + high * sin * sin
                    values[here] = low * sin * sin + high * cos * cos
                before = here
    return np.flatnonzero(z)


def rank_one(values, basis, vector, weight):
    """Eigenvalues, rising, and eigenvectors of ``basis diag(values) basis' + weight vector vector'``, ``weight >= 0``."""
    z = vector @ basis
    size = z @ z
    if weight * size == 0:
        return values, basis
    z, rho, values, basis = z / np.sqrt(size), weight * size, values.copy(), basis.copy()
    open_ = _deflate(values, basis, z, rho, 8 * EPS * max(values[-1], rho))
    if len(open_):
        # Rotations may have changed the order of nearly equal ones.
        open_ = open_[np.argsort(values[open_], kind="stable")]
        poles, share = values[open_], z[open_]
        delta, roots = secular_roots(poles, share, rho)
        between = poles[:, None] - poles[None, :]
        np.fill_diagonal(between, 1.0)
        share = np.sign(share) * np.sqrt(np.abs(np.prod(-delta / between, axis=0)))
        turn = (share / delta).T
        turn /= np.sqrt((turn * turn).sum(axis=0))
        basis[:, open_] = basis[:, open_] @ turn
        values[open_] = roots
    order = np.argsort(values, kind="stable")
    return np.maximum(values[order], 0.0), basis[:, order]


def take_in(state, x):
    """The state (count, integer sums, eigenvalues, eigenvectors) with one more integer vector."""
    n, sums, values, basis = state
    if n:
        values, basis = rank_one(values, basis, x - sums / n, n / (n + 1))
    return n + 1, sums + x, values, basis


def combine(a, b):
    """The state of both lists together."""
    if a[0] < b[0]:
        a, b = b, a
    n, sums, values, basis = a
    for value, vector in zip(b[2], b[3].T):
        values, basis = rank_one(values, basis, vector, value)
    values, basis = rank_one(values, basis, sums / n - b[1] / b[0], n * b[0] / (n + b[0]))
    return n + b[0], sums + b[1], values, basis


def integers(column, size, scale):
    """Places and floored entries of the vectors that count."""
    places, values = whole_rows(column, size)
    values = np.floor(values * scale)
    fits = (np.abs(values) <= LARGEST).all(axis=1)
    return places[fits], values[fits].astype(np.int64)


def common_size(vectors: DataFrame):
    """The length that most vectors have, the greatest of equally frequent ones; None without vectors."""
    rows = (vectors.where("size(vector) > 0 and forall(vector, x -> x is not null and abs(x) < double('Infinity'))")
            .groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect())
    return rows[0]["size"] if rows else None


def spectrum(vectors: DataFrame, size, scale):
    """Count, sums, eigenvalues and eigenvectors of all vectors' scatter, as one state; None without vectors."""
    def run(batches):
        state = 0, np.zeros(size, np.int64), np.zeros(size), np.eye(size)
        for batch in batches:
            for x in integers(batch.column(0), size, scale)[1]:
                state = take_in(state, x)
        if state[0]:
            row = {"slot": TaskContext.get().partitionId(), **_as_row(state)}
            yield pa.RecordBatch.from_pylist([row], schema=_arrow(_SPECTRUM))

    def merge(rows):
        state = _as_state(rows[0])
        for row in rows[1:]:
            state = combine(state, _as_state(row))
        return _as_row(state)

    rows = fold(map_batches(vectors.select("vector"), run, _SPECTRUM), merge, "spectra").collect()  # one row
    return _as_state(rows[0].asDict()) if rows else None


def _as_row(state):
    return {"n": state[0], "sums": state[1].tolist(), "lambdas": state[2].tolist(),
            "basis": state[3].ravel().tolist()}


def _as_state(row):
    size = len(row["sums"])
    return row["n"], np.array(row["sums"], np.int64), np.array(row["lambdas"]), np.array(row["basis"]).reshape(size, size)


def _arrow(ddl):
    kinds = {"bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])


def projected_products(vectors: DataFrame, size, scale, n, sums, basis) -> np.ndarray:
    """Sum of outer products of the centred vectors' projections on the columns of ``basis``."""
    def run(batches):
        total = np.zeros((basis.shape[1],) * 2)
        for batch in batches:
            rows = centred(integers(batch.column(0), size, scale)[1], n, sums) / n @ basis
            total += rows.T @ rows
        yield pa.RecordBatch.from_pylist([{"slot": TaskContext.get().partitionId(), "entries": total.ravel().tolist()}],
                                         schema=_arrow(_MATRIX))

    def merge(rows):
        return {"entries": np.sum([r["entries"] for r in rows], axis=0).tolist()}

    row = fold(map_batches(vectors.select("vector"), run, _MATRIX), merge, "products").collect()[0]  # one row
    return np.array(row.entries).reshape((basis.shape[1],) * 2)


def centred(x, n, sums):
    """``n x - sums`` exactly: longs where they hold it, else Python integers."""
    if len(x) and float(n) * float(np.abs(x).max()) + float(np.abs(sums).max()) >= 2.0 ** 62:
        return x.astype(object) * n - sums.astype(object)
    return x * n - sums


def deviations(apart):
    """Exact sums of squares of integer rows as Arrow decimals."""
    if not len(apart) or float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2.0 ** 62:
        exact = pa.array((apart * apart).sum(axis=1).astype(np.int64))
        return exact.cast(pa.decimal128(38, 0))
    exact = (apart.astype(object) ** 2).sum(axis=1)
    return pa.array([decimal.Decimal(int(v)) for v in exact], pa.decimal128(38, 0))


def whiten(table: DataFrame, components=32, scale=64, vec_id="vec_id", vector="embedding") -> DataFrame:
    """One row per vector that counts and component, by falling eigenvalue: its id, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``."""
    vectors = table.select(F.col(f"`{vec_id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    kind = vectors.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double,"
              " identity_error double")
    size = common_size(vectors)
    state = spectrum(vectors, size, scale) if size else None
    axes = None
    if state:
        n, sums, _, basis = state
        basis = np.linalg.qr(basis)[0]
        ritz, turn = np.linalg.eigh(projected_products(vectors, size, scale, n, sums, basis) / n)
        ritz, axes = ritz[::-1], (basis @ turn)[:, ::-1]
        used = int((ritz[:components] > max(FLAT * ritz[0], 0)).sum())
        axes = axes[:, :used] / np.sqrt(ritz[:used])
    if axes is None or not axes.shape[1]:
        empty = table.sparkSession.createDataFrame([], schema)
        return empty.withColumnRenamed("id", vec_id)
    error = float(np.abs(projected_products(vectors, size, scale, n, sums, axes) / n - np.eye(used)).max())
    explained = ritz[:used] / ritz.sum()

    def run(batches):
        for batch in batches:
            places, x = integers(batch.column(1), size, scale)
            apart = centred(x, n, sums)
            rows = (apart / n).astype(float) @ axes
            again = pa.array(np.repeat(np.arange(len(x)), used))
            yield pa.record_batch([
                batch.column(0).take(pa.array(places)).take(again), pa.array(np.tile(np.arange(1, used + 1), len(x)), pa.int32()),
                pa.array(np.full(len(again), n)), deviations(apart).take(again), pa.array(rows.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(again), error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_batches(vectors, run, schema).withColumnRenamed("id", vec_id)
