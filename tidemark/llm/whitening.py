"""Whitening of embeddings by QDWH spectral divide and conquer.

Entries become integers; the covariance of the distinct integer vectors is summed exactly, by
Spark, so it does not depend on how rows are dealt to tasks.  Its eigenvectors come from polar
decompositions: the unitary factor of the covariance less a shift has the eigenvalues 1 and -1,
which gives the projector on the invariant subspace beyond the shift.  The subspace and the one
across it are split again until every part is a single direction, or a part on which all
eigenvalues are equal.  The polar factor itself is found by the dynamically weighted Halley
iteration (Nakatsukasa and Higham).  Mean and directions, ``d * components`` numbers, are then
sent to the tasks, which project their rows; no row passes through the driver, which holds
``d * d`` numbers at most.

Defined results: a row whose vector is null, empty or holds a null, NaN or infinite entry is
left out, and so is one with another number of entries than most rows have (of equally many,
the greater number).  Entries beyond 2^40 in units count as 2^40.  Repeated rows are all
returned, but count once in mean and covariance.  Directions without variance have no
whitened value: where the vectors vary in fewer directions than asked for, there are fewer
components, and none for a single distinct vector or an empty table, which gives an empty
result.  Equal eigenvalues have some orthonormal basis of their subspace, the same for all
rows.  A ``deviation`` that does not fit a long is null.  Null ids stay; columns named in
``keep`` are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import stage

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
_LIMIT = 2**40
_EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What the tasks need: vectors are shifted by the integers ``shift`` and the remaining
    mean ``rest`` (less than one unit, so nothing is lost to rounding), then projected."""

    n: int
    shift: np.ndarray  # int64, the mean in whole units
    sums: list[int]  # sums of the shifted distinct vectors
    directions: np.ndarray  # d x k, unit eigenvectors
    values: np.ndarray  # k eigenvalues, falling
    trace: float
    identity_error: float = 0.0

    @property
    def rest(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# -- eigenvectors ----------------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix by the QDWH iteration."""
    size = len(a)
    x, low = a / np.linalg.norm(a), _EPS  # a bound that is too low costs a step or two
    eye = np.eye(size)
    for _ in range(30):
        d = np.cbrt(4 * max(0.0, 1 - low**2) / low**4)
        root = np.sqrt(1 + d)
        ca = root + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * root)) / 2
        cb = (ca - 1) ** 2 / 4
        cc = ca + cb - 1
        if cc > 100:  # by QR, which stands any condition
            q, _ = np.linalg.qr(np.vstack([np.sqrt(cc) * x, eye]))
            new = cb / cc * x + (ca - cb / cc) / np.sqrt(cc) * (q[:size] @ q[size:].T)
        else:
            new = cb / cc * x + (ca - cb / cc) * np.linalg.solve(eye + cc * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(1.0, low * (ca + cb * low**2) / (1 + cc * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if 1 - low < 10 * _EPS and moved < _EPS ** (1 / 3):
            break
    return x


def _parts(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift within the
    spectrum; None where all eigenvalues are equal to working precision."""
    size, mean = len(a), np.trace(a) / len(a)
    spread = np.linalg.norm(a - mean * np.eye(size))
    if spread <= size * _EPS * scale:
        return None
    rng, best = np.random.default_rng(size), None
    # The mean of the eigenvalues lies within them.  A shift that meets one of them has no
    # unitary factor there, so others near it follow.
    for step in (0.0, 0.11, -0.13, 0.031, -0.037, 0.0071, -0.0073):
        sign = polar(a - (mean + step * spread / size) * np.eye(size))
        above = (sign + np.eye(size)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < size:
            continue
        q, _ = np.linalg.qr(above @ rng.standard_normal((size, rank)), mode="complete")
        for _ in range(2):
            upper, lower = above @ q[:, :rank], q[:, rank:] - above @ q[:, rank:]
            q, _ = np.linalg.qr(np.hstack([upper, lower]))
        coupling = np.linalg.norm(q[:, :rank].T @ a @ q[:, rank:])
        if best is None or coupling < best[0]:
            best = coupling, q[:, :rank], q[:, rank:]
        if coupling <= 10 * size * _EPS * scale:
            break
    return best and best[1:]


def eigenvectors(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, with unit eigenvectors as columns.  Only
    parts that hold some of them are split further."""
    a = (a + a.T) / 2
    scale, found = np.linalg.norm(a), []

    def split(basis: np.ndarray) -> None:
        if sum(b.shape[1] for b in found) >= wanted:
            return
        block = basis.T @ a @ basis
        parts = _parts((block + block.T) / 2, scale) if basis.shape[1] > 1 else None
        if parts is None:
            found.append(basis)
        else:
            for part in parts:  # greater eigenvalues first
                split(basis @ part)

    split(np.eye(len(a)))
    vectors = np.hstack(found)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


# -- sums over the vectors ---------------------------------------------------------------


def _finite(vector: Column) -> Column:
    good = ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & good


def units(vector: Column) -> Column:
    """``floor(64 * c) + 1000000`` of every entry."""

    def unit(c: Column) -> Column:
        value = F.greatest(F.least(c * SCALE, F.lit(float(_LIMIT))), F.lit(-float(_LIMIT)))
        return F.floor(value).cast("long") + OFFSET

    return F.transform(vector.cast("array<double>"), unit)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _gram(x: np.ndarray) -> np.ndarray:
    """``x' x`` in integers: by doubles where every sum stays below 2^53, else at length."""
    top = int(np.abs(x).max(initial=0))
    if top * top * len(x) < 2**53:
        y = x.astype(float)
        return (y.T @ y).astype(np.int64)
    if top * top * len(x) < 2**63:
        return x.T @ x
    y = x.astype(object)
    return y.T @ y


def _exact_sums(fit: DataFrame, part, entries: int) -> list[int]:
    """Sums over all rows of the integers that ``part`` makes of a batch.  A task sends one row
    per entry, whatever it has read."""
    schema = "i int, v decimal(38,0)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(entries, dtype=object)
        for batch in batches:
            if len(batch):
                total = total + part(_matrix(batch)).astype(object)
        values = pa.array([int(v) for v in total], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(entries), pa.int32()), values], names=["i", "v"]
        )

    rows = fit.select("x").mapInArrow(run, schema).groupBy("i").agg(F.sum("v").alias("v"))
    total = [0] * entries
    for row in rows.collect():  # d * (d + 1) / 2 numbers at most
        total[row.i] = int(row.v)
    return total


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity.  Whitened
    vectors have mean 0 by construction; what rounding leaves of it is taken out."""
    k = len(model.values)
    project = _projector(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = project(_matrix(batch))
            total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(k * (k + 1)), pa.int32()), pa.array(total.ravel())], names=["i", "v"]
        )

    rows = fit.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    total = np.zeros(k * (k + 1))
    for row in rows.collect():
        total[row.i] = row.v
    total = total.reshape(k + 1, k) / model.n
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def _projector(model: Whitening):
    rest, shift = model.rest, model.shift
    weights = model.directions / np.sqrt(model.values)

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - shift).astype(float) - rest) @ weights

    return project


def usable(df: DataFrame, vec_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows that are whitened, as ``row`` (the columns to keep) and ``x`` (integers)."""
    vector = F.col(f"`{vec_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in keep] or [F.lit(0).alias("none")])
    rows = df.filter(_finite(vector.cast("array<double>")))
    counts = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = counts.orderBy(F.desc("n"), F.desc("d")).first()
    dimension = first.d if first else 0
    return rows.filter(F.size(vector) == dimension).select(row.alias("row"), units(vector).alias("x"))


def fit_whitening(
    df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS
) -> Whitening | None:
    """Mean, eigenvectors and eigenvalues of the distinct vectors; None without any."""
    # Copies meet before the shuffle, so a vector on many rows is one row per task.
    fit = stage(usable(df, vec_col).select("x").distinct(), "whitening")
    n = fit.count()
    if n == 0:
        return None
    d = len(fit.first().x)
    # Entries stay below 2^41, so the sums of a batch fit.
    sums = _exact_sums(fit, lambda x: x.sum(axis=0), d)
    shift = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    left = [s - n * int(c) for s, c in zip(sums, shift)]  # of the shifted vectors
    upper = np.triu_indices(d)
    # Centred to the unit before multiplying; what is left of the mean goes in integers.
    products = _exact_sums(fit, lambda x: _gram(x - shift)[upper], len(upper[0]))
    covariance = np.zeros((d, d))
    for i, j, p in zip(*upper, products):
        covariance[i, j] = covariance[j, i] = (n * p - left[i] * left[j]) / n**2
    values, directions = eigenvectors(covariance, min(components, d))
    trace = float(np.trace(covariance))
    varied = values > d * _EPS * trace
    model = Whitening(n, shift, left, directions[:, varied], values[varied], trace)
    error = _identity_error(fit, model) if varied.any() else 0.0
    return Whitening(n, shift, left, model.directions, model.values, trace, error)


def _deviations(y: np.ndarray, model: Whitening) -> list[int | None]:
    """Per row the exact sum of ``(n * x - S)^2``."""
    sums = np.array(model.sums, dtype=object)
    bound = model.n * int(np.abs(y).max(initial=0)) + max(map(abs, model.sums), default=0)
    if bound * bound * y.shape[1] < 2**63:
        off = model.n * y - sums.astype(np.int64)
        return np.einsum("ij,ij->i", off, off).tolist()
    off = model.n * y.astype(object) - sums
    return [v if v < 2**63 else None for v in (off * off).sum(axis=1)]


def whiten(
    df: DataFrame, model: Whitening | None, vec_col: str = "embedding", keep: Sequence[str] = ()
) -> DataFrame:
    """Per usable row the columns ``row`` (a struct of those in ``keep``), ``deviation`` and
    ``whitened``, an array with a number per component."""
    rows = usable(df, vec_col, keep)
    row_type = rows.schema["row"].dataType.simpleString()
    schema = f"row {row_type}, deviation bigint, whitened array<double>"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    project, k = _projector(model), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("row")),
                    pa.array(_deviations(x - model.shift, model), pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(project(x).ravel())),
                ],
                names=["row", "deviation", "whitened"],
            )

    return rows.mapInArrow(run, schema)


def described(found: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per vector and component of what ``whiten`` gives, beside the kept columns:
    ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained`` (the component's
    share of all variance) and ``identity_error``."""
    shares = [float(v / model.trace) for v in model.values] if model else []
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    return found.select("row", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "row.*",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n if model else None).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )
