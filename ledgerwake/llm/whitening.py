"""Whitening of embeddings, with the covariance found by polarisation.

Entries are put on a grid (``SCALE`` steps to the unit, shifted by ``SHIFT``) and are integers from
then on. The model is fitted on the *fit list*, each distinct vector once, and applied to all rows.

For every dimension and every sum of two dimensions the exact variance is aggregated: the sum of
squares of the centred values. Values are centred by the whole part of their mean before they are
squared, which keeps them small; the fraction that is left of the mean is put right afterwards, in
integers, so that the variances are those about the exact mean. Cross-covariances follow from
differences: ``2 cov(a, b) = var(a + b) - var(a) - var(b)``. Every task sends one row for each
dimension and pair, whatever it read; the driver gets the ``d * (d + 1) / 2`` totals, assembles the
matrix and hands it to ``eigh``. Means and components (``d`` times 16 numbers) travel to the tasks.

Rows whose vector is NULL, empty, or holds a NULL or non-finite entry are dropped, as is a vector
shorter than the longest one: it lacks entries. Entries beyond ``LIMIT`` steps count as ``LIMIT``.
Components without variance are left out, so one distinct vector alone, or an empty table, gives no
rows. Equal eigenvalues are taken as ``eigh`` orders them; a component's sign makes its largest
entry positive. Repeated rows and ids each get their rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwake.llm.common import staged

SCALE = 64
SHIFT = 1_000_000
LIMIT = 1 << 61
COMPONENTS = 16
# Centred values below it can be added in pairs, squared and summed in 64 bits over 2^18 rows.
SMALL = 1 << 21
# Totals travel as two numbers, so that no sum of squares is too large for a decimal.
HALF = 1 << 60

TOTALS = "i int, j int, high decimal(38,0), low decimal(38,0)"
SCORES = "vec_id bigint, component int, n bigint, deviation bigint, whitened double"


@dataclass(frozen=True)
class Model:
    """What whitening needs of the fit list."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # falling, of the components kept
    components: np.ndarray  # dimensions x components, unit columns
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """Whole part of the mean of each dimension."""
        return _integers([total // self.n for total in self.sums])

    @property
    def rest(self) -> np.ndarray:
        """What the whole parts leave of the sums: ``sum - n * centre``, below ``n``."""
        return _integers([total % self.n for total in self.sums])


def _integers(values: list[int]) -> np.ndarray:
    return np.array(values, dtype=np.int64 if max(map(abs, values), default=0) < 1 << 62 else object)


def gridded(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``vec_id`` and the grid vector ``x`` of every usable row."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c)
                      & (F.abs(c) < float("inf")))
    steps = F.transform("c", lambda c: F.floor(F.greatest(
        F.least(c * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))) + SHIFT)
    usable = vectors.select(F.col(key).cast("bigint").alias("vec_id"), entries.alias("c")).filter(
        F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    return usable.select("vec_id", steps.alias("x"))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Vectors of equal length as rows of a matrix."""
    vectors = batch.column(column)
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _totals(df: DataFrame,
            partial: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], int]:
    """Exact sum of ``partial`` over all batches of ``x``, entry by entry above the diagonal."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = partial(_matrix(batch, "x")).astype(object)
                total = found if total is None else total + found
        if total is not None:
            i, j = np.nonzero(np.triu(np.ones(total.shape)))
            halves = [divmod(t, HALF) for t in total[i, j].tolist()]
            high, low = (pa.array(x, pa.decimal128(38, 0)) for x in zip(*halves, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), high, low],
                names=["i", "j", "high", "low"])

    parts = df.select("x").mapInArrow(sums, TOTALS).groupBy("i", "j")
    return {(r.i, r.j): int(r.high) * HALF + int(r.low)
            for r in parts.agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()}


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sum of each column, as the only row of a matrix."""
    high, low = x >> 31, x & ((1 << 31) - 1)
    return (high.sum(axis=0).astype(object) * (1 << 31) + low.sum(axis=0).astype(object))[None]


def centred_squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Upper triangle: on the diagonal the squares of each centred column, elsewhere those of
    the sum of two centred columns."""
    y = x - centre
    if len(y) and np.abs(y).max() >= SMALL:
        y = y.astype(object)
    found = np.zeros((x.shape[1], x.shape[1]), dtype=y.dtype)
    for i in range(x.shape[1]):
        found[i, i] = (y[:, i] * y[:, i]).sum()
        pairs = y[:, i + 1:] + y[:, i:i + 1]
        found[i, i + 1:] = (pairs * pairs).sum(axis=0)
    return found


def covariance(squares: dict[tuple[int, int], int], rest: list[int], n: int) -> np.ndarray:
    """The covariance matrix, from sums of squares about the whole parts of the means.

    With ``r`` the remainder of a value's sum, ``n * squares - r * r`` is ``n * n`` times its
    variance, in integers; only the last division rounds.
    """
    d = len(rest)
    scaled = {(i, j): n * total - (rest[i] + (rest[j] if i != j else 0)) ** 2
              for (i, j), total in squares.items()}
    matrix = np.zeros((d, d))
    for (i, j), both in scaled.items():
        if i == j:
            matrix[i, i] = both / (n * n)
        else:
            matrix[i, j] = matrix[j, i] = (both - scaled[i, i] - scaled[j, j]) / (2 * n * n)
    return matrix


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Model | None:
    """Fit on distinct grid vectors ``x`` of one length, a written table; None if it is empty."""
    totals = _totals(vectors, column_sums)
    if not totals:
        return None
    sums = [totals[place] for place in sorted(totals)]
    n = vectors.count()
    centre, rest = _integers([s // n for s in sums]), [s % n for s in sums]
    matrix = covariance(_totals(vectors, lambda x: centred_squares(x, centre)), rest, n)
    values, directions = np.linalg.eigh(matrix)
    values, directions = values[::-1], directions[:, ::-1]
    kept = np.flatnonzero(values > max(values[0], 0) * len(sums) * np.finfo(float).eps)[:components]
    directions = directions[:, kept]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(kept))])
    return Model(n, sums, values[kept], directions * signs, float(np.trace(matrix)))


def whitened(x: np.ndarray, model: Model) -> np.ndarray:
    """Rows projected on the components, each with unit variance over the fit list."""
    y = (x - model.centre).astype(float) - model.rest.astype(float) / model.n
    return y @ (model.components / np.sqrt(model.eigenvalues))


def deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """Exact squared distance to the mean, times ``n * n``; None where 64 bits cannot hold it."""
    y = x - model.centre
    d = x.shape[1]
    bound = (int(np.abs(y).max(initial=0)) + 1) * model.n
    if bound * bound * d >= 1 << 63:
        y = y.astype(object)
    gaps = y * model.n - model.rest
    return [t if t < 1 << 63 else None for t in (gaps * gaps).sum(axis=1).tolist()]


def identity_error(vectors: DataFrame, model: Model) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity, measured on it."""
    k = len(model.eigenvalues)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                z = whitened(_matrix(batch, "x"), model)
                total += np.concatenate([z.T @ z, z.sum(axis=0)[None]])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
             pa.array(total.ravel())], names=["i", "j", "total"])

    parts = vectors.select("x").mapInArrow(products, "i int, j int, total double")
    found = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        found[r.i, r.j] = r.total / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max(initial=0))


def apply(rows: DataFrame, model: Model) -> DataFrame:
    """A row for each row of ``rows(vec_id, x)`` and component."""
    k = len(model.eigenvalues)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "x")
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, model.n)),
                 pa.array(deviations(x, model), pa.int64()).take(each),
                 pa.array(whitened(x, model).ravel())],
                names=["vec_id", "component", "n", "deviation", "whitened"])

    return rows.mapInArrow(scores, SCORES)


def table(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whiten every usable row by the distinct vectors of the table."""
    spark = vectors.sparkSession
    rows = gridded(vectors)
    distinct = staged(rows.select("x").distinct(), "fit-list")
    longest = distinct.agg(F.max(F.size("x"))).first()[0]
    full = F.size("x") == F.lit(longest)
    model = fit(distinct.filter(full), components)
    schema = f"{SCORES}, explained double, identity_error double"
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.eigenvalues])
    return apply(rows.filter(full), model).select(
        "*", F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(identity_error(distinct.filter(full), model)).alias("identity_error"))
