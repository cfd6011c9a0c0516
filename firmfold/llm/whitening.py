"""Whitening of embeddings by shifted CholeskyQR.

Entries become whole numbers ``x = floor(1024 * c) + 100000``. With n rows and their
column sums S, a centred row is ``(n * x - S) / n``: the numerator is exact, so a large
common offset costs no digits. The tall matrix A of centred rows is orthogonalised by
passes over the table. A pass turns each batch of rows by the triangular factors found
so far, one triangular solve each, and sums its Gram matrix; the sums of all tasks are
added by Spark per matrix entry. The Cholesky factor of the first Gram matrix is taken
with a shift that keeps it positive definite whatever A's condition; passes repeat until
the rows are orthonormal or no pass helps any more (dependent columns). A is then Q R
with R the product of all factors, and the right singular vectors of R are the
eigenvectors of the covariance, its squared singular values over n the eigenvalues: the
covariance itself, which would square the condition, is never decomposed.

What reaches the driver is one matrix of the vectors' length squared per pass, whatever
the number of rows; a task holds a batch and one such matrix.

Defined results: rows whose vector is null or holds null or non-finite entries, or
entries of ``MOST`` and more (whose x no 64-bit sum would hold), or that have not the
commonest length (of equally common ones the longest), take no part and have no rows.
Repeated rows and null ids count as rows. A component whose eigenvalue is zero to double
precision (constant or dependent columns, a single row) is left in with ``whitened``
null; ``explained`` is null where all are. ``identity_error`` is taken over the
components that have an eigenvalue. A ``deviation`` that 64 bits do not hold is null.
Without rows, or with empty vectors only, the result is empty. Only the named columns
are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmfold.llm.common import pick

SCALE = 1024
OFFSET = 100_000
MOST = float(1 << 40)
COMPONENTS = 8
PASSES = 6
ORTHONORMAL = 1e-12
UNIT = np.finfo(np.float64).eps / 2


def whole(vectors: pd.Series) -> np.ndarray:
    """Rows of whole numbers; the product with a power of two is exact."""
    return np.floor(np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) * SCALE).astype(np.int64) + OFFSET


def scaled_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in 64 bits where they hold it, else in Python's whole numbers."""
    largest = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0))
    if largest < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(deviations: np.ndarray) -> list[int | None]:
    """Sums of squares per row, exact; null beyond 64 bits."""
    largest = max((abs(int(v)) for v in (deviations.min(initial=0), deviations.max(initial=0))), default=0)
    if deviations.dtype != object and largest ** 2 * max(1, deviations.shape[1]) >= 1 << 63:
        deviations = deviations.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (deviations * deviations).sum(axis=1)]


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows * upper^-1 by substitution, one column after the other for all rows."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    axes: np.ndarray        # unit eigenvectors as columns, falling eigenvalues
    values: np.ndarray      # their eigenvalues
    trace: float
    sound: int              # the first components, whose eigenvalue is not zero
    error: float | None = None

    def centred(self, vectors: pd.Series) -> np.ndarray:
        return scaled_deviations(whole(vectors), self.n, self.sums).astype(np.float64) / self.n

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ self.axes[:, :self.sound] / np.sqrt(self.values[:self.sound])


def fit_rows(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and their common length."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST)
    rows = pick(vectors, id=id_col, vector=vector_col).withColumn("vector", F.col("vector").cast("array<double>"))
    rows = rows.filter(F.coalesce(F.forall("vector", entry), F.lit(False)))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    length = first["length"] if first else 0
    return rows.filter(F.size("vector") == length), length


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the columns' sums, exact: high and low halves are added apart."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, high, low = 0, 0, 0
        for batch in batches:
            x = whole(batch["vector"])
            n, high, low = n + len(x), high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
        if n:
            yield pd.DataFrame({"j": np.arange(len(high)), "n": n, "high": high, "low": low})

    total = rows.select("vector").mapInPandas(add, "j int, n bigint, high bigint, low bigint").groupBy("j").agg(
        *[F.sum(c).alias(c) for c in ("n", "high", "low")]).orderBy("j").collect()
    return (total[0]["n"] if total else 0), [(r["high"] << 31) + r["low"] for r in total]


def _gram(rows: DataFrame, turned: Callable[[pd.Series], np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and column sums of the turned rows, added by Spark per entry."""
    low, high = np.triu_indices(width)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, sums = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            part = turned(batch["vector"])
            gram += part.T @ part
            sums += part.sum(axis=0)
        yield pd.DataFrame({"i": np.concatenate([low, np.full(width, -1)]), "j": np.concatenate([high, np.arange(width)]),
                            "v": np.concatenate([gram[low, high], sums])})

    entries = rows.select("vector").mapInPandas(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    gram, sums = np.zeros((width, width)), np.zeros(width)
    for i, j, v in entries.collect():
        if i < 0:
            sums[j] = v
        else:
            gram[i, j] = gram[j, i] = v
    return gram, sums


def _cholesky(gram: np.ndarray, shift: float) -> np.ndarray | None:
    try:
        return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
    except np.linalg.LinAlgError:
        return None


def fit(rows: DataFrame, length: int) -> Whitening | None:
    """The components of the rows of :func:`fit_rows`."""
    n, sums = _sums(rows) if length else (0, [])
    if not n:
        return None
    centre = Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    factors: list[np.ndarray] = []

    def turned(vectors: pd.Series) -> np.ndarray:
        part = centre.centred(vectors)
        for upper in factors:
            part = solved(part, upper)
        return part

    drift = None
    for turn in range(PASSES):
        gram, sums_now = _gram(rows, turned, length)
        drift = sums_now / n if drift is None else drift  # rounding of the centred rows' mean
        # Rows are orthonormal, or a shifted factor was not improved by another pass.
        if not gram.any() or turn and np.abs(gram - np.eye(length)).max() < ORTHONORMAL or turn == PASSES - 1:
            break
        shift = 11 * (n * length + length * (length + 1)) * UNIT * float(np.linalg.norm(gram, 2))
        upper = _cholesky(gram, shift if turn == 0 else 0.0)
        if upper is None:  # dependent columns
            upper = _cholesky(gram, shift)
        if upper is None:
            break
        factors.append(upper)
    # The root of the last Gram matrix: the identity's where rows are orthonormal, the
    # rank-deficient rest where they cannot be.
    values, vectors = np.linalg.eigh(gram)
    total = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
    for upper in reversed(factors):
        total = total @ upper
    _, singular, axes = np.linalg.svd(total)
    axes = axes.T
    axes *= np.where(axes[np.abs(axes).argmax(axis=0), np.arange(length)] < 0, -1.0, 1.0)
    eigen = singular ** 2 / n
    k = min(COMPONENTS, length)
    sound = int((singular[:k] > singular[0] * length * np.finfo(np.float64).eps * 16).sum())
    model = Whitening(n, sums, axes[:, :k], eigen[:k], float(eigen.sum()), sound)
    if not sound:
        return model
    centre_of = drift @ model.axes[:, :sound] / np.sqrt(model.values[:sound])
    check, _ = _gram(rows, lambda vectors: model.project(model.centred(vectors)) - centre_of, sound)
    return Whitening(n, sums, model.axes, model.values, model.trace, sound,
                     float(np.abs(check / n - np.eye(sound)).max()))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per fitted row and component, up to ``COMPONENTS`` of them."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    rows, length = fit_rows(vectors, id_col, vector_col)
    model = fit(rows, length)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
        for batch in batches:
            deviations = scaled_deviations(whole(batch["vector"]), model.n, model.sums)
            white = np.full((len(batch), k), np.nan)
            white[:, :model.sound] = model.project(deviations.astype(np.float64) / model.n)
            column = pd.Series(white.ravel()).astype(object)
            yield pd.DataFrame({
                id_col: batch["id"].repeat(k).reset_index(drop=True), "component": np.tile(np.arange(1, k + 1), len(batch)),
                "n": model.n, "deviation": pd.Series(squares(deviations), dtype="Int64").repeat(k).reset_index(drop=True),
                "whitened": column.where(column.notna(), None),
                "explained": pd.Series(explained * len(batch), dtype=object),
                "identity_error": pd.Series([model.error] * (k * len(batch)), dtype=object)})

    return rows.mapInPandas(project, schema)
