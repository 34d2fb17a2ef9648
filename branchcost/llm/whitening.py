"""Embedding whitening from refined eigenvectors of a distributed covariance.

1. Entries become whole numbers (`SCALE` steps of a unit, shifted), so counts,
   sums and second moments are exact and do not depend on how the rows are
   dealt or on which tasks are run again. Vectors are centred on the rounded
   mean before they are multiplied; the rest of the mean, less than one half,
   is taken out of the sums exactly. Tasks send one matrix each, summed by
   Spark; what comes to the driver is one number per pair of dimensions.
2. Eigenvectors of the covariance in single precision, then Ogita and
   Aishima's refinement in extended precision: with R = I - X'X and
   S = X'AX, the eigenvalues are s_ii / (1 - r_ii), and X is corrected to
   X + XE with e_ij = (s_ij + l_j r_ij) / (l_j - l_i). Each step is four matrix
   products and squares the error.
3. Eigenvalues too close for that (nearer than the error of S) are clusters:
   their correction is r_ij / 2, which makes them orthogonal, and the matrix of
   the cluster itself, shifted by its mean eigenvalue, is solved the same way
   on its own scale, where it is no longer clustered. Its solution turns the
   cluster's vectors; equal eigenvalues keep any basis.
4. Rows are projected in double precision and divided by the root of the
   eigenvalue. The covariance of the result is measured over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from branchcost.llm.common import stage_table

SCALE = 1024
SHIFT = 100_000
LARGEST = 2.0**40  # entries beyond are taken as this
COMPONENTS = 8
PIECE = 20  # bits; products of pieces of numbers are summed exactly in double precision
ROWS = 4096
STEPS = 12
HALF = 1 << 40  # sums travel as two numbers

_X = np.longdouble


def refined_eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of a symmetric matrix of extended precision, ascending."""
    a = np.asarray(a, _X)
    d = len(a)
    scale = np.abs(a).max() if d else _X(0)
    if d < 2 or not scale:
        return np.diag(a).copy() if d else np.zeros(0, _X), np.eye(d, dtype=_X)
    eps = np.finfo(_X).eps
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_X)
    best = (_X(np.inf), x)
    for _ in range(STEPS):
        r = np.eye(d, dtype=_X) - x.T @ x
        s = x.T @ a @ x
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(value)
        error = np.abs(off).sum(1).max() + np.abs(r).sum(1).max()
        if error < best[0]:
            best = (error, x)
        elif error < d * d * eps * 64:
            break
        near = np.abs(value[:, None] - value[None, :]) <= 2 * error
        gap = np.where(near, 1, value[None, :] - value[:, None])
        x = x + x @ np.where(near, r / 2, (s + value[None, :] * r) / gap)
        if near.sum() > d:
            x = _clusters_solved(a, x, 2 * error, depth)
    x = _orthonormal(best[1])
    value = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(value, kind="stable")
    x = x[:, order] / np.sqrt((x * x).sum(0))[order]
    return value[order] * scale, x


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns made so to extended precision."""
    for _ in range(3):
        x = x + x @ (np.eye(x.shape[1], dtype=_X) - x.T @ x) / 2
    return x


def _clusters_solved(a: np.ndarray, x: np.ndarray, near: float, depth: int) -> np.ndarray:
    """`x` with the vectors of each group of eigenvalues closer than `near` turned to the group's own solution."""
    value = np.diag(x.T @ a @ x)
    order = np.argsort(value, kind="stable")
    cuts = np.flatnonzero(np.diff(value[order]) > near) + 1
    for group in np.split(order, cuts):
        if len(group) < 2 or len(group) == len(x) and depth > 2 or depth > 6:
            continue
        part = _orthonormal(x[:, group])
        shift = value[group].mean()
        small = part.T @ (a @ part - shift * part)
        small = (small + small.T) / 2
        if np.abs(small).max() > len(a) * np.finfo(_X).eps:
            part = part @ refined_eigenvectors(small, depth + 1)[1]
        x = x.copy()
        x[:, group] = part
    return x


@dataclass
class Whitening:
    """What is fitted: x-vectors `n`, their sums, and the components as rows, by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """Mean, rounded to whole numbers."""
        return np.array([_rounded(s, self.n) for s in self.sums], np.int64)


def _rounded(a: int, b: int) -> int:
    return (2 * a + b) // (2 * b)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): the rows whose vector is neither null nor holds null, NaN or infinite entries."""
    vec = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    rows = df.select(F.col(id_col).alias("vec_id"), vec.alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform("vec", lambda c: F.floor(held(c) * SCALE) + SHIFT)
    return rows.where(F.coalesce(finite, F.lit(False))).select("vec_id", x.alias("x"))


def _exact_gram(y: np.ndarray) -> np.ndarray:
    """y'y of whole numbers as an array of Python's integers."""
    top = int(np.abs(y).max(initial=0))
    parts, shift = [], 0
    while True:
        low = y - ((y >> PIECE) << PIECE) if top >> PIECE else y
        parts.append((low.astype(np.float64), shift))
        if not top >> PIECE:
            break
        y, shift, top = y >> PIECE, shift + PIECE, (top >> PIECE) + 1
    total = 0
    for a, i in parts:
        for b, j in parts:
            # 2**12 rows of products below 2**40 stay below 2**53
            total = total + (a.T @ b).astype(np.int64).astype(object) * (1 << (i + j))
    return total


def _moments(centre) -> callable:
    """Rows (i, hi, lo) of the task's matrix of second moments around `centre`."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = 0
        for b in batches:
            for lo in range(0, len(b), ROWS):
                total = total + _exact_gram(np.stack(b["x"].iloc[lo : lo + ROWS].to_list()).astype(np.int64) - centre.value)
        if isinstance(total, np.ndarray):
            yield pd.DataFrame(
                {
                    "i": np.arange(len(total)),
                    "hi": [[int(v) // HALF for v in row] for row in total],
                    "lo": [[int(v) % HALF for v in row] for row in total],
                }
            )

    return run


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows of `usable` that have `dim` entries; None without any."""
    spark = rows.sparkSession
    rows = rows.where(F.size("x") == dim).select("x")
    entries = rows.select(F.posexplode("x").alias("i", "v"))
    sums = entries.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    if not sums:
        return None
    n = sums[0]["n"]
    model = Whitening(n, [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])], np.zeros(0), np.zeros((0, dim)), 0.0)
    centre = spark.sparkContext.broadcast(model.centre)
    sent = rows.mapInPandas(_moments(centre), "i int, hi array<bigint>, lo array<bigint>")
    cells = sent.select("i", F.posexplode(F.arrays_zip("hi", "lo")).alias("j", "c")).groupBy("i", "j")
    moment = np.zeros((dim, dim), object)
    for r in cells.agg(F.sum(F.col("c.hi").cast("decimal(38,0)")).alias("hi"), F.sum(F.col("c.lo").cast("decimal(38,0)")).alias("lo")).collect():
        moment[r["i"], r["j"]] = int(r["hi"]) * HALF + int(r["lo"])
    rest = np.array([s - n * int(c) for s, c in zip(model.sums, model.centre)], object)  # n times what the rounding left
    whole = n * moment - rest[:, None] * rest[None, :]  # n * n times the covariance
    cov = np.array([[_X(int(v) // n**2) + _X((int(v) % n**2) / n**2) for v in row] for row in whole], _X).reshape(dim, dim)
    values, vectors = refined_eigenvectors(cov)
    order = np.argsort(-values, kind="stable")[: min(components, dim)]
    picked = vectors[:, order].T.astype(np.float64)
    sign = np.sign(picked[np.arange(len(order)), np.abs(picked).argmax(1)])
    model.values = np.maximum(values[order].astype(np.float64), 0.0)
    model.components = picked * sign[:, None]
    model.trace = float(np.trace(cov))
    return model


def _deviations(d: np.ndarray) -> list[int]:
    """Sum of squares of each row of whole numbers, exact."""
    top = int(np.abs(d).max(initial=0))
    if top * top * d.shape[1] < 2**63:
        return (d * d).sum(1).tolist()
    return [sum(int(v) * int(v) for v in row) for row in d]


def _projected(shared) -> callable:
    """(deviation, whitened values) of each x-vector."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: Whitening = shared.value
        centre = m.centre
        rest = [s - m.n * int(c) for s, c in zip(m.sums, centre)]
        scale = np.sqrt(m.values)
        turn = (m.components / np.where(scale > 0, scale, np.inf)[:, None]).T
        for b in batches:
            for lo in range(0, max(1, len(b)), ROWS):
                x = b.iloc[lo : lo + ROWS].to_list()
                if not x:
                    yield pd.DataFrame({"deviation": [], "w": []})
                    continue
                y = np.stack(x).astype(np.int64) - centre
                if (int(np.abs(y).max()) + 1) * m.n < 2**62:
                    d = y * m.n - np.array(rest, np.int64)  # n * x - S
                    off = d / m.n
                else:
                    d = y.astype(object) * m.n - np.array(rest, object)
                    off = (d / m.n).astype(np.float64)
                yield pd.DataFrame(
                    {"deviation": [Decimal(v) if abs(v) < 10**38 else None for v in _deviations(d)], "w": list(off @ turn)}
                )

    return run


def _one(batches: Iterator[pd.Series], run) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.concat(list(run(iter([b]))), ignore_index=True)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Vectors that are null or hold a null, NaN or infinite entry are left out;
    all others are the fit list, repeated rows and repeated or null ids
    included. Vectors of different lengths have a fit list for each length.
    A vector has a row for each of the first `components` components, fewer if
    it has fewer entries; one without entries has none. Entries beyond
    `LARGEST` in size are taken as that.

    `deviation` (decimal) is the sum over the dimensions of (n * x - S)**2,
    null beyond 38 digits. Where an eigenvalue is zero (one vector, equal
    vectors, dependent dimensions), whitened is 0; explained is 0 if all
    are. `identity_error` is the largest absolute entry of whitened's
    covariance minus the identity, over all components of the length, so a
    zero eigenvalue shows as an error of 1. Ties between equal eigenvalues
    leave the basis open; one basis holds for all rows.
    """
    spark = df.sparkSession
    rows = stage_table(usable(df, id_col, vec_col), "whiten-rows")
    dims = sorted(r["dim"] for r in rows.select(F.size("x").alias("dim")).distinct().collect() if r["dim"])
    out = [_whitened(rows, model) for d in dims if (model := fit(rows, d, components))]
    if not out:
        kind = dict(rows.dtypes)["vec_id"]
        return spark.createDataFrame(
            [], f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        )
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def _whitened(rows: DataFrame, model: Whitening) -> DataFrame:
    spark = rows.sparkSession
    k = len(model.values)
    run = _projected(spark.sparkContext.broadcast(model))

    @F.pandas_udf("deviation decimal(38,0), w array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return _one(batches, run)

    found = rows.where(F.size("x") == len(model.sums)).withColumn("p", project("x"))
    found = stage_table(found.select("vec_id", "p.deviation", "p.w"), "whitened")
    w: list[Column] = [F.col("w")[i] for i in range(k)]
    cells = found.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1)]).first()
    error = max(abs(cells[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i + 1))
    share = [float(v) / model.trace if model.trace else 0.0 for v in model.values]
    return found.select("vec_id", "deviation", F.posexplode("w").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(s) for s in share]), F.col("place") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
