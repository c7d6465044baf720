"""Linear models from second moments.

A linear fit with a quadratic loss needs the data only through the sums of products
of (1, features, label). One aggregate gives them for every fold; the moments of the
other folds are the whole less the fold's own, so any grid of penalties is solved and
scored without reading the rows again: ridge by a Cholesky factor, lasso and elastic
net by coordinate descent. Scaling and penalties are those of MLlib's linear
regression: features and label are divided by their population deviations, the
intercept is free."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed labels of the regularisation type (elastic-net mixing 0 / 1 / other)
REG_TYPE_L2 = "Ridge (L2)"
REG_TYPE_L1 = "Lasso (L1)"
REG_TYPE_MIXED = "ElasticNet (L1+L2)"
#: Rounds of coordinate descent at most, and the change below which it ends.
ROUNDS, TOLERANCE = 100_000, 1e-13


def regularisation(mix: float) -> str:
    return REG_TYPE_L2 if mix == 0 else REG_TYPE_L1 if mix == 1 else REG_TYPE_MIXED


def linear_moments(frame: DataFrame, slots: int, features: str = "features", label: str = "label", fold: str = "fold") -> DataFrame:
    """(fold, a, b, value): sums of products of the columns 0 (ones), 1 to ``slots`` (the
    features) and slots + 1 (the label), a <= b, in one aggregate per fold."""
    x = vector_to_array(F.col(features))
    columns = [F.lit(1.0), *[x[i] for i in range(slots)], F.col(label).cast("double")]
    flat = frame.select(F.col(fold).alias("fold"), *[c.alias(f"x{i}") for i, c in enumerate(columns)])
    cells = [(a, b) for a in range(slots + 2) for b in range(a, slots + 2)]
    sums = flat.groupBy("fold").agg(*[F.sum(F.col(f"x{a}") * F.col(f"x{b}")).alias(f"m{a}_{b}") for a, b in cells])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"m{a}_{b}").alias("value")) for a, b in cells]
    return sums.select("fold", F.explode(F.array(*rows)).alias("r")).select("fold", "r.*")


def collect(moments: DataFrame) -> dict[int, np.ndarray]:
    """Fold -> symmetric matrix; (slots + 2)^2 numbers a fold."""
    rows = moments.collect()
    size = max((r["b"] for r in rows), default=-1) + 1
    out: dict[int, np.ndarray] = {}
    for r in rows:
        m = out.setdefault(r["fold"], np.zeros((size, size)))
        m[r["a"], r["b"]] = m[r["b"], r["a"]] = r["value"]
    return out


def solve(m: np.ndarray, reg: float = 0.0, mix: float = 0.0) -> np.ndarray:
    """(intercept, coefficients) of the penalised fit to moments ``m``."""
    n, mean = m[0, 0], m[0] / m[0, 0]
    spread = np.sqrt(np.maximum(np.diag(m) / n - mean**2, 0.0))
    # sums of a constant column cancel to rounding dust
    spread[spread <= 1e-12 * np.maximum(1.0, np.abs(mean))] = 0.0
    live = np.flatnonzero(spread[1:-1] > 0) + 1
    out = np.zeros(len(m) - 1)
    out[0] = mean[-1]
    if not len(live) or spread[-1] == 0:
        return out
    centred = m / n - np.outer(mean, mean)
    a = centred[np.ix_(live, live)] / np.outer(spread[live], spread[live])
    b = centred[live, -1] / (spread[live] * spread[-1])
    one, two = mix * reg / spread[-1], (1 - mix) * reg / spread[-1]
    beta = _ridge(a, b, two) if one == 0 else _descend(a, b, one, two)
    out[live] = beta * spread[-1] / spread[live]
    out[0] -= out[1:] @ mean[1:-1]
    return out


def _ridge(a: np.ndarray, b: np.ndarray, two: float) -> np.ndarray:
    full = a + two * np.eye(len(a))
    try:
        low = np.linalg.cholesky(full)
    except np.linalg.LinAlgError:  # collinear and not penalised: the shortest solution
        return np.linalg.lstsq(full, b, rcond=None)[0]
    return np.linalg.solve(low.T, np.linalg.solve(low, b))


def _descend(a: np.ndarray, b: np.ndarray, one: float, two: float) -> np.ndarray:
    """Minimum of b'ab/2 - b'beta + one |beta|_1 + two |beta|^2 / 2, slot by slot."""
    beta = np.zeros(len(b))
    for _ in range(ROUNDS):
        moved = 0.0
        for j in range(len(b)):
            pull = b[j] - a[j] @ beta + a[j, j] * beta[j]
            new = np.sign(pull) * max(abs(pull) - one, 0.0) / (a[j, j] + two)
            moved, beta[j] = max(moved, abs(new - beta[j])), new
        if moved < TOLERANCE:
            break
    return beta


def rmse(m: np.ndarray, model: np.ndarray) -> float:
    """Root mean square error of (intercept, coefficients) on the rows of ``m``."""
    v = np.append(-model, 1.0)
    return float(np.sqrt(max(v @ m @ v, 0.0) / m[0, 0]))
