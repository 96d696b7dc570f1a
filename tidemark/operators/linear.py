"""Ridge regression of several targets from one pass over the rows.

A row becomes the vector ``1, features, targets``; the sum of its outer products holds the normal equations of every target.
Spark sums them in the executors, so a matrix of (features + targets + 1)^2 numbers is all that reaches the driver, whatever the
number of rows: short vectors by one aggregate with a sum per product, longer ones as matrices in a tree. The ridge system is
factorised once for all targets. The robust fit repeats this with the weights that the residuals of the fit before give, each
target with its own; with short vectors the rows are read once for all targets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, functions as F

#: Residuals beyond this many deviations of the target count linearly.
DELTA = 1.35
REWEIGHTINGS = 2
#: Arrays up to this length are worked on place by place, longer ones by functions of arrays; most sums of one aggregate.
SHORT, MOST_SUMS = 16, 256


@dataclass(frozen=True)
class Fit:
    """One line of coefficients and an intercept for each target, on scaled values."""

    coefficients: np.ndarray
    intercepts: np.ndarray

    def predict(self, target: int, x: str = "x") -> Column:
        found = self.coefficients[target].tolist()
        if len(found) <= SHORT:
            out = F.lit(float(self.intercepts[target]))
            for i, w in enumerate(found):
                out = out + F.get(x, F.lit(i)) * F.lit(w)
            return out
        weights = ", ".join(f"{w!r}D" for w in found)
        return F.expr(f"aggregate(zip_with({x}, array({weights}), (a, w) -> a * w), {float(self.intercepts[target])!r}D, (s, p) -> s + p)")


def gram(rows: DataFrame, vector: Column, size: int) -> np.ndarray:
    """Sum of the outer products of an array column of ``size`` numbers."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(vector).alias("z")), "z")
    # The number of rows is not used; it is given so that they are not counted.
    found = RowMatrix(vectors, 1, size).computeGramianMatrix()
    return np.asarray(found.toArray())


def grams(rows: DataFrame, d: int, groups: list[list[int]], weights: list[Column] | None = None) -> list[np.ndarray]:
    """For each group of targets the sum of the outer products of ``1, x, targets``, weighted by the group's weight if given."""
    sizes = [1 + d + len(group) for group in groups]
    if sum(s * (s + 1) // 2 for s in sizes) > MOST_SUMS:
        out = []
        for i, (group, size) in enumerate(zip(groups, sizes)):
            z = F.concat(F.array(F.lit(1.0)), "x", F.array(*[F.get("y", F.lit(t)) for t in group]))
            if weights is None:
                out.append(gram(rows, z, size))
            else:
                rooted = rows.withColumn("root", F.sqrt(weights[i]))
                out.append(gram(rooted, F.transform(z, lambda v: v * F.col("root")), size))
        return out
    place = lambda name, i: F.coalesce(F.get(name, F.lit(i)), F.lit(0.0)).alias(f"{name}{i}")
    used = sorted({t for group in groups for t in group})
    flat = rows.select(
        *[place("x", i) for i in range(d)], *[place("y", t) for t in used],
        *[w.alias(f"w{i}") for i, w in enumerate(weights or [])],
    )
    sums, places = [], []
    for i, group in enumerate(groups):
        names = [None, *[f"x{j}" for j in range(d)], *[f"y{t}" for t in group]]
        for a in range(len(names)):
            for b in range(a, len(names)):
                product = F.lit(1.0) if weights is None else F.col(f"w{i}")
                for name in (names[a], names[b]):
                    product = product if name is None else product * F.col(name)
                sums.append(F.sum(product))
                places.append((i, a, b))
    out = [np.zeros((s, s)) for s in sizes]
    for (i, a, b), found in zip(places, flat.agg(*sums).first()):
        out[i][a, b] = out[i][b, a] = found or 0.0
    return out


def _solve(g: np.ndarray, d: int, n: float, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (targets by features) and intercepts; the intercept is not shrunk."""
    mass = g[0, 0]
    mean_x, mean_y = g[0, 1:d + 1] / mass, g[0, d + 1:] / mass
    inside = (g[1:d + 1, 1:d + 1] - mass * np.outer(mean_x, mean_x)) / n + reg * np.eye(d)
    across = (g[1:d + 1, d + 1:] - mass * np.outer(mean_x, mean_y)) / n
    w = np.linalg.solve(inside, across).T
    return w, mean_y - w @ mean_x


def fit(rows: DataFrame, d: int, targets: int, loss: str = "squaredError", reg: float = 0.01) -> Fit:
    """``rows`` have ``x`` (``d`` numbers) and ``y`` (``targets`` numbers), both on a common scale."""
    g = grams(rows, d, [list(range(targets))])[0]
    n = g[0, 0]
    if n == 0:
        return Fit(np.zeros((targets, d)), np.zeros(targets))
    found = Fit(*_solve(g, d, n, reg))
    for _ in range(REWEIGHTINGS if loss == "huber" else 0):
        far = [F.abs(F.get("y", F.lit(t)) - found.predict(t)) for t in range(targets)]
        weights = [F.when(f <= DELTA, 1.0).otherwise(DELTA / f) for f in far]
        solved = [_solve(own, d, n, reg) for own in grams(rows, d, [[t] for t in range(targets)], weights)]
        found = Fit(np.concatenate([w for w, _ in solved]), np.concatenate([b for _, b in solved]))
    return found
