"""Logistic regression by Newton's steps: each pass over the rows is one aggregate of a few sums.

The optimum is that of `fit`. Started from the weights of the batch before, a refit needs a pass for the scales and a few
steps, where the default's descent may take a hundred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.operators.model import LinearModel
from perigee.schema import FEATURE_COLUMNS, LABEL


@dataclass
class Newton:
    """A trainer for the incremental step that starts where the last one ended; `passes` counts those of the last call.

    Steps that lose likelihood are halved. It ends when a step promises to gain less than `tolerance` of the likelihood,
    when the classes are apart (the weights would grow for ever), or after `most` passes. Rows of one class alone give an
    infinite intercept, a constant feature the weight 0, as `fit` does; no rows are an error.
    """

    tolerance: float = 1e-12
    most: int = 40
    passes: int = field(default=0, compare=False)

    def __call__(self, train: DataFrame, start: LinearModel | None = None) -> LinearModel:
        self.passes = 1
        rows = train.select(*(F.col(c).cast("double").alias(c) for c in (*FEATURE_COLUMNS, LABEL)))
        n, positive, *moments = rows.agg(
            F.count("*"),
            F.sum(LABEL),
            *(F.avg(c) for c in FEATURE_COLUMNS),
            *(F.stddev_pop(c) for c in FEATURE_COLUMNS),
        ).first()
        if n == 0:
            raise ValueError("no rows to learn from")
        k = len(FEATURE_COLUMNS)
        if positive in (0, n):
            return LinearModel((0.0,) * k, float("inf") if positive else float("-inf"))
        means, scales = np.array(moments[:k]), np.array(moments[k:])
        used = scales > 0
        safe = np.where(used, scales, 1.0)
        # Weights of (1, scaled features); those of constant features stay 0.
        weights = np.zeros(k + 1)
        weights[0] = np.log(positive / (n - positive))
        if start is not None and np.isfinite([start.intercept, *start.coefficients]).all():
            slopes = np.array(start.coefficients) * scales
            weights = np.array([start.intercept + float(np.array(start.coefficients) @ means), *np.where(used, slopes, 0.0)])
        scaled = [(F.col(c) - float(m)) / float(s) for c, m, s in zip(FEATURE_COLUMNS, means, safe, strict=True)]
        free = np.flatnonzero([True, *used])
        likelihood, gradient, curvature = self._sums(rows, scaled, weights)
        while self.passes < self.most:
            step = np.zeros(k + 1)
            step[free] = np.linalg.lstsq(curvature[np.ix_(free, free)], gradient[free], rcond=None)[0]
            if step @ gradient / 2 <= self.tolerance * abs(likelihood) or likelihood > -1e-9 * n:
                break
            share = 1.0
            while self.passes < self.most:
                found = self._sums(rows, scaled, weights + share * step)
                if found[0] >= likelihood:
                    break
                share /= 2
            else:
                break
            weights = weights + share * step
            likelihood, gradient, curvature = found
        slopes = np.where(used, weights[1:] / safe, 0.0)
        return LinearModel(tuple(map(float, slopes)), float(weights[0] - slopes @ means))

    def _sums(self, rows: DataFrame, scaled: list[Column], weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """One pass: the log likelihood, its gradient and its negated second derivatives."""
        self.passes += 1
        x = [F.lit(1.0), *scaled]
        margin = sum((float(w) * c for w, c in zip(weights[1:], scaled, strict=True)), F.lit(float(weights[0])))
        made = rows.select(*(c.alias(f"x{j}") for j, c in enumerate(x)), margin.alias("margin"), F.col(LABEL).alias("y"))
        chance = 1.0 / (1.0 + F.exp(-F.col("margin")))
        made = made.select("*", chance.alias("p"))
        k = len(x)
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        p, y, m = F.col("p"), F.col("y"), F.col("margin")
        found = made.agg(
            F.sum(y * m - F.greatest(m, F.lit(0.0)) - F.log1p(F.exp(-F.abs(m)))),
            *(F.sum((y - p) * F.col(f"x{j}")) for j in range(k)),
            *(F.sum(p * (1.0 - p) * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs),
        ).first()
        curvature = np.zeros((k, k))
        for value, (i, j) in zip(found[1 + k :], pairs, strict=True):
            curvature[i, j] = curvature[j, i] = value
        return float(found[0]), np.array(found[1 : 1 + k]), curvature
