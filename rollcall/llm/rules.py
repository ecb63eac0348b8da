"""Quality classifier: a sparse ensemble of rules.

Small trees are grown over statistics of labelled texts; each path from a root is a conjunctive rule. A lasso-penalised logistic
regression keeps few of them, and those become one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .labelled import labelled_sample
from .statistics import FEATURES, PREFIX, with_statistics

#: Labelled rows that a model is fitted on, at most.
TRAIN_ROWS = 20_000
#: A node is split into parts of LEAF rows or a fortieth of all rows, whichever is fewer, and 3 at least.
TREES, DEPTH, CUTS, LEAF = 24, 3, 24, 20
PENALTY, STEPS = 2e-4, 600

Condition = tuple[int, bool, float]  # statistic, whether above, threshold


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[tuple[Condition, ...], float], ...]

    def expression(self) -> Column:
        """The score as a column over the statistics."""
        total = F.lit(float(self.bias))
        for conditions, weight in self.rules:
            holds = F.lit(True)
            for feature, above, cut in conditions:
                value = F.col(PREFIX + FEATURES[feature])
                holds = holds & ((value > cut) if above else (value <= cut))
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def tree_paths(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> list[tuple[Condition, ...]]:
    """All paths of one tree over a bootstrap sample; each node looks at a random half of the statistics."""
    out: list[tuple[Condition, ...]] = []
    leaf = max(3, min(LEAF, len(y) // 40))

    def grow(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            out.append(path)
        positive = y[rows].sum()
        if len(path) == DEPTH or len(rows) < 2 * leaf or positive in (0, len(rows)):
            return
        best = (1e-9, 0, 0.0)
        base = positive * (len(rows) - positive) / len(rows)
        for feature in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False):
            values = x[rows, feature]
            cuts = np.unique(np.quantile(values, np.linspace(0.02, 0.98, CUTS)))
            low = values[:, None] <= cuts
            n, p = low.sum(axis=0), (low * y[rows][:, None]).sum(axis=0)
            m, q = len(rows) - n, positive - p
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = base - np.where(n, p * (n - p) / n, 0) - np.where(m, q * (m - q) / m, 0)
            gain[(n < leaf) | (m < leaf)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), int(feature), float(cuts[gain.argmax()]))
        if best[0] > 1e-9:
            low = x[rows, best[1]] <= best[2]
            grow(rows[low], (*path, (best[1], False, best[2])))
            grow(rows[~low], (*path, (best[1], True, best[2])))

    grow(rng.integers(0, len(y), len(y)), ())
    return out


def holds(x: np.ndarray, conditions: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for feature, above, cut in conditions:
        out &= (x[:, feature] > cut) if above else (x[:, feature] <= cut)
    return out


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the mean logistic loss plus ``penalty`` times the sum of absolute weights (accelerated
    proximal gradient; the bias is not penalised). One single-precision copy of ``x`` is all that is held."""
    x, y = np.asarray(x, np.float32), np.asarray(y, np.float32)
    n, k = x.shape
    step = 4 * n / (n + max(float(np.linalg.eigvalsh(x.T @ x)[-1]), 1e-9)) if k else 4.0
    # The bias stands at place 0.
    w, ahead, t = np.zeros(k + 1), np.zeros(k + 1), 1.0
    for _ in range(steps):
        margin = x @ ahead[1:].astype(np.float32) + np.float32(ahead[0])
        off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        new = ahead - step * np.concatenate([[off.mean()], off @ x / n])
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead = new + (before - 1) / t * (new - w)
        w = new
    return float(w[0]), w[1:]


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 8) -> RuleModel:
    """With one class only, or fewer than 12 rows, the score is the smoothed share of ones."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    if len(y) < 12 or y.min() == y.max():
        return RuleModel(prior, ())
    rng = np.random.default_rng(seed)
    paths = list(dict.fromkeys(tuple(sorted(p)) for _ in range(TREES) for p in tree_paths(x, y, rng)))
    fired = np.column_stack([holds(x, p) for p in paths])
    _, unlike = np.unique(fired, axis=1, return_index=True)  # rules that hold for the same rows count once
    paths, fired = [paths[i] for i in sorted(unlike)], fired[:, sorted(unlike)]
    bias, weights = lasso_logistic(fired, y)
    return RuleModel(bias, tuple((p, float(w)) for p, w in zip(paths, weights) if w))


def train_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS
) -> RuleModel:
    """A model of ``label`` over the texts' statistics, fitted on a bounded sample of the given labels.

    Null labels and ids take no part, an id with several labels has the larger one, null and empty texts have statistics of 0, very long
    texts count whole, and repeated rows count each (as far as the bound on rows allows). With fewer than 12 rows or one class every text
    has the same score.
    """
    sample = labelled_sample(docs.select(id_col, text_col), labels, label, id_col, rows)
    found = with_statistics(sample, text_col).select("__label", *[PREFIX + f for f in FEATURES]).toPandas()
    values = found.sort_values(list(found.columns)).to_numpy(np.float64)
    return fit_rules(values[:, 1:], values[:, 0])


def score_quality(docs: DataFrame, model: RuleModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` from 0 to 1. Null and empty texts have statistics of 0 and a score like any other; a column named
    ``score`` is replaced; repeated rows get the same score; an empty table stays empty."""
    names = [PREFIX + f for f in FEATURES]
    return with_statistics(docs, text_col).withColumn("score", model.expression()).drop(*names)
