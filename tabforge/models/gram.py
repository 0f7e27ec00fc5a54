"""Ridge errors of many settings and folds from one pass over the rows.

Each task adds the cross products of all monomials, the label and 1 into one matrix per fold; the matrices of a fold meet in one
shuffle. What a model trained without a fold needs is the sum of the other folds' matrices, and its error on the fold follows from
the fold's own: every degree up to the largest, every alpha and every fold is then a small solve in the driver. Features and label
enter shifted and scaled (by their means and deviations, one aggregate before), which keeps sums and solves accurate; the
penalty is that of the plain monomials, whose coefficients are linear in those of the shifted ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement, product
from math import comb, prod
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..schema import q_col, usable_subset
from .linear import TooWide, term_count, term_limit

ROUNDING = 1e-11  # errors below this share of the label's variance are rounding and count as none
GRAM_TERMS = 1024  # monomials of one pass; a matrix has 8 MB at most


def monomials(n_features: int, degree: int) -> list[tuple[int, ...]]:
    """Feature numbers of every monomial, lower degrees first: those of a smaller degree come before all others."""
    return [m for d in range(1, degree + 1) for m in combinations_with_replacement(range(n_features), d)]


def _design(x: np.ndarray, terms: list[tuple[int, ...]]) -> np.ndarray:
    place = {m: i for i, m in enumerate(terms)}
    out = np.empty((len(x), len(terms)))
    for i, m in enumerate(terms):
        out[:, i] = x[:, m[-1]] if len(m) == 1 else out[:, place[m[:-1]]] * x[:, m[-1]]
    return out


def plain_coefficients(terms: list[tuple[int, ...]], shift: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The matrix that turns coefficients of monomials in (x - shift) / scale into those of monomials in x, without the constant."""
    place = {m: i for i, m in enumerate(terms)}
    out = np.zeros((len(terms), len(terms)))
    for column, m in enumerate(terms):
        powers = Counter(m)
        parts = [[(j, comb(k, j) * (-shift[f]) ** (k - j) / scale[f] ** k) for j in range(k + 1)] for f, k in powers.items()]
        for chosen in product(*parts):
            own = tuple(sorted(f for f, (j, _) in zip(powers, chosen) for _ in range(j)))
            if own:
                out[place[own], column] += prod(c for _, c in chosen)
    return out


def fold_sums(
    folded: DataFrame, features: Sequence[str], target: str, terms: list[tuple[int, ...]], shift: np.ndarray, scale: np.ndarray
) -> dict[int, np.ndarray]:
    """Per fold the cross products of (1, monomials, label) of the shifted and scaled features and label."""
    width = len(terms) + 2
    rows = folded.select(F.col("fold").cast("int").alias("fold"), *[q_col(c).cast("double").alias(f"f{i}") for i, c in enumerate((*features, target))])

    def add_up(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("a feature or the target is missing in some row; fill or drop these rows first")
            fold = batch.column(0).to_numpy()
            x = (np.column_stack([c.to_numpy() for c in batch.columns[1:]]) - shift) / scale
            z = np.column_stack((np.ones(len(x)), _design(x[:, :-1], terms), x[:, -1]))
            for f in np.unique(fold).tolist():
                own = z[fold == f]
                sums[f] = sums.get(f, 0.0) + own.T @ own
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["fold", "sums"])

    def meet(key, table):
        total = sum(np.frombuffer(b.as_py()) for b in table.column(1))
        return pa.table({"fold": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(add_up, "fold int, sums binary")
    found = parts.groupBy("fold").applyInArrow(meet, "fold int, sums binary").collect()  # one matrix per fold
    return {r["fold"]: np.frombuffer(r["sums"]).reshape(width, width) for r in found}


def ridge_error(train: np.ndarray, test: np.ndarray, plain: np.ndarray, y_scale: float, alpha: float) -> float:
    """Mean squared error, on the rows of ``test``, of the ridge on the rows of ``train`` with the first ``len(plain)`` monomials.

    The penalty on plain coefficients joins the least squares as rows of its own, which keeps the digits that normal equations lose.
    """
    use = np.r_[0 : len(plain) + 1, len(train) - 1]
    a, b = train[np.ix_(use, use)], test[np.ix_(use, use)]
    n, mean = a[0, 0], a[0, 1:] / a[0, 0]
    centred = a[1:, 1:] - n * np.outer(mean, mean)
    value, vector = np.linalg.eigh(centred[:-1, :-1])
    good = value > value.max(initial=0.0) * 1e-13
    root = np.sqrt(value[good])
    rows = np.vstack(((vector[:, good] * root).T, np.sqrt(alpha) * plain))
    aim = np.concatenate((vector[:, good].T @ centred[:-1, -1] / root, np.zeros(len(plain))))
    slopes = np.linalg.lstsq(rows, aim, rcond=None)[0]
    line = np.concatenate(([mean[-1] - mean[:-1] @ slopes], slopes, [-1.0]))
    share = float(line @ b @ line / b[0, 0])
    return share * float(y_scale) ** 2 if share > ROUNDING else 0.0


def ridge_fold_errors(
    folded: DataFrame, k: int, features: Sequence[str], target: str, points: Sequence[Mapping[str, Any]]
) -> list[list[float | None]] | None:
    """Errors per setting and fold; None for a fold without rows or a setting wider than its ``max_terms``.

    None altogether where a setting is too wide for the sums: the caller then fits it.
    """
    chosen = {tuple(usable_subset(p.get("feature_subset"), features)) for p in points}
    if len(chosen) != 1:
        return None
    columns = list(chosen.pop())
    widths = [term_count(len(columns), p["degree"]) for p in points]
    limits = [term_limit(p.get("max_terms")) for p in points]
    feasible = [limit is None or w <= limit for limit, w in zip(limits, widths)]
    if not any(feasible):
        raise TooWide("no setting is feasible: all are wider than max_terms")
    most = max(w for w, ok in zip(widths, feasible) if ok)
    if most > GRAM_TERMS:
        return None
    terms = monomials(len(columns), max(p["degree"] for p, ok in zip(points, feasible) if ok))
    names = [*columns, target]
    row = folded.agg(*[f(q_col(c)).cast("double") for c in names for f in (F.avg, F.stddev_pop)]).first()
    shift, scale = (np.array([row[2 * i + j] or 0.0 for i in range(len(names))]) for j in (0, 1))
    scale = np.where(scale > 0, scale, 1.0)
    sums = fold_sums(folded, columns, target, terms, shift, scale)
    plain = plain_coefficients(terms, shift, scale)
    rest = {f: sum(s for g, s in sums.items() if g != f) for f in sums} if len(sums) > 1 else {}
    return [
        [ridge_error(rest[f], sums[f], plain[:w, :w], scale[-1], p["alpha"]) if ok and f in rest else None for f in range(k)]
        for p, w, ok in zip(points, widths, feasible)
    ]
