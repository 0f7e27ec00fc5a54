"""Ridge regression on polynomial features, as a Spark ML pipeline."""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from ..schema import q_col, usable_subset

NORMAL_TERMS = 4096  # width up to which the normal equations are solved in one pass; iterations beyond
MAX_TERMS: int | None = None  # width up to which any setting is taken; None: no limit but the caller's


class TooWide(ValueError):
    """The expansion has more terms than the caller allows."""


def term_count(n_features: int, degree: int) -> int:
    """Monomials of degree 1 to ``degree`` in ``n_features`` variables."""
    return comb(n_features + degree, degree) - 1


def term_limit(max_terms: int | None) -> int | None:
    """The smaller of the caller's limit and ``MAX_TERMS``."""
    return min((n for n in (max_terms, MAX_TERMS) if n is not None), default=None)


def fit_polynomial_ridge(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    degree: int = 3,
    alpha: float = 1.0,
    feature_subset: Sequence[str] | None = None,
    out: str = "prediction",
    max_terms: int | None = None,
) -> PipelineModel:
    """Least squares plus ``alpha`` x squared length of the slopes; the intercept is free.

    Spark divides the squared error by the row count and scales the label to unit spread, so
    the penalty is given as alpha / n x stddev(label). One pass gathers the normal equations; an expansion
    too wide for them has the same objective minimised by L-BFGS. ``max_terms`` is the caller's own limit.
    """
    chosen = usable_subset(feature_subset, features)
    terms, limit = term_count(len(chosen), degree), term_limit(max_terms)
    if limit is not None and terms > limit:
        raise TooWide(f"{len(chosen)} features at degree {degree} expand to {terms} terms, more than {limit}")
    stats = df.agg(F.count("*").alias("n"), F.stddev_pop(q_col(label)).alias("sd")).first()
    penalty = alpha / stats["n"] * (stats["sd"] or 1.0)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=chosen, outputCol="_base", handleInvalid="error"),
            PolynomialExpansion(degree=degree, inputCol="_base", outputCol="_terms"),
            LinearRegression(
                featuresCol="_terms",
                labelCol=label,
                predictionCol=out,
                regParam=penalty,
                elasticNetParam=0.0,
                standardization=False,
                **({"solver": "normal"} if terms <= NORMAL_TERMS else {"solver": "l-bfgs", "maxIter": 1000, "tol": 1e-10}),
            ),
        ]
    ).fit(df)
