"""Numeric expressions whose null, zero and rounding behaviour is fixed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_even(value: Column, digits: int) -> Column:
    """Round the scaled double half-to-even, as array libraries do (not via decimals)."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def clipped(value: Column, low: float | None, high: float | None) -> Column:
    """Bound a value on either side; NULL stays NULL (``greatest`` would lose it)."""
    expr = F
    if low is not None:
        expr = expr.when(value < low, F.lit(float(low)))
    if high is not None:
        expr = expr.when(value > high, F.lit(float(high)))
    return value if expr is F else expr.otherwise(value)


def in_range(value: Column, low: float | None, high: float | None) -> Column:
    """Three-valued range test: NULL in, NULL out."""
    test = F.lit(True)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def unbiased_skewness(value: Column) -> Column:
    """Sample skewness with the usual small-sample factor; 0 for a constant, NULL below three values."""
    n = F.count(value).cast("double")
    # variance first: on a constant column the moment ratio has no value
    spread = F.var_pop(value)
    shape = F.when(spread > 0, F.skewness(value)).otherwise(F.lit(0.0))
    return F.when(n >= 3, shape * F.try_divide(F.sqrt(n * (n - 1)), n - 2))


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution function, after Wichura (AS 241, 1988)."""
    d = p - 0.5
    central = F.lit(0.180625) - d * d
    tail = F.sqrt(-F.ln(F.least(p, 1.0 - p)))
    near, far = tail - 1.6, tail - 5.0
    core = d * _polynomial(central, AS241_A) / _polynomial(central, AS241_B)
    outer = F.when(tail <= 5.0, _polynomial(near, AS241_C) / _polynomial(near, AS241_D)).otherwise(
        _polynomial(far, AS241_E) / _polynomial(far, AS241_F)
    )
    return F.when(F.abs(d) <= 0.425, core).otherwise(F.signum(d) * outer)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    value = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        value = value * x + c
    return value


# The published coefficients of AS 241, lowest power first.
AS241_A = (3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
           4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
AS241_B = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
           2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
AS241_C = (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
           1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
AS241_D = (1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1,
           1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
AS241_E = (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1,
           2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
AS241_F = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
           7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)
