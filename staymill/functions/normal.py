"""Inverse of the standard normal distribution as a column expression (Wichura, AS 241, 1988)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: the published PPND16 coefficients, lowest power first -------
_CENTRE = (
    [3.3871328727963666080, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3],
    [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3],
)
_NEAR = (
    [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
     1.27045825245236838258, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187, 1.67638483018380384940, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9],
)
_FAR = (
    [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15],
)
# ------------------------------------------------------------------------------


def _poly(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))


def _ratio(pair: tuple, x: Column) -> Column:
    return _poly(pair[0], x) / _poly(pair[1], x)


def normal_quantile(p: Column) -> Column:
    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(tail <= 5, _ratio(_NEAR, tail - 1.6)).otherwise(_ratio(_FAR, tail - 5))
    return F.when(F.abs(q) <= 0.425, q * _ratio(_CENTRE, F.lit(0.180625) - q * q)).otherwise(F.when(q < 0, -outer).otherwise(outer))


def normal_quantile_sql(p: str) -> str:
    """The same as a SQL expression over a column name."""

    def number(c: float) -> str:
        return f"CAST({c!r} AS DOUBLE)"

    def ratio(pair: tuple, x: str) -> str:
        top, bottom = (reduce(lambda acc, c: f"({acc} * {x} + {number(c)})", reversed(cs[:-1]), number(cs[-1])) for cs in pair)
        return f"{top} / {bottom}"

    tail = f"sqrt(-ln(least({p}, 1 - {p})))"
    q = f"({p} - CAST(0.5 AS DOUBLE))"
    outer = f"CASE WHEN {tail} <= 5 THEN {ratio(_NEAR, f'({tail} - {number(1.6)})')} ELSE {ratio(_FAR, f'({tail} - 5)')} END"
    return f"CASE WHEN abs({q}) <= {number(0.425)} THEN {q} * {ratio(_CENTRE, f'({number(0.180625)} - {q} * {q})')} WHEN {q} < 0 THEN -({outer}) ELSE {outer} END"
