"""Vector algebra over array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def unit(v: Column) -> Column:
    """Length 1; a norm below 1e-12 counts as that. The norm is bound to a variable first, so it is computed once a vector."""
    length = F.array(F.greatest(norm(v), F.lit(1e-12)))
    return F.get(F.transform(length, lambda n: F.transform(v, lambda x: x.cast("double") / n)), 0)


def rounded(x: Column, digits: int) -> Column:
    """Rounded half away from zero; what rounds to zero keeps its sign, as in IEEE 754 and SQL engines that round doubles (Spark's own gives 0.0)."""
    return F.round(F.abs(x), digits) * F.signum(x)
