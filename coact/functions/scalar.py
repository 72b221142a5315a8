"""Scalar Column functions used by the weighting and prediction operators.

All are compositions of built-in expressions, so they run inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log1p_abs(x: Column) -> Column:
    """``ln(1 + |x|)`` (the sign is dropped)."""
    return F.log1p(F.abs(x))


def signed_log1p(x: Column) -> Column:
    """``sgn(x) * ln(1 + |x|)``."""
    return F.signum(x) * F.log1p(F.abs(x))


def entropy_term(p: Column, n: Column | float) -> Column:
    """``-|p| ln|p| / ln(n)`` — one summand of the normalised entropy; 0 where n is 1."""
    nn = n if isinstance(n, Column) else F.lit(float(n))
    return F.when(nn == 1, F.lit(0.0)).otherwise(safe_div(-F.abs(p) * F.log(F.abs(p)), F.log(nn)))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of failing on a zero divisor (ANSI mode)."""
    return F.try_divide(num, den)
