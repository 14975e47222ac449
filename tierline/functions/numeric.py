"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, Veltkamp splitting constant
_EXACT_LIMIT = 4503599627370496.0  # 2**52: above it a double has no fractional part


def _split(v: float) -> tuple[float, float]:
    c = _SPLIT * v
    hi = c - (c - v)
    return hi, v - hi


def round_half_even(col: Column, digits: int) -> Column:
    """Fast half-even rounding of ``x * 10^d`` (``rint``), used to normalise
    floating outputs. Not exactly Python's ``round`` (see :func:`py_round`)."""
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def py_round(col: Column, digits: int) -> Column:
    """Python's ``round(x, digits)`` on doubles, exactly, as column arithmetic.

    Python rounds the exact binary value half to even (2.675 -> 2.67, since the
    double lies below 2.675), while ``rint(x * 10^d)`` sees the already rounded
    product (267.5 -> 2.68). The exact residual of ``x * 10^d`` is recovered
    with Dekker's error-free product; it decides every case where the rounded
    product sits on a half. The quotient k / 10^d is then correctly rounded,
    as Python's decimal-string conversion is.
    """
    p = float(10 ** digits)
    ph, pl = _split(p)
    x = col.cast("double")
    c = x * F.lit(_SPLIT)
    xh = c - (c - x)
    xl = x - xh
    y = x * F.lit(p)
    err = ((xh * F.lit(ph) - y) + xh * F.lit(pl) + xl * F.lit(ph)) + xl * F.lit(pl)
    f = F.floor(y).cast("double")
    t = (y - f) - F.lit(0.5)
    up = (F.when(t > 0, True).when(t < 0, False).when(err > 0, True).when(err < 0, False)
          .otherwise(f % 2.0 != 0))
    k = f + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))
    rounded = F.when(k == 0, x * F.lit(0.0)).otherwise(k / F.lit(p))
    return F.when(F.abs(y) < F.lit(_EXACT_LIMIT), rounded).otherwise(x)


def inverse(col: Column) -> Column:
    """1/x, NULL for x = 0 instead of an ANSI division error."""
    return F.try_divide(F.lit(1.0), col.cast("double"))
