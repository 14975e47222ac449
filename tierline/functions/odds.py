"""Bookmaker margin measures over decimal home/draw/away odds.

Three definitions are in use and kept apart:

* ``spread_fraction``  - implied probability sum minus one (fraction).
* ``spread_pct2``      - the same in percent, rounded to 2 decimals.
* ``overround_pct3``   - percent, 3 decimals, NULL when any odd is NULL or 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import inverse, py_round


def _implied_sum(home: Column, draw: Column, away: Column) -> Column:
    return inverse(home) + inverse(draw) + inverse(away)


def spread_fraction(home: Column, draw: Column, away: Column) -> Column:
    return _implied_sum(home, draw, away) - F.lit(1.0)


def spread_pct2(home: Column, draw: Column, away: Column) -> Column:
    return py_round((_implied_sum(home, draw, away) - F.lit(1.0)) * F.lit(100.0), 2)


def overround_pct3(home: Column, draw: Column, away: Column) -> Column:
    valid = (home != 0) & (draw != 0) & (away != 0)
    value = _implied_sum(home, draw, away) * F.lit(100.0) - F.lit(100.0)
    return F.when(valid, py_round(value, 3))
