"""Numeric conventions: two-place rounding of doubles and the decimal(5,2) chain.

``round2`` is the one rounding formula used on both sides of the oracle
(SURVEY 7.3): ratings are >= 0, so ``floor(x*100 + 0.5 + 1e-9) / 100`` rounds
half up on the decimal reading and is immune to the last-bit differences of
double sums taken in another order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEC52 = "decimal(5,2)"


def round2(col: Column) -> Column:
    return F.floor(col.cast("double") * F.lit(100.0) + F.lit(0.5) + F.lit(1e-9)) / F.lit(100.0)


def dec52(col: Column) -> Column:
    """``CAST(x AS decimal(5,2))``; under ANSI mode a value >= 1000 raises, as the server would."""
    return col.cast(DEC52)


def round3(col: Column) -> Column:
    return F.round(col.cast("double"), 3)
