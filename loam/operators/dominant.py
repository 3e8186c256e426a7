"""Dominant component of each map unit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dominance_columns() -> list[Column]:
    """Highest comppct_r first, NULL percent last, tie -> lowest cokey.

    A leading NULL flag is needed because NULL sorts first inside a struct.
    """
    return [F.col("comppct_r").isNull(), -F.col("comppct_r"), F.col("cokey")]


def dominance_order() -> Column:
    """:func:`dominance_columns` as one value."""
    return F.struct(*dominance_columns())


def dominant_component(component: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """One row per map unit: the dominant component's ``cokey`` and ``cols``.

    ``min`` is an ordinary aggregate, so each map task pre-aggregates its
    rows before the shuffle on ``mukey`` (a huge map unit costs one row per
    task, not all its components in one task).  The key moves once, in the
    order itself.  All components compete, not only the major ones.
    """
    cols = [c for c in cols if c not in ("mukey", "cokey")]
    none, pct, cokey = dominance_columns()
    first = F.min(F.struct(none.alias("_none"), pct.alias("_pct"), cokey, *[F.col(c) for c in cols]))
    return component.groupBy("mukey").agg(first.alias("_d")).select("mukey", *[F.col(f"_d.{c}").alias(c) for c in ["cokey", *cols]])
