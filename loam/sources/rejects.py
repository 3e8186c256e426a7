"""One channel for records that a decoder refuses: where from, which, the record itself, why."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["decoder", "source", "position", "record", "reason"]


def channel(df: DataFrame, decoder: str, source: Column | str, position: Column | str | None, record: Column | str,
            reason: Column | str) -> DataFrame:
    """Refused records of one decoder in the channel's shape; ``position`` may be unknown (NULL)."""
    at = F.lit(None) if position is None else F.col(position) if isinstance(position, str) else position
    named = lambda c: F.col(c) if isinstance(c, str) else c
    return df.select(F.lit(decoder).alias("decoder"), named(source).alias("source"), at.cast("bigint").alias("position"),
                     named(record).alias("record"), named(reason).alias("reason"))


def report_channel(rejects: DataFrame, form: str) -> DataFrame:
    """Rejected report lines (see ``operators.reports.drop_malformed``) in the channel's shape."""
    return channel(rejects, f"report {form}", "report_id", "line_no", "line", "reason")


def all_rejects(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
