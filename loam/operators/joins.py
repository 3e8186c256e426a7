"""Hierarchy joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mapunit_frame(legend: DataFrame, mapunit: DataFrame) -> DataFrame:
    """legend x mapunit: one row per map unit with its area and an integer key copy.

    No hint: the legend (one row per survey area) is broadcast by Spark's
    own size check -- the Parquet size estimate at planning and the shuffle
    statistics under AQE, both against ``spark.sql.autoBroadcastJoinThreshold``
    -- and joined by sort-merge beyond it.
    """
    lg = legend.select("lkey", "areasymbol")
    return mapunit.select("mukey", "lkey", "musym", "muname").join(lg, "lkey", "inner").select(
        "areasymbol", "musym", "muname", "mukey", F.col("mukey").try_cast("bigint").alias("int_mukey")
    )


def polygon_attribute_join(polygons: DataFrame, result: DataFrame) -> DataFrame:
    """Append result columns to map-unit polygons (left join on mukey)."""
    extra = [c for c in result.columns if c not in polygons.columns or c == "mukey"]
    return polygons.join(result.select(*extra), "mukey", "left")


def polygon_extract(polygons: DataFrame, result: DataFrame) -> DataFrame:
    """Polygons whose map unit is in the result."""
    return polygons.join(result.select("mukey"), "mukey", "left_semi")
