"""Property catalogue: label -> property code lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.schemas import PROPERTY_LABELS

def property_catalog(lines: DataFrame) -> DataFrame:
    """Catalogue from ``code,label`` text lines (``line_no``, ``line``).

    Double blanks collapse to one (one pass), ``#`` reads ``no. ``, the line
    is split on its first comma; a label seen twice keeps the later line.
    Sorted by label.
    """
    clean = F.replace(F.replace(F.col("line"), F.lit("  "), F.lit(" ")), F.lit("#"), F.lit("no. "))
    rows = lines.select("line_no", clean.alias("_l")).filter(F.instr("_l", ",") > 0).select(
        "line_no",
        F.substring_index("_l", ",", 1).alias("code"),
        F.expr("substring(_l, instr(_l, ',') + 1)").alias("label"),
    )
    best = rows.groupBy("label").agg(F.max_by("code", "line_no").alias("code"))
    return best.orderBy("label")


def catalog_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PROPERTY_LABELS, "label string, code string")


def resolve_property(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Attach the property code to each requested ``label``; ``code`` is NULL for an unknown label.

    The caller reports or rejects the NULL rows (the tools stop on an unknown label).
    """
    return requests.join(catalog.select("label", "code"), "label", "left")
