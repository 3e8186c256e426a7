"""Hydric rating of a map unit from its component counts (ordered rules)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HYDRIC_COUNT_COLUMNS = ["comp_count", "count_maj_comp", "all_hydric", "maj_hydric", "maj_not_hydric",
                        "hydric_inclusions", "all_not_hydric", "hydric_null"]


def hydric_rating(c=F.col) -> Column:
    """First matching rule wins; 'Error' is kept verbatim."""
    # The ratings and the order and bounds of their rules.
    return (
        F.when(c("comp_count") == c("all_not_hydric") + c("hydric_null"), F.lit("Nonhydric"))
        .when(c("comp_count") == c("all_hydric"), F.lit("Hydric"))
        .when((c("comp_count") != c("all_hydric")) & (c("count_maj_comp") == c("maj_hydric")),
              F.lit("Predominantly Hydric"))
        .when((c("hydric_inclusions") >= 0.5) & (c("maj_hydric") < 0.5), F.lit("Predominantly Nonhydric"))
        .when((c("maj_not_hydric") >= 0.5) & (c("maj_hydric") >= 0.5), F.lit("Partially Hydric"))
        .otherwise(F.lit("Error"))
    )
