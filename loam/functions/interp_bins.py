"""Class bands of a weighted interpretation rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels per rule direction, lowest band first.  Four of the
# five limitation labels carry a trailing blank in the reference output.
SUITABILITY_LABELS = ["Not suited", "Poorly suited", "Moderately suited", "Moderately well suited", "Well suited"]
LIMITATION_LABELS = ["Not limited ", "Slightly limited ", "Somewhat limited ", "Moderately limited ", "Very limited"]
NOT_RATED = "Not Rated"


def interp_design(ruledesign: Column) -> Column:
    return F.when(ruledesign == 1, F.lit("limitation")).when(ruledesign == 2, F.lit("suitability"))


def interp_class_bins(raw_rating: Column, ratio: Column, design: Column) -> Column:
    """Band of ``ratio`` (already rounded to 2 places); NULL ``raw_rating`` -> Not Rated.

    Bands: <= 0, (0.001, 0.333], (0.334, 0.666], (0.667, 0.999], = 1; anything
    else (e.g. > 1, or a NULL ratio) has no class.
    """
    out = F.when(raw_rating.isNull(), F.lit(NOT_RATED))
    for name, labels in (("suitability", SUITABILITY_LABELS), ("limitation", LIMITATION_LABELS)):
        d = design == name
        out = (
            out.when(d & (ratio <= 0), F.lit(labels[0]))
            .when(d & (ratio > 0.001) & (ratio <= 0.333), F.lit(labels[1]))
            .when(d & (ratio > 0.334) & (ratio <= 0.666), F.lit(labels[2]))
            .when(d & (ratio > 0.667) & (ratio <= 0.999), F.lit(labels[3]))
            .when(d & (ratio == 1), F.lit(labels[4]))
        )
    return out
