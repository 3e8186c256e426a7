"""Report ratings: merge of the two rating kinds, validation, reconciliation, kind check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.sources.reports import report_split_area, report_split_project

UNKNOWN = "UNK"
MERGED_COLUMNS = ["report_id", "mukey", "int_mukey", "n_rating", "n_class", "n_type", "n_kind", "m_rating",
                  "m_class", "m_type", "m_kind"]


def merge_ratings_wide(wide: DataFrame) -> DataFrame:
    """Merge from the one-pass parse: keys with a non-MLRA line; a missing MLRA side is 'UNK' x4."""
    m_cols = [("m_rating", "m_rating"), ("m_class", "m_class"), ("m_type", "m_mukind"), ("m_kind", "m_kind")]
    return wide.filter(F.col("has_n")).select(
        "report_id", "mukey", F.col("mukey").try_cast("bigint").alias("int_mukey"),
        "n_rating", "n_class", F.col("n_mukind").alias("n_type"), "n_kind",
        *[F.when(F.col("has_m"), F.col(src)).otherwise(F.lit(UNKNOWN)).alias(dst) for dst, src in m_cols],
    )


def drop_malformed(framed: DataFrame, form: str = "project") -> DataFrame:
    """Record lines of a report that its parse leaves out, with the reason.

    Project form: lines of either rating kind.  Area form: every framed line,
    so the header (a key that is no number) shows too.  A key that is no
    number comes before a lack of fields.
    """
    if form not in ("project", "area"):
        raise ValueError(f"unknown report form: {form}")
    rows = (report_split_project if form == "project" else report_split_area)(framed).filter(~F.col("ok"))
    reason = F.when(F.col("mukey").try_cast("bigint").isNull(), F.lit("non-numeric key")).otherwise(
        F.lit("too few fields")
    )
    return rows.select("report_id", "line_no", "line", reason.alias("reason"))


def key_reconcile(report_keys: DataFrame, local_keys: DataFrame) -> DataFrame:
    """Keys present on one side only, per area, both directions.

    ``report_keys`` and ``local_keys`` carry (areasymbol, mukey); the result
    has (areasymbol, mukey, side) with side 'report_only' or 'local_only'.
    """
    r = report_keys.select("areasymbol", "mukey").distinct().withColumn("_r", F.lit(True))
    lo = local_keys.select("areasymbol", "mukey").distinct().withColumn("_l", F.lit(True))
    j = r.join(lo, ["areasymbol", "mukey"], "full_outer").filter(F.col("_r").isNull() | F.col("_l").isNull())
    side = F.when(F.col("_l").isNull(), F.lit("report_only")).otherwise(F.lit("local_only"))
    return j.select("areasymbol", "mukey", side.alias("side"))


def single_kind(framed: DataFrame) -> DataFrame:
    """Per report: the one kind all lines share ('Limitation' tested first, then 'Suitability'), else NULL."""
    kind = F.when(F.col("line").contains("Limitation"), F.lit("Limitation")).when(
        F.col("line").contains("Suitability"), F.lit("Suitability")
    )
    g = framed.select("report_id", kind.alias("k")).groupBy("report_id").agg(
        F.min("k").alias("_lo"), F.max("k").alias("_hi")
    )
    return g.select("report_id", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("kind"))
