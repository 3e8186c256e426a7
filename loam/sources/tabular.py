"""Tabular responses: one ``<Table>`` element per record, child tag = column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loam.sources.rejects import channel


_BROKEN = "_broken_record"


def _read_xml(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """``source, record, _row`` per ``<Table>`` element, parsed one by one, so that a broken one takes no other with it.

    The text source cuts files at the closing tag (and splits large ones).
    """
    schema = StructType([StructField(c, StringType(), True) for c in [*columns, _BROKEN]])
    text = spark.read.option("lineSep", "</Table>").text(path).select(F.col("_metadata.file_path").alias("source"), "value")
    body = F.regexp_extract("value", r"(?s)<Table(?:\s[^>]*)?>(.*)", 1)
    found = text.filter(F.col("value").rlike(r"<Table[\s>]")).select("source", F.concat(F.lit("<Table>"), body, F.lit("</Table>")).alias("record"))
    parsed = F.from_xml("record", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN})
    return found.select("source", "record", parsed.alias("_row"))


def read_tabular_xml(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of saved tabular responses, every column as text, in ``columns`` order.

    Uses Spark's built-in XML parser with an explicit schema (no inference
    pass); a missing tag is NULL.  Records that can't be parsed are left out
    here and listed by :func:`tabular_xml_rejects`.
    """
    return _read_xml(spark, path, columns).filter(F.col(f"_row.{_BROKEN}").isNull()).select(*[F.col(f"_row.{c}").alias(c) for c in columns])


def tabular_xml_rejects(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Records of saved responses that aren't well-formed, in the shape of the reject channel."""
    df = _read_xml(spark, path, columns).filter(F.col(f"_row.{_BROKEN}").isNotNull())
    return channel(df, "tabular xml", "source", None, "record", F.lit("not well-formed"))


def cast_columns_lenient(df: DataFrame, text: Sequence[str], floats: Sequence[str], ints: Sequence[str]) -> DataFrame:
    """Typed conversion by three column lists; unparsable text -> NULL, empty text -> NULL.

    ``try_cast`` keeps ANSI mode on for everything else (a plain cast raises).
    """
    out = []
    for c in df.columns:
        if c in floats:
            out.append(F.col(c).try_cast("double").alias(c))
        elif c in ints:
            out.append(F.col(c).try_cast("int").alias(c))
        elif c in text:
            out.append(F.nullif(F.col(c), F.lit("")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
