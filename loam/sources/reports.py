"""Line-based rating reports: framing and record parsing.

A report is one text file: noise, a line containing ``START``, records,
a line equal to ``STOP``, noise.  Lines are handled as a DataFrame
``(report_id, line_no, line)`` so many reports are framed and parsed in one
job; ``read_report_lines`` builds that shape from files (one report per
file, in byte ranges).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PROJECT_FIELDS = ["mukey", "skip", "rating", "class", "mukind", "kind"]
AREA_FIELDS = ["mukey", "musym", "rating", "class", "kind"]
NON_MLRA = "non-mlra map unit"
MLRA = "mmu"


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(report_id = file path, line_no from 0, line) for every line of every report file under ``path``.

    Files are read in byte ranges, so one large report is many tasks.  A line
    knows its range and its place among the range's rows; the lines of earlier
    ranges of its file, a prefix sum over one row per range, make that its
    number.  Lines end with ``\\n`` or ``\\r\\n``; a line break at the end of the
    file opens no further line.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("report_id"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_row"), F.regexp_replace("value", "\r$", "").alias("line"))
    ranges = raw.groupBy("report_id", "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("report_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    return raw.join(ranges, ["report_id", "_range"]).select(
        "report_id", (F.col("_before") + F.col("_row") - F.col("_first")).alias("line_no"), "line")


WHITESPACE = " \t\r\n\f\u000b"


def _strip(col: Column) -> Column:
    """Strip leading and trailing whitespace (a character-set trim, no regex)."""
    return F.trim(col, F.lit(WHITESPACE))


def report_extract(lines: DataFrame, min_lines: int | None = None) -> DataFrame:
    """Lines strictly between the first line containing START and the next line equal to STOP, stripped.

    Reports without a START line are invalid and yield nothing; with no STOP
    the frame runs to the end.  ``min_lines`` (2 for the area reports)
    drops reports with fewer framed lines.  One aggregate over the marker lines
    gives each report's bounds (and, over all lines, how many lie within),
    one join on the report brings them back: two reads of the lines.
    """
    t = lines.select("report_id", "line_no", _strip(F.col("line")).alias("line"))
    start = F.min(F.when(F.col("line").contains("START"), F.col("line_no"))).alias("_start")
    # marker lines only: a report holds a handful of them
    stops = F.collect_set(F.when(F.col("line") == "STOP", F.col("line_no"))).alias("_stops")
    marks = t.filter(F.col("line").contains("START") | (F.col("line") == "STOP")).groupBy("report_id").agg(start, stops)
    bounds = marks.filter(F.col("_start").isNotNull()).select(
        "report_id", "_start", F.array_min(F.filter("_stops", lambda x: x > F.col("_start"))).alias("_stop")
    )
    framed = t.join(bounds, "report_id", "inner").filter(
        (F.col("line_no") > F.col("_start")) & (F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop")))
    ).select("report_id", "line_no", "line")
    if min_lines:
        # the frame's grouping by report serves the count, no further read or shuffle
        near = Window.partitionBy("report_id").orderBy("line_no").rowsBetween(-(min_lines - 1), min_lines - 1)
        framed = framed.withColumn("_n", F.count(F.lit(1)).over(near)).filter(F.col("_n") >= min_lines).drop("_n")
    return framed


def _key_ok(key: Column) -> Column:
    return key.try_cast("bigint").isNotNull()


def report_split_project(framed: DataFrame) -> DataFrame:
    """Route and split project-form records.

    Quotes are removed; a line containing ``non-mlra map unit`` is a non-MLRA
    rating, else one containing ``mmu`` an MLRA rating, else it is dropped.
    Fields: key | (ignored) | rating | class | map-unit kind | kind (the
    sixth takes the rest of the line).  ``ok`` is false for a line with
    fewer than six fields or a non-numeric key (SURVEY Q20).
    """
    clean = F.replace(F.col("line"), F.lit('"'), F.lit(""))
    route = F.when(clean.contains(NON_MLRA), F.lit("non_mlra")).when(clean.contains(MLRA), F.lit("mlra"))
    parts = F.split(clean, r"\|", 6)
    routed = framed.select("report_id", "line_no", "line", route.alias("route"), parts.alias("_p")).filter(
        F.col("route").isNotNull()
    )
    ok = (F.size("_p") == 6) & _key_ok(F.get(F.col("_p"), 0))
    return routed.select(
        "report_id", "line_no", "line", "route", ok.alias("ok"),
        *[F.get(F.col("_p"), i).alias(name) for i, name in enumerate(PROJECT_FIELDS) if name != "skip"],
    )


def _last_wins(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per key: the fields of the line with the highest line number."""
    best = F.max_by(F.struct(*[F.col(f) for f in fields]), F.col("line_no")).alias("_b")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_b.{f}").alias(f) for f in fields])


PROJECT_VALUE_FIELDS = ["rating", "class", "mukind", "kind"]


def report_parse_project_wide(framed: DataFrame) -> DataFrame:
    """Both rating kinds per (report, key) in one aggregation: ``n_*`` non-MLRA, ``m_*`` MLRA; last line wins.

    ``max_by`` skips rows whose ordering value is NULL, so one pass keeps the
    last line of each kind without splitting the rows or joining them back.
    """
    rows = report_split_project(framed).filter("ok")
    val = F.struct(*[F.col(f) for f in PROJECT_VALUE_FIELDS])
    last = {
        p: F.max_by(val, F.when(F.col("route") == r, F.col("line_no"))).alias(p)
        for p, r in (("_n", "non_mlra"), ("_m", "mlra"))
    }
    g = rows.groupBy("report_id", "mukey").agg(*last.values())
    return g.select(
        "report_id", "mukey",
        F.col("_n").isNotNull().alias("has_n"), F.col("_m").isNotNull().alias("has_m"),
        *[F.col(f"{p}.{f}").alias(f"{p[1]}_{f}") for p in ("_n", "_m") for f in PROJECT_VALUE_FIELDS],
    )


def report_parse_project(framed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(non-MLRA ratings, MLRA ratings), last line wins per (report, key)."""
    wide = report_parse_project_wide(framed)
    out = []
    for p in ("n", "m"):
        side = wide.filter(F.col(f"has_{p}"))
        out.append(side.select("report_id", "mukey", *[F.col(f"{p}_{f}").alias(f) for f in PROJECT_VALUE_FIELDS]))
    return out[0], out[1]


def report_split_area(framed: DataFrame) -> DataFrame:
    """Fields of area-form lines; ``ok`` is false for fewer than five fields or a non-numeric key."""
    clean = F.replace(F.col("line"), F.lit('"'), F.lit(""))
    parts = F.split(clean, r"\|")
    out = framed.select("report_id", "line_no", "line", clean.alias("_clean"), parts.alias("_p"))
    ok = (F.size("_p") >= 5) & _key_ok(F.get(F.col("_p"), 0))
    return out.select("report_id", "line_no", "line", "_clean", ok.alias("ok"),
                      *[F.get(F.col("_p"), i).alias(name) for i, name in enumerate(AREA_FIELDS)])


def report_parse_area(framed: DataFrame) -> DataFrame:
    """Area-form records ``mukey|musym|rating|class|kind`` -> (mukey, int_mukey, rating, class, kind), last wins.

    Fields are split on ``|`` directly, so a comma inside a class is kept (SURVEY Q15).
    """
    rows = report_split_area(framed).filter("ok")
    last = _last_wins(rows, ["report_id", "mukey"], ["rating", "class", "kind"])
    return last.select("report_id", "mukey", F.col("mukey").try_cast("bigint").alias("int_mukey"), "rating", "class",
                       "kind")


def report_parse_area_batch(framed: DataFrame) -> DataFrame:
    """Batch area form: lines starting with a digit, five fields, a text key copy; no de-duplication."""
    rows = report_split_area(framed).filter(F.col("_clean").rlike("^[0-9]"))
    return rows.select("report_id", "line_no", F.col("mukey").try_cast("bigint").alias("mukey"), "musym", "rating",
                       "class", "kind", F.col("mukey").alias("str_mukey"))
