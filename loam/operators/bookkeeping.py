"""Result bookkeeping: de-duplication, coverage, legend breaks, sampling, writing."""

from __future__ import annotations

import re
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.numeric import round3

# Output-table suffix per aggregation method.
METHOD_SUFFIX = {
    "Dominant Component (Category)": "_dom_comp_cat",
    "Dominant Component (Numeric)": "_dom_comp_num",
    "Dominant Condition": "_dom_cond",
    "Weighted Average": "_wtd_avg",
    "Min\\Max": "_min_max",
    "Dominant Component": "_dom_comp",
}
NOT_RATED_BREAK = " Not Rated"


def dedupe_last(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per ``key``: the row with the highest ``order_col`` (later wins).

    ``max_by`` aggregates partially on each task, so a key repeated very
    often never gathers all its rows in one place.
    """
    others = [c for c in df.columns if c != key]
    # of rows with one order value, the greatest row wins
    row = F.struct(*[F.col(c) for c in others])
    best = F.max_by(row, F.struct(F.col(order_col), row)).alias("_b")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in others])


def coverage_report(areas: DataFrame, requests: Sequence[str], result: DataFrame,
                    request_col: str = "request") -> DataFrame:
    """Requested (area, request) pairs for which the result holds no row.

    The request list is a parameter and is expanded per area with
    ``explode`` (no cross join); the answered pairs are a distinct projection
    of the result.
    """
    wanted = areas.select("areasymbol", F.explode(F.array(*[F.lit(r) for r in requests])).alias(request_col))
    if request_col in result.columns:
        answered = result.select("areasymbol", request_col).distinct()
    else:
        answered = result.select("areasymbol").distinct().select(
            "areasymbol", F.explode(F.array(*[F.lit(r) for r in requests])).alias(request_col))
    return wanted.join(answered, ["areasymbol", request_col], "left_anti")


def legend_breaks(result: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a result column for map symbology.

    Numbers are rounded to 3 places with NULL as -1; text keeps its value
    with NULL as ' Not Rated'.
    """
    dtype = dict(result.dtypes)[col]
    if dtype in ("string",):
        v = F.coalesce(F.col(col), F.lit(NOT_RATED_BREAK))
    else:
        v = F.coalesce(round3(F.col(col)), F.lit(-1.0))
    return result.select(v.alias("break_value")).distinct().orderBy("break_value")


def sample_hash(id_col: Column, seed: int = 0) -> Column:
    """Deterministic pseudo-random rank of a row: the MD5 of its whole id and the seed."""
    return F.md5(F.concat_ws("|", id_col.cast("string"), F.lit(str(seed))))


def sample_features(df: DataFrame, id_col: str, n: int = 50, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows without replacement (all rows if fewer), the same on every run.

    The limit is the feature here.  ``orderBy(...).limit(n)`` plans as a
    per-partition top-n followed by one small merge.
    """
    ident = F.col(id_col).cast("bigint")
    return df.orderBy(sample_hash(ident, seed), ident).limit(n)


def table_name(label: str, method: str, top: int | None = None, bottom: int | None = None,
               stat: str | None = None, prefix: str = "tbl_") -> str:
    """Output table name: cleaned label + method suffix (+ depth range or MIN/MAX where the request has one)."""
    base = re.sub(r"[^0-9A-Za-z_]", "_", label)
    base = re.sub(r"_+", "_", base)
    if base[:1].isdigit():
        base = "x" + base
    name = prefix + base + METHOD_SUFFIX[method]
    if method in ("Weighted Average", "Dominant Component (Numeric)") and top is not None:
        name += f"_{top}_{bottom}"
    elif method == "Min\\Max":
        name += "_" + (stat or "").upper()
    return name


def unique_names(labels: Sequence[str], names: Sequence[str]) -> dict[str, str]:
    """Table name of each label; labels that clean to one name get a checksum of the label after it."""
    shared = {n for n in names if list(names).count(n) > 1}
    return {lab: f"{n}_{zlib.crc32(lab.encode()):08x}" if n in shared else n for lab, n in zip(labels, names)}


def write_result(df: DataFrame, path: str, sort_key: str = "mukey", mode: str = "overwrite") -> None:
    """One table per property / rule as Parquet, rows sorted by key within each file."""
    df.sortWithinPartitions(sort_key).write.mode(mode).parquet(path)


RUNS = "_runs"


def write_areas(df: DataFrame, path: str, areas: Sequence[str], run: str, sort_key: str = "mukey") -> None:
    """Write the rows of ``areas`` into a table with a folder per survey area; other areas' rows stay.

    Folders of the written areas are replaced as a whole when the job commits
    (dynamic partition overwrite), so a run that fails leaves the table as it
    was and a run repeated gives the same table.  An area of the list without
    rows loses its folder.  Rows of areas that aren't listed raise.  Each run
    that ended leaves a marker (:func:`finished_runs`).
    """
    spark, wanted = df.sparkSession, list(dict.fromkeys(areas))
    stranger = F.raise_error(F.concat(F.lit("area was not asked for: "), F.coalesce("areasymbol", F.lit("NULL"))))
    checked = df.withColumn("areasymbol", F.when(F.col("areasymbol").isin(wanted), F.col("areasymbol")).otherwise(stranger))
    out = checked.repartition("areasymbol").sortWithinPartitions("areasymbol", sort_key)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("areasymbol").parquet(path)
    written = {r.areasymbol: r.n for r in read_areas(spark, path, df.schema).where(F.col("areasymbol").isin(wanted))
               .groupBy("areasymbol").agg(F.count(F.lit(1)).alias("n")).collect()}
    held = {r.areasymbol for r in df.select("areasymbol").distinct().collect()}
    for area in wanted:
        if area not in held:
            _remove(spark, f"{path.rstrip('/')}/areasymbol={area}")
    marks = [(run, a, written.get(a, 0) if a in held else 0) for a in wanted]
    spark.createDataFrame(marks, "run string, areasymbol string, n_rows long").coalesce(1).write.mode("overwrite").parquet(
        f"{path.rstrip('/')}/{RUNS}/run={run}")


def _remove(spark, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_areas(spark, path: str, schema) -> DataFrame:
    """A table of :func:`write_areas`; folders of marks are not read (Spark passes over names with a leading ``_``)."""
    return spark.read.schema(schema).parquet(path)


def finished_runs(spark, path: str) -> DataFrame:
    """``run, areasymbol, n_rows`` of every run of :func:`write_areas` that ended."""
    return spark.read.schema("areasymbol string, n_rows long, run string").parquet(f"{path.rstrip('/')}/{RUNS}").select(
        "run", "areasymbol", "n_rows")
