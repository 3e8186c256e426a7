"""Soil tables stored as Parquet: read under declared schemas, write a derived set."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loam.schemas import SOIL_SCHEMAS

AREA = "areasymbol"
AREA_TABLES = ("mapunit", "component", "chorizon", "chtexturegrp", "cointerp", "copmgrp")

# Sort keys inside each file so Parquet min/max statistics prune row groups
# for the usual filters (rule name and depth on cointerp, keys elsewhere).
SORT_KEYS = {
    "cointerp": ["mrulename", "ruledepth", "cokey"],
    "component": ["mukey"],
    "chorizon": ["cokey"],
    "chtexturegrp": ["chkey"],
    "mapunit": ["lkey", "mukey"],
}


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, in whatever file system its URI names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def table_path(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def _by_area(spark: SparkSession, path: str) -> bool:
    """Whether a stored table has one folder per survey area."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    return any(f.getPath().getName().startswith(f"{AREA}=") for f in found)


def read_soil_tables(spark: SparkSession, path: str, names=None, areas=None) -> dict[str, DataFrame]:
    """Load the hierarchy tables under ``path`` (one Parquet folder per table) with declared schemas.

    ``path`` may be a URI of any file system.  Named tables must exist; by
    default all that exist are read, and at least one must.  ``areas`` (exact
    survey areas) leaves out the folders of other areas in tables that are
    stored by area.
    """
    found = [n for n in (names or SOIL_SCHEMAS) if _exists(spark, table_path(path, n))]
    missing = [n for n in (names or []) if n not in found]
    if missing or not found:
        raise FileNotFoundError(f"no soil tables {missing or sorted(SOIL_SCHEMAS)} under {path}")
    out = {}
    for n in found:
        where, schema = table_path(path, n), SOIL_SCHEMAS[n]
        if n in AREA_TABLES and _by_area(spark, where):
            df = spark.read.schema(StructType([*schema.fields, StructField(AREA, StringType())])).parquet(where)
            out[n] = (df if areas is None else df.filter(F.col(AREA).isin(list(areas)))).drop(AREA)
        else:
            out[n] = spark.read.schema(schema).parquet(where)
    return out


def area_keys(tables: dict[str, DataFrame]) -> dict[str, tuple[str, DataFrame]]:
    """For each table that is stored by area: its key column, and the area of each key."""
    units = tables["mapunit"].join(tables["legend"], "lkey").select("mukey", AREA)
    comps = tables["component"].join(units, "mukey").select("cokey", AREA)
    keys = {"mapunit": ("mukey", units), "component": ("mukey", units)}
    keys |= {n: ("cokey", comps) for n in ("chorizon", "cointerp", "copmgrp")}
    if "chorizon" in tables:
        keys["chtexturegrp"] = ("chkey", tables["chorizon"].join(comps, "cokey").select("chkey", AREA))
    return keys


def write_soil_tables(tables: dict[str, DataFrame], path: str, files: int | None = None,
                      rows_per_file: int = 5_000_000, by_area: bool = False) -> None:
    """Write each table as Parquet (overwrite), sorted within files by its filter keys.

    Rows are dealt out over ``files`` tasks (twice the default parallelism
    unless given) by ranges of the sort key, and a task starts a new file after
    ``rows_per_file`` rows, so files grow in number and not in size with the
    data.  Columns that a table lacks are NULL.  ``by_area`` gives the tables
    of the hierarchy a folder per survey area, so that a request for some
    areas reads only theirs.
    """
    keys = area_keys(tables) if by_area else {}
    for name, df in tables.items():
        n = files or 2 * df.sparkSession.sparkContext.defaultParallelism
        cols = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SOIL_SCHEMAS[name].fields
        ]
        out = df.select(*cols)
        order = SORT_KEYS.get(name, [])
        if name in keys:
            key, of = keys[name]
            out = out.join(of, key, "left")
            order = [AREA, *order]
        if order:
            out = out.repartitionByRange(n, *order).sortWithinPartitions(*order)
        else:
            out = out.repartition(n)
        writer = out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
        (writer.partitionBy(AREA) if name in keys else writer).parquet(table_path(path, name))


# The key that each table of the hierarchy is bucketed by; texture groups get their component's key for it.
BUCKET_KEYS = {"component": "cokey", "chorizon": "cokey", "chtexturegrp": "cokey", "cointerp": "cokey", "copmgrp": "cokey"}


def write_bucketed_tables(tables: dict[str, DataFrame], path: str, buckets: int) -> None:
    """Store the tables of :data:`BUCKET_KEYS` in ``buckets`` buckets by component key, sorted by it within each.

    Joins and rollups by component then need no shuffle.  ``chtexturegrp`` is
    stored with the ``cokey`` of its horizon; texture rows without a horizon
    are left out, as no rollup meets them.
    """
    for name, key in BUCKET_KEYS.items():
        if name not in tables:
            continue
        df = tables[name]
        cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SOIL_SCHEMAS[name].fields]
        out = df.select(*cols)
        if name == "chtexturegrp":
            out = out.join(tables["chorizon"].select("chkey", "cokey"), "chkey")
        out = out.repartition(buckets, key)
        table = _bucket_table(path, name, buckets)
        out.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", table_path(path, name)).saveAsTable(table)


def _bucket_table(path: str, name: str, buckets: int) -> str:
    return f"loam_{name}_{buckets}_{zlib.crc32(path.encode()):08x}"


def read_bucketed_tables(spark: SparkSession, path: str, buckets: int) -> dict[str, DataFrame]:
    """The tables of :func:`write_bucketed_tables`, known to the session as bucketed (a catalogue entry over the files)."""
    out = {}
    for name, key in BUCKET_KEYS.items():
        where = table_path(path, name)
        if not _exists(spark, where):
            continue
        fields = list(SOIL_SCHEMAS[name].fields) + ([StructField("cokey", StringType())] if name == "chtexturegrp" else [])
        table = _bucket_table(path, name, buckets)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
                  f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{where}'")
        out[name] = spark.table(table)
    return out


class SoilTables:
    """Attribute access to stored soil tables, shaped like the fixture object the plans take."""

    def __init__(self, spark: SparkSession, path: str, areas=None):
        self._t = read_soil_tables(spark, path, areas=areas)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["_t"][name]
        except KeyError as exc:
            raise AttributeError(name) from exc

    def report_lines(self, form: str = "project") -> DataFrame:
        return self._t[f"report_lines_{form}"]

    def catalog_lines(self) -> DataFrame:
        return self._t["catalog_lines"]


def fixture_tables(fx) -> dict[str, DataFrame]:
    """Every table a plan reads, from a fixture object (for materialising a soil database)."""
    out = dict(fx.tables())
    out["report_lines_project"] = fx.report_lines("project")
    out["report_lines_area"] = fx.report_lines("area")
    out["catalog_lines"] = fx.catalog_lines()
    return out
