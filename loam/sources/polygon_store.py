"""Map-unit polygons stored along a space-filling curve, with their boxes beside them.

Neighbours lie in the same row groups, whose least and greatest box
coordinates Parquet keeps; a reader that names the boxes it is interested in
skips the row groups elsewhere, and nobody parses the outlines to find boxes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loam.operators.aoi import BOX, with_boxes

#: Bits of each axis in the curve.
CURVE_BITS = 16
#: A run's AOIs are covered by at most so many boxes, which go into the scan's filter.
COVER_BOXES = 16
# The steps that put a zero between neighbouring bits of a 16-bit number.
_SPREAD = [(8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)]


def _spread(v: Column) -> Column:
    for by, mask in _SPREAD:
        v = v.bitwiseOR(F.shiftleft(v, by)).bitwiseAND(F.lit(mask).cast("long"))
    return v


def curve_key(x: Column, y: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Place of a point on a Z-order curve over ``bounds`` (minx, maxx, miny, maxy)."""
    minx, maxx, miny, maxy = bounds
    top = (1 << CURVE_BITS) - 1
    place = lambda v, lo, hi: F.least(F.greatest(F.floor((v - lo) / ((hi - lo) or 1.0) * top), F.lit(0)), F.lit(top)).cast("long")
    return _spread(place(x, minx, maxx)).bitwiseOR(F.shiftleft(_spread(place(y, miny, maxy)), 1))


def _middle(lo: str, hi: str) -> Column:
    return (F.col(lo) + F.col(hi)) / 2


def _bounds(boxes: DataFrame) -> tuple[float, float, float, float]:
    r = boxes.agg(F.min("minx"), F.max("maxx"), F.min("miny"), F.max("maxy")).first()
    return tuple(r) if r[0] is not None else (0.0, 1.0, 0.0, 1.0)


def write_polygons(polygons: DataFrame, path: str, files: int | None = None, group_bytes: int = 8 << 20) -> None:
    """Store polygons (``areasymbol, mukey, poly_id, wkt``) with boxes, ordered by the curve, in small row groups."""
    boxed = with_boxes(polygons)
    key = curve_key(_middle("minx", "maxx"), _middle("miny", "maxy"), _bounds(boxed))
    n = files or 2 * polygons.sparkSession.sparkContext.defaultParallelism
    out = boxed.withColumn("curve", key).repartitionByRange(n, "curve", "poly_id").sortWithinPartitions("curve", "poly_id")
    out.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(path)


def cover(points: DataFrame, most: int = COVER_BOXES) -> list[tuple[float, float, float, float]]:
    """At most ``most`` boxes (minx, maxx, miny, maxy) that cover every AOI's box; AOIs near one another share one."""
    boxes = points.groupBy("aoi_id").agg(F.min("x").alias("minx"), F.max("x").alias("maxx"),
                                         F.min("y").alias("miny"), F.max("y").alias("maxy"))
    keyed = boxes.withColumn("curve", curve_key(_middle("minx", "maxx"), _middle("miny", "maxy"), _bounds(boxes)))
    cuts = keyed.agg(F.percentile_approx("curve", [i / most for i in range(1, most)])).first()[0]
    if cuts is None:
        return []
    group = reduce(lambda a, b: a + b, [(F.col("curve") > c).cast("int") for c in cuts], F.lit(0))
    merged = keyed.groupBy(group.alias("g")).agg(F.min("minx"), F.max("maxx"), F.min("miny"), F.max("maxy"))
    return [tuple(r)[1:] for r in merged.collect()]


def near(polygons: DataFrame, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
    """Polygons whose box meets one of ``boxes``: a filter on plain columns, which reaches the Parquet scan."""
    meets = [(F.col("minx") <= b) & (F.col("maxx") >= a) & (F.col("miny") <= d) & (F.col("maxy") >= c) for a, b, c, d in boxes]
    return polygons.filter(reduce(lambda a, b: a | b, meets, F.lit(False)))


def read_polygons(spark: SparkSession, path: str, points: DataFrame | None = None) -> DataFrame:
    """Stored polygons with their boxes; with the outline ``points`` of AOIs, those of the row groups and boxes near them."""
    schema = "areasymbol string, mukey string, poly_id string, wkt string, " + ", ".join(f"{c} double" for c in BOX)
    stored = spark.read.schema(schema).parquet(path)
    return stored if points is None else near(stored, cover(points))
