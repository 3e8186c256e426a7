"""Area-of-interest operators: AOI rings, polygon clipping, map units inside an AOI.

Outlines are cut into the cells of a grid, each cell marked as inside the AOI
or on its edge.  Polygons meet the cells by id and box; their WKT text (lon/lat)
is joined to the pairs afterwards.  A polygon whose cells all lie inside needs
no clip against the outline, and none at all where only its key is asked for;
the others are clipped exactly, in Arrow batches, once per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loam.functions.polygons import frame_of, intersection, outline_rows, parts_area, read_wkt, write_wkt
from loam.session import materialize, ship_package

DEFAULT_GRID_CELL = 0.1   # degrees


# ---------------------------------------------------------------------------
# rings and WKT
# ---------------------------------------------------------------------------
def aoi_rings(points: DataFrame) -> DataFrame:
    """Per AOI: ordered vertex arrays ``xs``, ``ys`` closed by repeating the first point.

    An AOI's points are one user-drawn outline, so collecting them per AOI is bounded.
    """
    pts = points.groupBy("aoi_id").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))).alias("_p"))
    xs = F.transform("_p", lambda p: p["x"])
    ys = F.transform("_p", lambda p: p["y"])
    return pts.select(
        "aoi_id",
        F.concat(xs, F.array(F.element_at(xs, 1))).alias("xs"),
        F.concat(ys, F.array(F.element_at(ys, 1))).alias("ys"),
    )


def ring_wkt(xs: Column, ys: Column) -> Column:
    pairs = F.arrays_zip(xs.alias("x"), ys.alias("y"))
    txt = F.transform(pairs, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(txt, ", "), F.lit("))"))


def aoi_ring(points: DataFrame) -> DataFrame:
    """Per AOI: point count and the closed ring as WKT polygon (an AOI without points yields nothing)."""
    r = aoi_rings(points)
    return r.select("aoi_id", (F.size("xs") - 1).cast("bigint").alias("n_points"),
                    ring_wkt(F.col("xs"), F.col("ys")).alias("wkt"))


def wkt_box(polygons: DataFrame) -> DataFrame:
    """``polygons`` with ``minx, maxx, miny, maxy`` of all rings of their WKT: one pass over the text."""
    numbers = F.translate(F.expr("substring(wkt, instr(wkt, '('))"), "()", "")
    points = F.split(F.trim(numbers), r"\s*,\s*")
    axis = lambda k: F.transform("_points", lambda p: F.split_part(p, F.lit(" "), F.lit(k)).try_cast("double"))
    cut = polygons.withColumn("_points", F.transform(points, lambda p: F.regexp_replace(p, r"\s+", " ")))
    cut = cut.select(*polygons.columns, axis(1).alias("_xs"), axis(2).alias("_ys"))
    return cut.select(*polygons.columns, F.array_min("_xs").alias("minx"), F.array_max("_xs").alias("maxx"),
                      F.array_min("_ys").alias("miny"), F.array_max("_ys").alias("maxy"))


BOX = ["minx", "maxx", "miny", "maxy"]


def with_boxes(polygons: DataFrame) -> DataFrame:
    """``polygons`` with their box, read from the text unless they carry it (see ``sources.polygon_store``)."""
    return polygons if set(BOX) <= set(polygons.columns) else wkt_box(polygons)


def _outline_cells(cell: float):
    """Grid cells of each outline: those that its edge passes, and those wholly inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for aoi, wkt in zip(batch.column("aoi_id").to_pylist(), batch.column("a_wkt").to_pylist()):
                for row in outline_rows(read_wkt(wkt), cell):
                    xs, inner = zip(*row[1])
                    n = len(xs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([aoi] * n, pa.int32()), pa.array(xs, pa.int64()), pa.array([row[0]] * n, pa.int64()),
                         pa.array(inner, pa.bool_())], names=["aoi_id", "_cx", "_cy", "inner"])

    return run


def aoi_cells(rings: DataFrame, cell: float) -> DataFrame:
    """``aoi_id, _cx, _cy, inner`` of every grid cell that an AOI touches."""
    return rings.select("aoi_id", "a_wkt").mapInArrow(_outline_cells(cell), "aoi_id int, _cx long, _cy long, inner boolean")


def aoi_pairs(polygons: DataFrame, rings: DataFrame, cell: float) -> DataFrame:
    """``aoi_id, poly_id, mukey, areasymbol, single, inside`` of the polygons whose box meets a cell of an AOI.

    ``single`` says that the polygon has one part, ``inside`` that all cells of its box lie inside the AOI.  Only ids,
    boxes and cells are shuffled; a small side is broadcast by Spark's own
    size check.  Pairs whose boxes merely touch, and polygons that lie in the
    AOI's box but in none of its cells, do not come out.
    """
    ident = ["poly_id", "mukey", "areasymbol", "single"]
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))
    boxes = with_boxes(polygons).withColumn("single", F.col("wkt").startswith("POLYGON")).select(*ident, *BOX)
    cells = (
        boxes.withColumn("_n", F.size(span("minx", "maxx")) * F.size(span("miny", "maxy")))
        .withColumn("_cx", F.explode(span("minx", "maxx"))).withColumn("_cy", F.explode(span("miny", "maxy")))
    )
    outlines = rings.select("aoi_id", F.array_min("xs").alias("a_minx"), F.array_max("xs").alias("a_maxx"),
                            F.array_min("ys").alias("a_miny"), F.array_max("ys").alias("a_maxy"))
    met = cells.join(aoi_cells(rings, cell), ["_cx", "_cy"]).groupBy("aoi_id", *ident, *BOX).agg(
        F.count_if("inner").alias("_inner"), F.max("_n").alias("_n"))
    overlap = ((F.col("minx") < F.col("a_maxx")) & (F.col("maxx") > F.col("a_minx"))
               & (F.col("miny") < F.col("a_maxy")) & (F.col("maxy") > F.col("a_miny")))
    return met.join(outlines, "aoi_id").where(overlap).select("aoi_id", *ident, (F.col("_inner") == F.col("_n")).alias("inside"))


CLIP_ROWS = 64


def _clip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clip each pair, to the outline or (none given: the polygon lies inside) as it is; no common area gives no row."""
    types = {"aoi_id": pa.int32(), "parts": pa.int32(), **{c: pa.float64() for c in ("area", "minx", "miny", "maxx", "maxy")}}
    names = ("aoi_id", "poly_id", "mukey", "areasymbol", "area", "minx", "miny", "maxx", "maxy", "wkt", "parts")
    for whole in batches:
        for start in range(0, whole.num_rows, CLIP_ROWS):
            out = {c: [] for c in names}
            outlines: dict[str, list] = {}
            for row in whole.slice(start, CLIP_ROWS).to_pylist():
                rings, frame = read_wkt(row["wkt"]), row["a_wkt"]
                if frame is not None and frame not in outlines:
                    outlines[frame] = read_wkt(frame)
                parts = intersection(rings, outlines[frame] if frame is not None else frame_of(rings))
                if not parts:
                    continue
                xs = [x for part in parts for x, _ in part[0]]
                ys = [y for part in parts for _, y in part[0]]
                found = {**{c: row[c] for c in ("aoi_id", "poly_id", "mukey", "areasymbol")}, "area": parts_area(parts),
                         "minx": min(xs), "miny": min(ys), "maxx": max(xs), "maxy": max(ys), "wkt": write_wkt(parts),
                         "parts": len(parts)}
                for c, v in found.items():
                    out[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(c, pa.string())) for c, v in out.items()], names=list(out))


def _rings_of(points: DataFrame) -> DataFrame:
    return aoi_rings(points).select("aoi_id", ring_wkt(F.col("xs"), F.col("ys")).alias("a_wkt"), "xs", "ys")


def _clip_pairs(pairs: DataFrame, polygons: DataFrame, rings: DataFrame) -> DataFrame:
    """The clip of each pair; polygons inside get no outline."""
    outlines = rings.select("aoi_id", "a_wkt", F.lit(False).alias("inside"))
    framed = pairs.select("aoi_id", "poly_id", "inside").join(outlines, ["aoi_id", "inside"], "left")
    return framed.drop("inside").join(polygons.select("poly_id", "mukey", "areasymbol", "wkt"), "poly_id").mapInArrow(
        _clip,
        "aoi_id int, poly_id string, mukey string, areasymbol string, area double, minx double, miny double, "
        "maxx double, maxy double, wkt string, parts int",
    )


def aoi_clip_parts(polygons: DataFrame, points: DataFrame, grid_cell: float = DEFAULT_GRID_CELL) -> DataFrame:
    """Map-unit polygons clipped to each AOI, with the number of ``parts`` of the result.

    Polygons (each with a ``poly_id`` of its own) may have holes and several
    parts; an AOI is any simple outline.  ``grid_cell`` (in map units) should
    be near the usual size of a polygon; results don't depend on it.
    """
    ship_package(polygons.sparkSession)
    rings = _rings_of(points)
    return _clip_pairs(aoi_pairs(polygons, rings, grid_cell), polygons, rings)


def aoi_clip(polygons: DataFrame, points: DataFrame, grid_cell: float = DEFAULT_GRID_CELL,
             single_part: bool = True) -> DataFrame:
    """Map-unit polygons intersecting each AOI, clipped to it.

    Output: aoi_id, poly_id, mukey, areasymbol, area, minx, miny, maxx, maxy,
    wkt.  With ``single_part`` a clip that falls apart into several pieces is
    left out, as the service keeps 'Polygon' results only (SURVEY Q19);
    :func:`aoi_clip_dropped` lists those.
    """
    parts = aoi_clip_parts(polygons, points, grid_cell)
    return (parts.filter("parts = 1") if single_part else parts).drop("parts")


def aoi_clip_dropped(polygons: DataFrame, points: DataFrame, grid_cell: float = DEFAULT_GRID_CELL) -> DataFrame:
    """The (AOI, polygon) pairs that ``aoi_clip`` leaves out, with area and number of parts."""
    parts = aoi_clip_parts(polygons, points, grid_cell)
    return parts.filter("parts > 1").select("aoi_id", "poly_id", "mukey", "areasymbol", "area", "parts")


def aoi_mukeys(clipped: DataFrame) -> DataFrame:
    """Distinct (aoi_id, mukey) of the clipped polygons: the key list for ``filter_mukeys``."""
    return clipped.select("aoi_id", "mukey").distinct()


def aoi_keys(polygons: DataFrame, points: DataFrame, grid_cell: float = DEFAULT_GRID_CELL,
             single_part: bool = True) -> DataFrame:
    """The key list of :func:`aoi_mukeys` without the clips that it can do without.

    A ``POLYGON`` whose cells all lie inside the AOI is in as it stands.  Of
    the others, only those are clipped whose map unit no such polygon has
    brought in.
    """
    ship_package(polygons.sparkSession)
    rings = _rings_of(points)
    pairs = materialize(aoi_pairs(polygons, rings, grid_cell))
    settled = F.col("inside") & F.col("single") if single_part else F.col("inside")
    sure = pairs.where(settled).select("aoi_id", "mukey").distinct()
    doubtful = pairs.where(~settled).join(sure, ["aoi_id", "mukey"], "left_anti")
    clipped = _clip_pairs(doubtful, polygons, rings)
    return sure.union(aoi_mukeys(clipped.filter("parts = 1") if single_part else clipped)).distinct()
