"""AOI ring, exact clip against brute-force areas, multi-part results (Q19)."""

import math
import random
import time

import numpy as np
import pytest

from loam.functions.edge_grid import PointIndex
from loam.functions.polygons import inside, intersection, outline_rows, parts_area, read_wkt, write_wkt
from loam.operators import aoi as A
from loam.sources.polygon_store import cover, read_polygons, write_polygons


def _points(spark, aoi_id, pts):
    return spark.createDataFrame([(aoi_id, i + 1, float(x), float(y)) for i, (x, y) in enumerate(pts)],
                                 "aoi_id int, seq int, x double, y double")


def _polys(spark, rows):
    return spark.createDataFrame(rows, "areasymbol string, mukey string, poly_id string, wkt string")


def test_ring_closes(spark):
    got = A.aoi_ring(_points(spark, 7, [(0, 0), (2.5, 0), (0, 2)])).collect()[0]
    assert got.n_points == 3
    assert got.wkt == "POLYGON ((0.0 0.0, 2.5 0.0, 0.0 2.0, 0.0 0.0))"


def test_clip_triangle_area(spark):
    polys = _polys(spark, [
        ("A", "1", "1.1", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"),
        ("A", "2", "2.1", "POLYGON ((20 20, 30 20, 30 30, 20 30, 20 20))"),   # outside the bbox: pruned
        ("A", "3", "3.1", "POLYGON ((6 6, 9 6, 9 9, 6 9, 6 6))"),             # inside the bbox, outside the AOI
    ])
    aoi = _points(spark, 1, [(0, 0), (0, 10), (10, 0)])   # clockwise: orientation does not matter
    got = A.aoi_clip(polys, aoi).collect()
    assert [(r.mukey, r.area) for r in got] == [("1", pytest.approx(50.0))]
    assert (got[0].minx, got[0].miny, got[0].maxx, got[0].maxy) == (0.0, 0.0, 10.0, 10.0)


def _inside(rings, x, y):
    c = np.zeros_like(x, dtype=bool)
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if y1 != y2:
                c ^= ((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return c


SHAPES = {
    "concave": [[(1, 1), (9, 2), (8, 8), (5, 5), (2, 9)]],
    "square": [[(0, 0), (7, 0), (7, 7), (0, 7)]],
    "hole": [[(0, 0), (10, 0), (10, 10), (0, 10)], [(2, 2), (2, 8), (8, 8), (8, 2)]],
    "two parts": [[(0, 0), (4, 0), (4, 4), (0, 4)], [(6, 1), (9, 1), (9, 9), (6, 9)]],
    "L": [[(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10)]],
    "U": [[(0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9)]],
    "star": [[(5, 0), (6.5, 3.5), (10, 5), (6.5, 6.5), (5, 10), (3.5, 6.5), (0, 5), (3.5, 3.5)]],
    "sliver": [[(0.3, 4.7), (9.9, 5.2), (9.8, 5.6)]],
}

SHAPES_F = {k: [(float(x), float(y)) for x, y in r[0]] for k, r in SHAPES.items()}
SHAPES_H = [(float(x), float(y)) for x, y in SHAPES["hole"][1]]


@pytest.mark.parametrize("first", SHAPES)
@pytest.mark.parametrize("second", SHAPES)
def test_intersection_against_a_fine_grid(first, second):
    a, b = ([[(float(x), float(y)) for x, y in r] for r in SHAPES[k]] for k in (first, second))
    parts = intersection(a, b)
    step = 0.02
    gx, gy = np.meshgrid(np.arange(step / 2, 10, step), np.arange(step / 2, 10, step))
    want = _inside(a, gx, gy) & _inside(b, gx, gy)
    got = _inside([r for part in parts for r in part], gx, gy)
    assert (want != got).sum() * step * step < 0.02
    assert parts_area(parts) == pytest.approx(want.sum() * step * step, abs=0.1)
    again = intersection(b, a)
    assert parts_area(again) == pytest.approx(parts_area(parts), rel=1e-9) and len(again) == len(parts)


def test_read_and_write_wkt():
    hole = "POLYGON ((0.0 0.0, 9.0 0.0, 9.0 9.0, 0.0 9.0, 0.0 0.0), (2.0 2.0, 2.0 4.0, 4.0 4.0, 4.0 2.0, 2.0 2.0))"
    everything = [[(-1.0, -1.0), (20.0, -1.0), (20.0, 20.0), (-1.0, 20.0)]]
    assert write_wkt(intersection(read_wkt(hole), everything)) == hole
    two = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((6 0, 9 0, 9 3, 6 3, 6 0)))"
    parts = intersection(read_wkt(two), everything)
    assert parts_area(parts) == 25 and len(parts) == 2 and write_wkt(parts).startswith("MULTIPOLYGON (((0.0 0.0")
    assert read_wkt("POLYGON EMPTY") == [] and intersection([], everything) == []


def test_multi_part_clip_is_detected_and_dropped(spark):
    u_shape = [(0, 0), (30, 0), (30, 30), (20, 30), (20, 10), (10, 10), (10, 30), (0, 30)]
    box = [(0, 20), (30, 20), (30, 40), (0, 40)]
    wkt = "POLYGON ((" + ", ".join(f"{x} {y}" for x, y in u_shape + u_shape[:1]) + "))"
    polys, aoi = _polys(spark, [("A", "1", "1.1", wkt)]), _points(spark, 1, box)
    assert A.aoi_clip(polys, aoi, 10.0).collect() == []   # Q19: only single 'Polygon' results are kept
    both = A.aoi_clip(polys, aoi, 10.0, single_part=False).collect()
    assert [(r.area, r.wkt.count("((")) for r in both] == [(200.0, 2)]
    assert [(r.poly_id, r.area, r.parts) for r in A.aoi_clip_dropped(polys, aoi, 10.0).collect()] == [("1.1", 200.0, 2)]


def test_concave_aoi_and_one_clip_per_pair(spark):
    polys = _polys(spark, [("A", "1", "1.1", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))")])
    aoi = _points(spark, 1, [(0, 0), (20, 0), (20, 4), (4, 4), (4, 20), (0, 20)])
    df = A.aoi_clip(polys, aoi, 10.0)
    assert [r.area for r in df.collect()] == [64.0]
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # one pass over the outlines (their cells), one over the pairs (the clip)
    assert plan.count("MapInArrow") == 2 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_clip_independent_of_partitioning(spark):
    from loam.sources.fixtures import SoilFixture

    fx = SoilFixture(spark, "/root/testdata/sf0.001")
    one = A.aoi_clip(fx.mupolygon.coalesce(1), fx.aoi_points, 25.0)
    many = A.aoi_clip(fx.mupolygon.repartition(7), fx.aoi_points, 25.0)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.count() > 0


def test_grid_cell_size_does_not_matter(spark):
    from loam.sources.fixtures import SoilFixture

    fx = SoilFixture(spark, "/root/testdata/sf0.001")
    b = A.aoi_clip(fx.mupolygon, fx.aoi_points, 25.0)
    for cell in (7.0, 50.0, 1000.0):
        g = A.aoi_clip(fx.mupolygon, fx.aoi_points, cell)
        assert sorted(map(tuple, g.collect())) == sorted(map(tuple, b.collect()))


def _coast(n, cx=0.0, cy=0.0, r=10.0, seed=1):
    rnd = random.Random(seed)
    waves = [(rnd.random() * 6.3, 0.3 / k, k) for k in range(1, 30)]
    out = []
    for i in range(n):
        a = 2 * math.pi * i / n
        s = r * (1 + 0.4 * sum(h * math.sin(k * a + f) for f, h, k in waves) + rnd.random() / n)
        out.append((cx + s * math.cos(a), cy + s * math.sin(a)))
    return out


def _comb(n):
    k = n // 4
    teeth = [p for i in range(k) for p in ((20 * i / k, 20.0), (20 * (i + 0.5) / k, 20.0), (20 * (i + 0.5) / k, 1.0), (20 * (i + 1) / k, 1.0))]
    return [(0.0, 0.0), *teeth, (20.0, 0.0)]


def test_clip_time_is_near_linear():
    """Fifty times the vertices take far less than the square of it, also where a line crosses every tooth of a comb."""
    box = [[(-1.0, 5.0), (25.0, 5.0), (25.0, 15.0), (-1.0, 15.0)]]
    for shape, other in ((_coast, [_coast(200, 3, 2, seed=2)]), (_comb, box)):
        took = {}
        for n in (400, 20_000):
            t = time.perf_counter()
            parts = intersection([shape(n)], other)
            took[n] = time.perf_counter() - t
            assert parts
        assert took[20_000] < 50**1.5 * took[400]
    assert len(parts) == 5_000 and parts_area(parts) == pytest.approx(100)


def test_point_index_agrees_with_the_ray(rnd=random.Random(4)):
    for n in (3, 10, 400):
        rings = [_coast(n, seed=n), _coast(5, r=2)]
        index = PointIndex([(a, b) for r in rings for a, b in zip(r, r[1:] + r[:1])], 1e-9)
        for _ in range(300):
            p = (rnd.uniform(-15, 15), rnd.uniform(-15, 15))
            assert (p in index) == inside(p, rings)
    assert (0.0, 0.0) not in PointIndex([], 1e-9)


def test_outline_cells_against_points():
    """Marked cells cover the outline; a cell marked inside holds inner points only, an unmarked one none."""
    for rings in ([_coast(60)], [[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]], [SHAPES_F["U"]], [SHAPES_F["hole"], SHAPES_H]):
        cells = {(j, i): inner for i, row in outline_rows(rings, 0.7) for j, inner in row}
        rnd = random.Random(2)
        for _ in range(3000):
            x, y = rnd.uniform(-16, 16), rnd.uniform(-16, 16)
            inner = cells.get((math.floor(x / 0.7), math.floor(y / 0.7)))
            assert inner is False or inside((x, y), rings) == (inner is True)
        assert any(cells.values())


def _mixed(spark, n=120):
    rnd = random.Random(8)
    rows = []
    for i in range(n):
        x, y, r = rnd.uniform(-12, 12), rnd.uniform(-12, 12), rnd.choice([0.3, 1.0, 4.0])
        ring = lambda q: "(" + ", ".join(f"{a!r} {b!r}" for a, b in [*q, q[0]]) + ")"
        one = _coast(rnd.choice([4, 9, 40]), x, y, r, seed=i)
        wkt = f"MULTIPOLYGON (({ring(one)}), ({ring(_coast(5, x + 3 * r, y, r / 2, seed=i))}))" if i % 5 == 0 else f"POLYGON ({ring(one)})"
        rows.append(("A", str(i % 50), f"{i}.1", wkt))
    return _polys(spark, rows)


def test_key_list_without_clips_is_that_of_the_clips(spark):
    polys = _mixed(spark)
    aois = _points(spark, 1, _coast(30, seed=3)).union(_points(spark, 2, _coast(12, 5, 5, 3, seed=4)))
    for single in (True, False):
        want = {tuple(r) for r in A.aoi_mukeys(A.aoi_clip(polys, aois, 1.3, single)).collect()}
        for cell in (0.4, 50.0):
            got = A.aoi_keys(polys, aois, cell, single).collect()
            assert {tuple(r) for r in got} == want and len(got) == len(want)
    rings = A._rings_of(aois)
    inner = [A.aoi_pairs(polys, rings, c).where("inside").count() for c in (0.4, 50.0)]
    assert inner[0] > 20 and inner[1] == 0


def test_grid_join_moves_no_outline(spark):
    polys, aois = _mixed(spark), _points(spark, 1, _coast(30, seed=3))
    pairs = A.aoi_pairs(polys, aois.transform(A._rings_of), 1.3)
    assert "wkt" not in pairs.columns
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "Join Inner" in line or "Aggregate" in line]
    assert joined and not any("wkt" in line for line in joined)


def _scanned(df):
    """Rows that the scan of ``df`` handed on, by its metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numOutputRows").get().value() for i in range(leaves.size()))


def test_stored_polygons_are_read_near_the_aoi_only(spark, scratch):
    cells = 200
    box = "concat('POLYGON ((', {0}, ' ', {1}, ', ', {0} + 1, ' ', {1}, ', ', {0} + 1, ' ', {1} + 1, ', ', {0}, ' ', {1} + 1, ', ', {0}, ' ', {1}, '))')"
    polys = spark.range(cells * cells).selectExpr(
        "'A' as areasymbol", "cast(id as string) as mukey", "concat(id, '.1') as poly_id", box.format(f"id % {cells}", f"id div {cells}") + " as wkt")
    write_polygons(polys, scratch + "/polys", files=4, group_bytes=64 << 10)
    aoi = _points(spark, 1, [(20.5, 30.5), (25.5, 30.5), (25.5, 33.5), (20.5, 33.5)]).union(
        _points(spark, 2, [(150.5, 170.5), (152.5, 170.5), (151.5, 172.5)]))
    stored = read_polygons(spark, scratch + "/polys", aoi)
    read, everything = _scanned(stored), _scanned(read_polygons(spark, scratch + "/polys"))
    assert everything == cells * cells and read < everything / 10
    want = {tuple(r) for r in A.aoi_clip(polys, aoi, 2.0).collect()}
    assert {tuple(r) for r in A.aoi_clip(stored, aoi, 2.0).collect()} == want and len(want) > 24
    assert cover(aoi.limit(0)) == [] and read_polygons(spark, scratch + "/polys", aoi.limit(0)).count() == 0
    many = spark.range(100).selectExpr("cast(id as int) as aoi_id", "1 as seq", "id * 1.0D as x", "id % 7 * 1.0D as y")
    boxes = cover(many)
    assert len(boxes) <= 16 and all(any(a <= i <= b and c <= i % 7 <= d for a, b, c, d in boxes) for i in range(100))
