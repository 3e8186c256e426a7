"""Intersection of two polygons with holes and parts (pure Python, one pair at a time).

A polygon is a list of rings, a ring a list of points without the closing one;
inside is where a ray crosses the rings an odd number of times, so the rings'
directions don't matter.  Edges that meet and points inside are found through
grid cells of edges, so time is about linear in the number of vertices.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

from loam.functions.edge_grid import EdgeGrid, PointIndex

Point = tuple[float, float]
Ring = list[Point]

_RING = re.compile(r"\(([^()]+)\)")


def read_wkt(wkt: str) -> list[Ring]:
    """All rings of a POLYGON or MULTIPOLYGON text."""
    rings = []
    for body in _RING.findall(wkt):
        ring = [(float(x), float(y)) for x, y in (p.split()[:2] for p in body.split(","))]
        if len(ring) > 1 and ring[0] == ring[-1]:
            ring.pop()
        if len(ring) > 2:
            rings.append(ring)
    return rings


def _number(x: float) -> str:
    return repr(float(x))


def _text(ring: Ring) -> str:
    return "(" + ", ".join(f"{_number(x)} {_number(y)}" for x, y in [*ring, ring[0]]) + ")"


def write_wkt(parts: list[list[Ring]]) -> str:
    """WKT of parts (each an outer ring and its holes)."""
    bodies = ["(" + ", ".join(_text(r) for r in part) + ")" for part in parts]
    return "POLYGON " + bodies[0] if len(bodies) == 1 else "MULTIPOLYGON (" + ", ".join(bodies) + ")"


def ring_area(ring: Ring) -> float:
    """Signed area, positive when counter-clockwise."""
    return math.fsum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def inside(point: Point, rings: list[Ring]) -> bool:
    x, y = point
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def _edges(rings: list[Ring]) -> list[tuple[Point, Point]]:
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1]) if a != b]


def _meet(p: Point, q: Point, a: Point, b: Point, eps: float) -> list[Point]:
    """Points where segment p-q has to be split because of segment a-b."""
    dx, dy, ex, ey = q[0] - p[0], q[1] - p[1], b[0] - a[0], b[1] - a[1]
    cross = dx * ey - dy * ex
    found = []
    if abs(cross) > 1e-14 * (abs(dx) + abs(dy)) * (abs(ex) + abs(ey)):
        t = ((a[0] - p[0]) * ey - (a[1] - p[1]) * ex) / cross
        u = ((a[0] - p[0]) * dy - (a[1] - p[1]) * dx) / cross
        if -1e-12 <= t <= 1 + 1e-12 and -1e-12 <= u <= 1 + 1e-12:
            # on an axis-parallel segment the point keeps its exact coordinate
            x = p[0] if dx == 0 else a[0] if ex == 0 else p[0] + t * dx
            y = p[1] if dy == 0 else a[1] if ey == 0 else p[1] + t * dy
            found.append((x, y))
    for c in (a, b):
        if abs(dx * (c[1] - p[1]) - dy * (c[0] - p[0])) <= eps * (abs(dx) + abs(dy)):
            found.append(c)
    return found


def _pieces(edges, eps, snap):
    """Undirected sub-segments of ``edges`` after all splits by one another."""
    out = set()
    if not edges:
        return out
    grid = EdgeGrid(edges, 8 * eps)
    for p, q in edges:
        dx, dy = q[0] - p[0], q[1] - p[1]
        size = dx * dx + dy * dy
        lo, hi = (min(p[0], q[0]) - eps, min(p[1], q[1]) - eps), (max(p[0], q[0]) + eps, max(p[1], q[1]) + eps)
        at = {0.0: p, 1.0: q}
        for a, b in (edges[k] for k in grid.near((p, q))):
            if max(a[0], b[0]) < lo[0] or min(a[0], b[0]) > hi[0] or max(a[1], b[1]) < lo[1] or min(a[1], b[1]) > hi[1]:
                continue
            for c in _meet(p, q, a, b, eps):
                t = ((c[0] - p[0]) * dx + (c[1] - p[1]) * dy) / size
                if 0 < t < 1:
                    at[t] = c
        points = [snap(at[t]) for t in sorted(at)]
        out.update((min(a, b), max(a, b)) for a, b in zip(points, points[1:]) if a != b)
    return out


def _rings(directed: list[tuple[Point, Point]]) -> list[Ring]:
    """Rings of directed edges whose interior lies to the left, the smallest faces first.

    An edge that leads nowhere (the side of a sliver thinner than the
    tolerance) is dropped and the walk goes on from where it began.
    """
    leaving = defaultdict(list)
    for a, b in directed:
        leaving[a].append(b)
    rings = []
    for start in sorted(leaving):
        while start in leaving:
            ring, here, came = [start], start, None
            while True:
                if came is None:
                    nxt = min(leaving[here])
                else:
                    back = math.atan2(came[1] - here[1], came[0] - here[0])
                    nxt = min(leaving[here], key=lambda c: (back - math.atan2(c[1] - here[1], c[0] - here[0])) % math.tau or math.tau)
                leaving[here].remove(nxt)
                if not leaving[here]:
                    del leaving[here]
                came, here = here, nxt
                if here == start:
                    rings.append(ring)
                    break
                ring.append(here)
                while ring and here not in leaving:
                    ring.pop()
                    here, came = (ring[-1], ring[-2] if len(ring) > 1 else None) if ring else (start, None)
                if not ring:
                    break
    return rings


def _tidy(ring: Ring, eps: float) -> Ring:
    """Without points on a straight line, starting at the least point."""
    kept = []
    n = len(ring)
    for i in range(n):
        a, b, c = ring[i - 1], ring[i], ring[(i + 1) % n]
        turn = (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])
        if abs(turn) > eps * (abs(b[0] - a[0]) + abs(b[1] - a[1]) + abs(c[0] - b[0]) + abs(c[1] - b[1])):
            kept.append(b)
    if len(kept) < 3:
        return []
    k = kept.index(min(kept))
    return kept[k:] + kept[:k]


def intersection(first: list[Ring], second: list[Ring]) -> list[list[Ring]]:
    """Parts of the intersection: each an outer ring (counter-clockwise) and its holes (clockwise)."""
    points = [p for ring in first + second for p in ring]
    if not first or not second:
        return []
    extent = max(max(abs(x), abs(y)) for x, y in points) or 1.0
    eps = 1e-11 * extent
    grid: dict[tuple[int, int], Point] = {}
    for p in points:
        grid.setdefault((round(p[0] / (100 * eps)), round(p[1] / (100 * eps))), p)

    def snap(p: Point) -> Point:
        k = (round(p[0] / (100 * eps)), round(p[1] / (100 * eps)))
        for i in (0, -1, 1):
            for j in (0, -1, 1):
                if (k[0] + i, k[1] + j) in grid:
                    return grid[k[0] + i, k[1] + j]
        return grid.setdefault(k, p)

    both = _edges(first), _edges(second)
    if not all(both):
        return []
    ins = [PointIndex(edges, 8 * eps) for edges in both]
    # nothing of the result, and no edge that cuts it, lies beyond the overlap of the two boxes
    grids = [x.grid for x in ins]
    x0, x1 = max(g.x0 for g in grids), min(g.x1 for g in grids)
    y0, y1 = max(g.y0 for g in grids), min(g.y1 for g in grids)
    every = [(p, q) for edges in both for p, q in edges
             if max(p[0], q[0]) >= x0 and min(p[0], q[0]) <= x1 and max(p[1], q[1]) >= y0 and min(p[1], q[1]) <= y1]
    directed = []
    for p, q in _pieces(every, eps, snap):
        dx, dy = q[0] - p[0], q[1] - p[1]
        size = math.hypot(dx, dy)
        mx, my = (p[0] + q[0]) / 2, (p[1] + q[1]) / 2
        off = min(1e3 * eps, size / 1000) / size
        left, right = (mx - dy * off, my + dx * off), (mx + dy * off, my - dx * off)
        in_left = left in ins[0] and left in ins[1]
        in_right = right in ins[0] and right in ins[1]
        if in_left != in_right:
            directed.append((p, q) if in_left else (q, p))
    rings = [r for r in (_tidy(x, eps) for x in _rings(directed)) if r]
    outers = sorted(([r] for r in rings if ring_area(r) > 0), key=lambda part: part[0][0])
    _give_holes(outers, [r for r in rings if ring_area(r) < 0], eps)
    return outers


def _give_holes(outers: list[list[Ring]], holes: list[Ring], eps: float) -> None:
    """Append each hole to the first part whose outer ring holds it; rings start at their least point, parts are in its order."""
    starts = [part[0][0] for part in outers]
    boxes = [(max(x for x, _ in r), min(y for _, y in r), max(y for _, y in r)) for r in (part[0] for part in outers)]
    index: dict[int, PointIndex] = {}
    for hole in holes:
        p = _inner_point(hole)
        for k in range(bisect_right(starts, (p[0], math.inf))):
            if p[0] <= boxes[k][0] and boxes[k][1] <= p[1] <= boxes[k][2]:
                if k not in index:
                    index[k] = PointIndex(_edges([outers[k][0]]), 8 * eps)
                if p in index[k]:
                    outers[k].append(hole)
                    break


def frame_of(rings: list[Ring]) -> list[Ring]:
    """A box around ``rings``: the intersection with it is the polygon itself, tidied."""
    xs, ys = [x for r in rings for x, _ in r], [y for r in rings for _, y in r]
    if not rings:
        return []
    wide = max(max(xs) - min(xs), max(ys) - min(ys)) / 100
    x0, y0, x1, y1 = min(xs) - wide, min(ys) - wide, max(xs) + wide, max(ys) + wide
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]


def outline_rows(rings: list[Ring], cell: float) -> Iterator[tuple[int, list[tuple[int, bool]]]]:
    """Rows of square grid cells that an outline touches: (row, [(column, whether wholly inside)]).

    Cells that an edge passes, or nearly passes, are never inside.
    """
    near = 1e-9 * cell
    passed: dict[int, set[int]] = defaultdict(set)
    edges = _edges(rings)
    for p, q in edges:
        a, b = sorted((p, q), key=lambda c: c[1])
        low, high = math.floor((a[1] - near) / cell), math.floor((b[1] + near) / cell)
        rise = b[1] - a[1]
        for i in range(low, high + 1):
            left, right = min(a[0], b[0]), max(a[0], b[0])
            if low != high and rise > near:
                t0 = min(max((i * cell - near - a[1]) / rise, 0.0), 1.0)
                t1 = min(max(((i + 1) * cell + near - a[1]) / rise, 0.0), 1.0)
                left, right = sorted((a[0] + t0 * (b[0] - a[0]), a[0] + t1 * (b[0] - a[0])))
            passed[i].update(range(math.floor((left - near) / cell), math.floor((right + near) / cell) + 1))
    ins = PointIndex(edges, near)
    for i in sorted(passed):
        held = sorted(passed[i])
        row = [(j, False) for j in held]
        for left, right in zip(held, held[1:]):
            # the cells between two passed ones are all inside or all outside
            if right - left > 1 and ((left + 1.5) * cell, (i + 0.5) * cell) in ins:
                row.extend((j, True) for j in range(left + 1, right))
        yield i, sorted(row)


def _inner_point(ring: Ring) -> Point:
    """A point just inside a ring."""
    (x1, y1), (x2, y2) = ring[0], ring[1]
    dx, dy = x2 - x1, y2 - y1
    for off in (1e-6, -1e-6):
        p = ((x1 + x2) / 2 - dy * off, (y1 + y2) / 2 + dx * off)
        if inside(p, [ring]):
            return p
    return ring[0]


def parts_area(parts: list[list[Ring]]) -> float:
    return math.fsum(ring_area(r) for part in parts for r in part)
