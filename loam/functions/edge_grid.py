"""Edges of a polygon in grid cells: edges near an edge, and points inside, in about constant time each."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Sequence

Point = tuple[float, float]
Edge = tuple[Point, Point]

#: Where a cell's reference point lies in it, as shares of its sides: off the middle, so that no usual vertex shares a coordinate.
_REF_X, _REF_Y = 0.5137951, 0.4861727


class EdgeGrid:
    """About as many cells as edges over the edges' box; each edge is kept in the cells that it passes.

    ``margin`` widens every edge, so that edges within it of one another share a cell.
    """

    def __init__(self, edges: Sequence[Edge], margin: float):
        self.edges, self.margin = edges, margin
        xs = [x for a, b in edges for x in (a[0], b[0])]
        ys = [y for a, b in edges for y in (a[1], b[1])]
        self.x0, self.y0 = min(xs) - 2 * margin, min(ys) - 2 * margin
        self.x1, self.y1 = max(xs) + 2 * margin, max(ys) + 2 * margin
        wide, high = self.x1 - self.x0, self.y1 - self.y0
        # cells shaped like the usual edge, so that long edges of one direction pass few of them
        across = math.fsum(abs(a[0] - b[0]) for a, b in edges) + margin
        along = math.fsum(abs(a[1] - b[1]) for a, b in edges) + margin
        cell = math.sqrt(wide * high / len(edges) * across / along)
        self.columns = min(max(1, int(wide / cell)), len(edges))
        self.rows = min(max(1, len(edges) // self.columns), len(edges))
        self.w, self.h = wide / self.columns, high / self.rows
        self.cells: dict[tuple[int, int], list[int]] = defaultdict(list)
        for k, edge in enumerate(edges):
            for cell in self.passed(edge):
                self.cells[cell].append(k)

    def column(self, x: float) -> int:
        return min(max(int((x - self.x0) / self.w), 0), self.columns - 1)

    def row(self, y: float) -> int:
        return min(max(int((y - self.y0) / self.h), 0), self.rows - 1)

    def passed(self, edge: Edge) -> Iterator[tuple[int, int]]:
        """Cells (row, column) that an edge, widened by the margin, passes."""
        a, b = sorted(edge, key=lambda p: p[1])
        m = self.margin
        low, high = self.row(a[1] - m), self.row(b[1] + m)
        rise = b[1] - a[1]
        for i in range(low, high + 1):
            if low == high or rise <= m:
                left, right = min(a[0], b[0]), max(a[0], b[0])
            else:
                t0 = max(0.0, (self.y0 + i * self.h - 2 * m - a[1]) / rise)
                t1 = min(1.0, (self.y0 + (i + 1) * self.h + 2 * m - a[1]) / rise)
                p, q = a[0] + min(t0, 1.0) * (b[0] - a[0]), a[0] + max(t1, 0.0) * (b[0] - a[0])
                left, right = min(p, q), max(p, q)
            for j in range(self.column(left - 2 * m), self.column(right + 2 * m) + 1):
                yield i, j

    def near(self, edge: Edge) -> list[int]:
        """Edges that share a cell with ``edge``, in order: all that come within the margin, and others."""
        found = set()
        for cell in self.passed(edge):
            found.update(self.cells.get(cell, ()))
        return sorted(found)


class PointIndex:
    """Whether points lie inside a polygon: where a ray crosses its edges an odd number of times.

    Every cell has a reference point whose answer is known; a point's own
    differs by the edges crossed on the way from it, all in the point's cell.
    """

    def __init__(self, edges: Sequence[Edge], margin: float):
        self.grid = EdgeGrid(edges, margin) if edges else None
        self._rows: dict[int, list[float]] = {}

    def _crossings(self, i: int) -> list[float]:
        """Where the line through the reference points of a row crosses edges, in order."""
        if i not in self._rows:
            g = self.grid
            y = g.y0 + (i + _REF_Y) * g.h
            held = {k for j in range(g.columns) for k in g.cells.get((i, j), ())}
            self._rows[i] = sorted((q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0]
                                   for p, q in (g.edges[k] for k in held) if (p[1] > y) != (q[1] > y))
        return self._rows[i]

    def __contains__(self, point: Point) -> bool:
        g = self.grid
        if g is None:
            return False
        x, y = point
        if not (g.x0 <= x <= g.x1 and g.y0 <= y <= g.y1):
            return False
        i, j = g.row(y), g.column(x)
        rx, ry = g.x0 + (j + _REF_X) * g.w, g.y0 + (i + _REF_Y) * g.h
        odd = bisect_left(self._crossings(i), rx) % 2 == 1
        for k in g.cells.get((i, j), ()):
            (x1, y1), (x2, y2) = g.edges[k]
            if (x1 > rx) != (x2 > rx):
                at = (y2 - y1) * (rx - x1) / (x2 - x1) + y1
                if (at > ry) != (at > y):
                    odd = not odd
            if (y1 > y) != (y2 > y):
                at = (x2 - x1) * (y - y1) / (y2 - y1) + x1
                if (at > rx) != (at > x):
                    odd = not odd
        return odd
