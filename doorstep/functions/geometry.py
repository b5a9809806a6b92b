"""Polygon text as edges, and the exact containment test, as SQL expressions.

A polygon is cut along a square grid (``cover`` in ``operators.contains``).  The
cell side is a power of two, so the cell of a coordinate and the cell borders are
computed without rounding.  The expressions are SQL text, where a lambda is short;
``e`` stands for one segment.
"""

from pyspark.sql import functions as F

X_LOW, X_HIGH = "least(e.x1, e.x2)", "greatest(e.x1, e.x2)"
Y_LOW, Y_HIGH = "least(e.y1, e.y2)", "greatest(e.y1, e.y2)"


def edges(wkt):
    """All ring segments of a polygon text as array<struct<x1,y1,x2,y2>>.

    Every innermost parenthesis is a ring; holes and further parts need no special
    care because containment counts crossings over all rings.
    """
    return F.expr(
        rf"""
        flatten(transform(
          transform(
            regexp_extract_all(`{wkt}`, r'\(([^()]+)\)', 1),
            ring -> transform(split(ring, ','), pair -> split(trim(pair), r'\s+'))),
          v -> zip_with(
            slice(v, 1, size(v) - 1),
            slice(v, 2, size(v) - 1),
            (a, b) -> named_struct(
              'x1', cast(a[0] AS double), 'y1', cast(a[1] AS double),
              'x2', cast(b[0] AS double), 'y2', cast(b[1] AS double)))))
        """
    )


def lowest(column, value):
    return f"array_min(transform({column}, e -> {value}))"


def highest(column, value):
    return f"array_max(transform({column}, e -> {value}))"


def grid_cell(coordinate, side):
    return f"floor({coordinate} / {side!r}D)"


def _side_of(x, y):
    return f"((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"


def touches(x, y):
    """The point lies on the segment."""
    return (
        f"{y} >= {Y_LOW} AND {y} <= {Y_HIGH} AND {x} >= {X_LOW} AND {x} <= {X_HIGH}"
        f" AND {_side_of(x, y)} = 0"
    )


def crosses(x, y):
    """A ray from the point towards larger x crosses the segment (half-open in y)."""
    return (
        f"(e.y1 > {y}) <> (e.y2 > {y})"
        f" AND ({_side_of(x, y)} > 0) = (e.y2 > e.y1)"
    )


def strictly_inside(x, y, cell=""):
    """Interior test against one cell of a cover; boundary points are outside.

    ``_edges`` are the segments near the cell.  Segments wholly to its right are
    crossed exactly when they straddle y, so they are kept only as a constant parity,
    ``_far_parity``, and the end heights that do not cancel out, ``_far_ys``.  Most
    pairs are settled by the polygon's extent, ``_x0`` to ``_y1``, or a full cell.
    With ``cell`` (as ``c.``) these are fields of a struct.
    """
    extent = (
        f"{x} > {cell}_x0 AND {x} < {cell}_x1 AND {y} > {cell}_y0 AND {y} < {cell}_y1"
    )
    crossings = (
        f"size(filter({cell}_edges, e -> {crosses(x, y)})) + {cell}_far_parity"
        f" + size(filter({cell}_far_ys, v -> v > {y}))"
    )
    return (
        f"{extent} AND ({cell}_full OR (({crossings}) % 2 = 1"
        f" AND NOT exists({cell}_edges, e -> {touches(x, y)})))"
    )
