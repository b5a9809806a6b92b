"""Point-in-polygon join as an equi-join on grid cells with an exact test.

Polygons are cut into cells.  A cell wholly inside is FULL and needs no test, a cell
met by a segment carries just the segments near it, an outside cell is dropped.  A
point has one cell, so it meets each polygon at most once and no duplicates arise.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..sources.stage import materialise
from .skew import BROADCAST_BYTES, lookup_join, salted_join

# Wanted cells per piece: more cells mean fewer segment tests but a larger cover.  The
# first grid that can be broadcast is taken, and the one to shuffle by otherwise.
BROADCAST_CELLS, SHUFFLED_CELLS = (256, 128, 64), 128
PIECES_PER_TASK, CELLS_PER_TASK = 32, 20_000
LEVELS = range(-12, 31)
# Fixed bytes of one cover row beside the caller's columns, and bytes of one kept
# segment with the at most two end heights it can leave behind.
ROW_BYTES = 192
EDGE_BYTES = 48


@dataclass(frozen=True)
class CoverSize:
    """Upper bounds on a cover, from sums over pieces and segments only."""

    pieces: int
    weight: float
    extent: float
    area: float
    weighted_extent: float
    weighted_area: float
    edges: int
    edge_extent: float
    edge_area: float

    @staticmethod
    def _cells(area, extent, count, side):
        # An interval of length d meets at most d / side + 2 cells.
        return area / side**2 + 2 * extent / side + 4 * count

    def rows(self, level):
        return self._cells(self.area, self.extent, self.pieces, 2.0**-level)

    def bytes(self, level):
        side = 2.0**-level
        return self._cells(
            self.weighted_area, self.weighted_extent, self.weight, side
        ) + EDGE_BYTES * self._cells(
            self.edge_area, self.edge_extent, self.edges, side
        )

    def _finest(self, cells_per_piece):
        budget = cells_per_piece * max(self.pieces, 1)
        return max((n for n in LEVELS if self.rows(n) <= budget), default=min(LEVELS))

    def level(self, broadcast_bytes=BROADCAST_BYTES):
        """The finest wanted grid that can be broadcast, else one to shuffle by."""
        for cells in BROADCAST_CELLS:
            if self.bytes(self._finest(cells)) <= broadcast_bytes:
                return self._finest(cells)
        return self._finest(SHUFFLED_CELLS)


def measure_cover(polygons, wkt="geometry"):
    """One aggregate over the polygon side; one row comes back."""
    payload = [c for c in polygons.columns if c != wkt]
    weight = F.lit(ROW_BYTES + 24 * len(payload))
    if payload:
        weight = weight + 2 * F.octet_length(F.to_json(F.struct(*payload)))

    width, height = f"({G.X_HIGH} - {G.X_LOW})", f"({G.Y_HIGH} - {G.Y_LOW})"

    def total(value):
        return f"aggregate(_edges, 0D, (acc, e) -> acc + {value})"

    pieces = (
        polygons.where(F.col(wkt).isNotNull())
        .select(weight.cast("double").alias("_w"), G.edges(wkt).alias("_edges"))
        .selectExpr(
            "_w",
            "size(_edges) AS _n",
            f"{G.highest('_edges', G.X_HIGH)} - {G.lowest('_edges', G.X_LOW)} AS _dx",
            f"{G.highest('_edges', G.Y_HIGH)} - {G.lowest('_edges', G.Y_LOW)} AS _dy",
            f"{total(f'({width} + {height})')} AS _ee",
            f"{total(f'{width} * {height}')} AS _ea",
        )
    )
    extent = F.col("_dx") + F.col("_dy")
    area = F.col("_dx") * F.col("_dy")
    row = pieces.agg(
        F.count(F.lit(1)),
        F.sum("_w"),
        F.sum(extent),
        F.sum(area),
        F.sum(F.col("_w") * extent),
        F.sum(F.col("_w") * area),
        F.sum("_n"),
        F.sum("_ee"),
        F.sum("_ea"),
    ).first()
    return CoverSize(*[v or 0 for v in row])


def cover(polygons, level, wkt="geometry", tasks=None):
    """One row per (polygon, grid cell it meets).

    Adds ``_cx``, ``_cy``, the polygon's extent in the cell's row of cells (``_x0`` to
    ``_y1``), ``_full`` and, for mixed cells, ``_edges``, ``_far_parity`` and
    ``_far_ys``; the polygon text is dropped.

    Without ``tasks`` this is narrow; with it the rows of cells of each polygon are
    spread over that many tasks, so that a polygon of very many cells is not cut by one.

    Each step hands its arrays on through a generator, since a filter over a plain
    projection would be moved below it and compute them once more.
    """
    side = 2.0**-level
    payload = [f"`{c}`" for c in polygons.columns if c != wkt]
    low_y, high_y = f"_cy * {side!r}D", f"(_cy + 1) * {side!r}D"
    low_x, high_x = f"_cx * {side!r}D", f"(_cx + 1) * {side!r}D"

    def cells(low, high):
        return f"sequence({G.grid_cell(low, side)}, {G.grid_cell(high, side)})"

    # A polygon without segments has no cell range and leaves no row.
    rows = (
        polygons.where(F.col(wkt).isNotNull())
        .select(*[F.col(c) for c in payload], G.edges(wkt).alias("_all"))
        .selectExpr(
            *payload,
            "_all",
            f"{G.lowest('_all', G.Y_LOW)} AS _bottom",
            f"{G.highest('_all', G.Y_HIGH)} AS _top",
        )
        .selectExpr("*", f"explode({cells('_bottom', '_top')}) AS _cy")
    )
    banded = rows.selectExpr(
        *payload,
        "_bottom",
        "_top",
        "_cy",
        f"filter(_all, e -> {G.Y_LOW} <= {high_y} AND {G.Y_HIGH} >= {low_y}) AS _band",
    )
    if tasks is not None:
        banded = banded.repartition(tasks)
    extent = ["_left", "_right", "_bottom", "_top"]
    banded = banded.selectExpr(
        "*",
        f"{G.lowest('_band', G.X_LOW)} AS _left",
        f"{G.highest('_band', G.X_HIGH)} AS _right",
    ).selectExpr("*", f"explode({cells('_left', '_right')}) AS _cx")
    # Beside the segments near the cell, the heights of both ends of every segment
    # wholly to its right.
    with_ends = banded.selectExpr(
        *payload,
        *extent,
        "_cx",
        "_cy",
        f"filter(_band, e -> {G.X_LOW} <= {high_x} AND {G.X_HIGH} >= {low_x}) AS _edges",
        f"""flatten(transform(
              filter(_band, e -> {G.X_LOW} > {high_x}), e -> array(e.y1, e.y2))) AS _ends""",
    )
    # A segment straddles y when exactly one end is above y, so equal heights cancel
    # in pairs: a chain of segments leaves only its two loose ends.
    uncancelled = f"""
        aggregate(
          array_sort(filter(_ends, v -> v > {low_y} AND v < {high_y})),
          cast(array() AS array<double>),
          (kept, v) -> CASE
            WHEN size(kept) > 0 AND try_element_at(kept, -1) = v
            THEN slice(kept, 1, size(kept) - 1)
            ELSE concat(kept, array(v)) END)"""
    labelled = with_ends.selectExpr(
        *payload,
        "_cx",
        "_cy",
        f"""inline(array(named_struct(
              '_x0', _left, '_x1', _right, '_y0', _bottom, '_y1', _top,
              '_edges', _edges,
              '_far_parity', size(filter(_ends, v -> v >= {high_y})) % 2,
              '_far_ys', {uncancelled})))""",
    )
    # Without a segment near, the whole cell is on one side: its lower border decides.
    mixed = "size(_edges) > 0"
    inside = f"(_far_parity + size(filter(_far_ys, v -> v > {low_y}))) % 2 = 1"
    return labelled.where(f"{mixed} OR {inside}").selectExpr(
        *payload,
        "_x0",
        "_x1",
        "_y0",
        "_y1",
        "_cx",
        "_cy",
        f"NOT {mixed} AS _full",
        *[f"CASE WHEN {mixed} THEN {c} END AS {c}" for c in
          ("_edges", "_far_parity", "_far_ys")],
    )


def _placed(points, x, y, level):
    """Points with the grid cell they lie in, null where they have no place."""
    side = 2.0**-level
    return points.selectExpr(
        "*", f"{G.grid_cell(x, side)} AS _pcx", f"{G.grid_cell(y, side)} AS _pcy"
    )


def _cells(polygons, size, level, wkt):
    """The cover under names apart from the points' cells.

    The pieces are few and their cells many, so the pieces are spread before cutting,
    and their cells once more, over as many tasks as their measured number asks for.
    """
    tasks = 1 + size.pieces // PIECES_PER_TASK
    cut = 1 + int(size.rows(level)) // CELLS_PER_TASK
    cells = cover(polygons.repartition(tasks), level, wkt, tasks=cut)
    return cells.withColumnsRenamed({"_cx": "_pcx_r", "_cy": "_pcy_r"})


TEST_COLUMNS = ["_x0", "_x1", "_y0", "_y1", "_full", "_edges", "_far_parity", "_far_ys"]
CELL_KEYS = [("_pcx", "_pcx_r"), ("_pcy", "_pcy_r")]


def contains_join(
    points,
    polygons,
    *,
    how="left",
    x="longitude",
    y="latitude",
    wkt="geometry",
    on=(),
    level=None,
    broadcast_bytes=BROADCAST_BYTES,
    size=None,
):
    """Join each point with the polygons that hold it in their interior.

    ``on`` names further columns both sides must agree on.  The result has the
    points' columns and the polygons' other columns except ``wkt``.  ``size`` is the
    polygons' ``measure_cover`` where the caller has it already.

    The cover is broadcast when its proven size bound is within ``broadcast_bytes``:
    the points are then not shuffled at all.  Otherwise both sides are shuffled by
    cell, and cells holding a large share of the points are split.
    """
    size = size or measure_cover(polygons, wkt)
    if level is None:
        level = size.level(broadcast_bytes)
    payload = [c for c in polygons.columns if c != wkt and c not in on]
    renamed = {c: f"_r_{c}" for c in on}

    left = _placed(points, x, y, level)
    right = _cells(polygons, size, level, wkt).withColumnsRenamed(renamed)
    keys = CELL_KEYS + list(renamed.items())
    inside = F.expr(G.strictly_inside(x, y))
    if size.bytes(level) <= broadcast_bytes:
        condition = inside
        for mine, theirs in keys:
            condition = condition & (F.col(mine) == F.col(theirs))
        joined = left.join(F.broadcast(right), condition, how)
    else:
        joined = salted_join(left, right, keys, how=how, extra=inside)
    return joined.select(*points.columns, *payload)


def contains_lists(
    points,
    polygons,
    value,
    *,
    x="longitude",
    y="latitude",
    wkt="geometry",
    level=None,
    broadcast_bytes=BROADCAST_BYTES,
    size=None,
):
    """Each point once, with the list of ``value`` of the polygons holding it.

    Needs no shuffle of the points: the cover is gathered per cell, which its size
    bound allows, and each point meets its one cell.  None when the bound is exceeded;
    ``contains_join`` and a grouping are the way then.
    """
    size = size or measure_cover(polygons, wkt)
    if level is None:
        level = size.level(broadcast_bytes)
    if size.bytes(level) > broadcast_bytes:
        return None
    cells = (
        _cells(polygons.select(value, wkt), size, level, wkt)
        .withColumnRenamed(value, "value")
        .groupBy("_pcx_r", "_pcy_r")
        .agg(
            F.collect_list(
                F.struct("value", *TEST_COLUMNS)
            ).alias("_near")
        )
    )
    condition = F.lit(True)
    for mine, theirs in CELL_KEYS:
        condition = condition & (F.col(mine) == F.col(theirs))
    joined = _placed(points, x, y, level).join(F.broadcast(cells), condition, "left")
    holding = f"c -> {G.strictly_inside(x, y, 'c.')}"
    found = f"transform(filter(_near, {holding}), c -> c.value)"
    return joined.select(
        *points.columns, F.expr(f"coalesce({found}, array())").alias(value)
    )


class Touched:
    """The grid cells met by polygons that only one of two tables holds.

    A point elsewhere lies in the same polygons of both tables, so what was found for it
    before still holds.  Polygons are compared as whole rows, repeats included; the grid
    suits the changed ones alone, and only these are cut.
    """

    def __init__(self, before, after, wkt="geometry", level=None, broadcast_bytes=BROADCAST_BYTES):
        after = after.select(*before.columns)
        changed = materialise(before.exceptAll(after).unionAll(after.exceptAll(before)), "changed")
        size = measure_cover(changed.select(wkt), wkt)
        self.level = size.level(broadcast_bytes) if level is None else level
        self.broadcast_bytes = broadcast_bytes
        cells = _cells(changed.select(wkt), size, self.level, wkt)
        self.cells = materialise(cells.select("_pcx_r", "_pcy_r").distinct(), "touched")

    def _cut(self, points, how, x, y):
        placed = _placed(points, x, y, self.level)
        kept = lookup_join(placed, self.cells, CELL_KEYS, how, self.broadcast_bytes)
        return kept.select(*points.columns)

    def inside(self, points, x="longitude", y="latitude"):
        return self._cut(points, "left_semi", x, y)

    def outside(self, points, x="longitude", y="latitude"):
        """The others, those without a place among them."""
        return self._cut(points, "left_anti", x, y)


def contains_update(
    found, points, before, after, *, x="longitude", y="latitude", wkt="geometry", touched=None, **options
):
    """``contains_join(points, after)`` from ``found``, the result for ``before``.

    Only points in cells that changed polygons meet are joined again.  ``points`` are
    those that ``found`` was made of; both are read once per side of the cut.
    """
    touched = touched or Touched(before, after, wkt)
    again = contains_join(touched.inside(points, x, y), after, x=x, y=y, wkt=wkt, **options)
    return touched.outside(found, x, y).unionByName(again.select(*found.columns))
