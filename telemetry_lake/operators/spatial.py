"""Point-in-polygon joins on plain structs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def ring_edges(rings: Column) -> Column:
    """All edges of all rings as ``array<struct<x1,y1,x2,y2>>``; an open ring is closed."""

    def edges(ring: Column) -> Column:
        turned = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        return F.zip_with(
            ring,
            turned,
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")),
        )

    return F.flatten(F.transform(rings, edges))


def inside(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd rule: an odd number of edges crosses the ray from the point to the right.

    Edges are half open in y, so touching polygons never share a boundary point. Holes are
    further rings under the same parity.
    """

    def crossing(total: Column, e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
        # The outer test also keeps horizontal edges away from the division.
        return total + F.when((e["y1"] > y) != (e["y2"] > y), F.when(x < at, 1).otherwise(0)).otherwise(0)

    return F.aggregate(edges, F.lit(0), crossing) % 2 == 1


#: A polygon's longer side spans more than half and at most all of so many cells.
CELLS = 8
#: Cells are widened by this part of their side before edges are looked for, so that rounding
#: never puts a point beyond an edge that its cell does not list.
MARGIN = 1 / 1024


def _level(length: Column) -> Column:
    """The smallest ``n`` with ``2 ** n >= length``; null for lengths of zero."""
    return F.ceil(F.log2(length)).cast("int")


def _place(value: Column, level: Column) -> Column:
    """Number of the cell of side ``2 ** level`` that holds ``value``."""
    return F.floor(value / F.pow(F.lit(2.0), level))


def _touches(e: Column, left: Column, bottom: Column, side: Column) -> Column:
    """Whether an edge may have a point in a square: their boxes overlap and no line parts them."""
    margin = side * MARGIN
    x1, y1, x2, y2 = left - margin, bottom - margin, left + side + margin, bottom + side + margin
    overlap = (
        (F.greatest(e["x1"], e["x2"]) >= x1) & (F.least(e["x1"], e["x2"]) <= x2)
        & (F.greatest(e["y1"], e["y2"]) >= y1) & (F.least(e["y1"], e["y2"]) <= y2)
    )
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    turns = [dx * (y - e["y1"]) - dy * (x - e["x1"]) for x in (x1, x2) for y in (y1, y2)]
    return overlap & (F.least(*turns) <= 0) & (F.greatest(*turns) >= 0)


def _leveled(polygons: DataFrame, rings: str, smallest: float) -> DataFrame:
    """Polygons that have cells, with ``__level`` and the first and last cell on both axes."""
    corners = F.flatten(F.col(rings))
    least, most = {}, {}
    for axis in ("x", "y"):
        values = F.transform(corners, lambda p: p[axis].cast("double"))
        least[axis], most[axis] = F.array_min(values), F.array_max(values)
    finite = F.forall(
        corners, lambda p: F.coalesce((F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")), F.lit(False))
    )
    longer = F.greatest(most["x"] - least["x"], most["y"] - least["y"])
    level = F.greatest(_level(longer / CELLS), _level(F.lit(float(smallest))))
    return polygons.filter(finite & (F.size(corners) > 0)).select(
        "*", level.alias("__level"), *[F.floor(b[axis] / F.pow(F.lit(2.0), level)).alias(f"__{name}_{axis}")
                                       for name, b in (("first", least), ("last", most)) for axis in ("x", "y")],
    )


def cell_cover(polygons: DataFrame, rings: str, smallest: float) -> DataFrame:
    """``polygons`` once per cell they share: ``__level``, ``__cx``, ``__cy``, ``__edges``.

    Cells are the squares of a quadtree. Each polygon takes the level at which its longer side spans
    up to :data:`CELLS` of them, but none finer than ``smallest``, so that it has at most
    ``(CELLS + 1) ** 2`` cells, be it thin, huge or tiny. Cells outside are left out; cells inside
    list a single edge that every ray to the right crosses; others list the edges that a ray from a
    point of the cell can cross. Polygons without a point, or with a coordinate that is
    null or not finite, have no cells.
    """
    leveled = _leveled(polygons, rings, smallest).withColumn("__all", ring_edges(F.col(rings)))
    leveled = leveled.withColumn("__side", F.pow(F.lit(2.0), F.col("__level")))
    side, edges = F.col("__side"), F.col("__all")

    def span(axis: str) -> Column:
        return F.sequence(F.col(f"__first_{axis}"), F.col(f"__last_{axis}"))

    def cell(cx: Column, cy: Column) -> Column:
        left, bottom, margin = cx * side, cy * side, side * MARGIN

        def crossed(e: Column) -> Column:
            return (
                (F.greatest(e["x1"], e["x2"]) >= left - margin)
                & (F.greatest(e["y1"], e["y2"]) >= bottom - margin)
                & (F.least(e["y1"], e["y2"]) <= bottom + side + margin)
            )

        near = F.when(F.exists(edges, lambda e: _touches(e, left, bottom, side)), F.filter(edges, crossed))
        beyond = left + side * 2  # one upright edge, which the ray from any point of the cell crosses
        whole = F.struct(
            beyond.alias("x1"), (bottom - side).alias("y1"), beyond.alias("x2"), (bottom + side * 2).alias("y2")
        )
        within = F.when(inside(left + side / 2, bottom + side / 2, edges), F.array(whole))
        return F.struct(cx.alias("cx"), cy.alias("cy"), F.coalesce(near, within).alias("edges"))

    cells = F.flatten(F.transform(span("x"), lambda cx: F.transform(span("y"), lambda cy: cell(cx, cy))))
    listed = leveled.withColumn("__cell", F.explode(F.filter(cells, lambda c: c["edges"].isNotNull())))
    return listed.select(
        *[F.col(f"`{c}`") for c in polygons.columns], "__level",
        F.col("__cell.cx").alias("__cx"), F.col("__cell.cy").alias("__cy"), F.col("__cell.edges").alias("__edges"),
    )


def spatial_join(
    points: DataFrame,
    polygons: DataFrame,
    x: str,
    y: str,
    rings: str,
    cell: float,
    on: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Inner join of points with the polygons around them.

    ``rings`` is ``array<array<struct<x,y>>>``. Polygons are listed under their cells
    (:func:`cell_cover`), points under the one they lie in at each level that occurs; these are
    one per power of two among the polygons' sizes. ``cell`` is the finest cell and so bounds them from
    below. Points are tested against the edges near their cell, in inner cells against one. ``on`` adds
    (point column, polygon column) equalities. A busy cell or key stays a plain equi-join, which
    adaptive execution splits. Points without both coordinates are in no polygon.
    """
    listed = cell_cover(polygons, rings, cell)
    # The levels come from the polygons' boxes alone, as a subquery: one short array for all points.
    levels = _leveled(polygons, rings, cell).agg(F.sort_array(F.collect_set("__level")).alias("levels")).scalar()
    placed = (
        # A number that is none would count as cell 0.
        points.filter(~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double")))
        .withColumn("__levels", levels)
        .withColumn("__pl", F.explode("__levels"))
        .withColumn("__px", _place(F.col(x), F.col("__pl")))
        .withColumn("__py", _place(F.col(y), F.col("__pl")))
    )
    condition = (F.col("__pl") == F.col("__level")) & (F.col("__px") == F.col("__cx")) & (F.col("__py") == F.col("__cy"))
    for point_column, polygon_column in on:
        condition &= points[point_column] == polygons[polygon_column]
    met = placed.join(listed, condition)
    # The point is an argument of the test: the optimizer pushes a test whose inner function takes
    # point columns from outside below the join, to the polygons alone, where it fails.
    test = F.array(F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.col("__edges").alias("edges")))
    return met.filter(F.exists(test, lambda t: inside(t["x"], t["y"], t["edges"]))).drop(
        "__levels", "__pl", "__px", "__py", "__level", "__cx", "__cy", "__edges"
    )
