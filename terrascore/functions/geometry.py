"""Polygon geometry as Column expressions (higher-order functions, no UDFs).

A geometry is held as ``parts``: ``array<array<array<array<double>>>>`` —
polygons, each a list of rings (first = exterior, rest = holes), each a list
of ``[x, y]`` points. A GeoJSON Polygon is one part; a MultiPolygon is many.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parts_from_geojson(geom_type, coordinates_json) -> Column:
    """Parse GeoJSON ``coordinates`` text into ``parts`` by geometry type.
    Types other than Polygon / MultiPolygon give null."""
    t, js = _c(geom_type), _c(coordinates_json)
    return (
        F.when(t == "Polygon", F.array(F.from_json(js, schemas.POLYGON_COORDS)))
        .when(t == "MultiPolygon", F.from_json(js, schemas.MULTIPOLYGON_COORDS))
    )


def _edge(ring: Column, i: Column, n: Column) -> Column:
    a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
    return F.struct(
        F.get(a, 0).alias("x1"), F.get(a, 1).alias("y1"),
        F.get(b, 0).alias("x2"), F.get(b, 1).alias("y2"),
    )


def ring_edges(ring) -> Column:
    """Edges of one ring, the closing edge included. A ring written closed
    (last point = first) yields one zero-length edge, which neither the
    crossing test nor the area sums can see."""
    r = _c(ring)
    n = F.size(r)
    return F.when(
        n >= 2, F.transform(F.sequence(F.lit(0), n - 1), lambda i: _edge(r, i, n))
    ).otherwise(F.array().cast(T.ArrayType(schemas.EDGE)))


def geometry_edges(parts) -> Column:
    """All edges of all rings of all parts."""
    return F.flatten(F.transform(_c(parts), lambda p: F.flatten(F.transform(p, ring_edges))))


def oriented_edges(parts) -> Column:
    """All edges, turned so that exteriors run counterclockwise and holes clockwise, however they were written."""

    kind = T.ArrayType(schemas.EDGE)

    def turned(edges: Column, k: Column) -> Column:
        ox, oy = F.get(edges, 0)["x1"], F.get(edges, 0)["y1"]
        area = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + (e["x1"] - ox) * (e["y2"] - oy) - (e["x2"] - ox) * (e["y1"] - oy))
        back = F.transform(edges, lambda e: F.struct(e["x2"].alias("x1"), e["y2"].alias("y1"), e["x1"].alias("x2"), e["y1"].alias("y2")))
        return F.when((area >= 0) == (k == 0), edges.cast(kind)).otherwise(back.cast(kind))

    rings = F.transform(_c(parts), lambda part: F.transform(part, lambda ring: ring_edges(ring).cast(kind)))
    return F.flatten(F.transform(rings, lambda part: F.flatten(F.transform(part, turned))))


def geometry_points(parts) -> Column:
    return F.flatten(F.flatten(_c(parts)))


def bbox(parts) -> dict[str, Column]:
    pts = geometry_points(parts)
    return {
        "min_x": F.array_min(F.transform(pts, lambda p: F.get(p, 0))),
        "min_y": F.array_min(F.transform(pts, lambda p: F.get(p, 1))),
        "max_x": F.array_max(F.transform(pts, lambda p: F.get(p, 0))),
        "max_y": F.array_max(F.transform(pts, lambda p: F.get(p, 1))),
    }


def crosses_ray(px, py):
    """Predicate on an edge: does the ray from (px, py) towards +x cross it?
    Half-open in y, so a vertex on the ray is counted once."""
    px, py = _c(px), _c(py)

    def pred(e: Column) -> Column:
        x_at = (e["x2"] - e["x1"]) * (py - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return ((e["y1"] > py) != (e["y2"] > py)) & (px < x_at)

    return pred


def point_in_polygon(px, py, edges) -> Column:
    """Even-odd ray casting over every ring: holes and multi-part shapes are
    handled by the parity of crossings."""
    return F.size(F.filter(_c(edges), crosses_ray(px, py))) % 2 == 1


def edges_in_rows(edges, y_min, y_max, eps) -> Column:
    """Edges that a horizontal line between ``y_min`` and ``y_max`` can meet (a superset)."""
    lo_y, hi_y, e_ = _c(y_min), _c(y_max), _c(eps)
    return F.filter(_c(edges), lambda e: (F.greatest(e["y1"], e["y2"]) >= lo_y - e_) & (F.least(e["y1"], e["y2"]) <= hi_y + e_))


def edges_right_of(edges, x_min, eps) -> Column:
    """Edges that a rightward ray from a point not left of ``x_min`` can meet (a superset)."""
    lo_x, e_ = _c(x_min), _c(eps)
    return F.filter(_c(edges), lambda e: F.greatest(e["x1"], e["x2"]) >= lo_x - e_)


def centroid(parts) -> dict[str, Column]:
    """Area-weighted centroid (shoelace). Coordinates are shifted to the first
    vertex first, which keeps the sums small and exact on simple shapes.
    Exterior rings add area, holes subtract it, whatever their orientation.
    Zero area gives null."""
    p = _c(parts)
    ox = F.get(F.get(F.get(F.get(p, 0), 0), 0), 0)
    oy = F.get(F.get(F.get(F.get(p, 0), 0), 0), 1)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def step(acc, e):
        x1, y1, x2, y2 = e["x1"] - ox, e["y1"] - oy, e["x2"] - ox, e["y2"] - oy
        cross = x1 * y2 - x2 * y1
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["sx"] + (x1 + x2) * cross).alias("sx"),
            (acc["sy"] + (y1 + y2) * cross).alias("sy"),
        )

    def ring_sum(ring, k):
        s = F.aggregate(ring_edges(ring), zero, step)
        f = F.signum(s["a"]) * F.when(k == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct((s["a"] * f).alias("a"), (s["sx"] * f).alias("sx"), (s["sy"] * f).alias("sy"))

    rings = F.flatten(F.transform(p, lambda part: F.transform(part, ring_sum)))
    tot = F.aggregate(
        rings, zero,
        lambda acc, r: F.struct((acc["a"] + r["a"]).alias("a"), (acc["sx"] + r["sx"]).alias("sx"),
                                (acc["sy"] + r["sy"]).alias("sy")),
    )
    denom = F.nullif(tot["a"] * 3.0, F.lit(0.0))
    return {"lon": tot["sx"] / denom + ox, "lat": tot["sy"] / denom + oy}
