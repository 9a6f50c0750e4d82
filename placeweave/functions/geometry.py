"""Geometry as a plain struct, so that Parquet and any SQL engine can read it.

``geometry = struct<kind, parts: array<part: array<ring: array<vertex: struct<x, y>>>>>``.
A point is one part with one ring with one vertex.  Rings are closed, as in WKT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS_TYPE = "array<array<array<struct<x:double,y:double>>>>"
GEOMETRY_TYPE = f"struct<kind:string,parts:{PARTS_TYPE}>"

# Spherical Web Mercator radius and mean earth radius, in metres.
MERCATOR_RADIUS = 6378137.0
EARTH_RADIUS = 6371008.8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def point(x: Column | str, y: Column | str) -> Column:
    return F.struct(
        F.lit("POINT").alias("kind"),
        F.array(F.array(F.array(vertex(_col(x), _col(y))))).alias("parts"),
    )


def polygon(*vertices: tuple[Column, Column]) -> Column:
    """A polygon without holes; the ring is closed here."""
    ring = F.array(*[vertex(x, y) for x, y in (*vertices, vertices[0])])
    return F.struct(F.lit("POLYGON").alias("kind"), F.array(F.array(ring)).alias("parts"))


def vertices(geometry: Column | str) -> Column:
    """All vertices of all rings of all parts as one array."""
    return F.flatten(F.flatten(_col(geometry)["parts"]))


def bounds(geometry: Column | str) -> dict[str, Column]:
    flat = vertices(geometry)
    xs = F.transform(flat, lambda v: v["x"])
    ys = F.transform(flat, lambda v: v["y"])
    return {
        "xmin": F.array_min(xs), "ymin": F.array_min(ys),
        "xmax": F.array_max(xs), "ymax": F.array_max(ys),
    }


def ring_segments(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    head = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
    tail = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.zip_with(head, tail, lambda a, b: F.struct(
        a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))


def part_segments(part: Column) -> Column:
    """Segments of every ring of one part."""
    return F.flatten(F.transform(part, ring_segments))


def map_vertices(geometry: Column | str, fx, fy) -> Column:
    """Apply ``fx``/``fy`` to the coordinates of every vertex."""
    g = _col(geometry)
    moved = F.transform(g["parts"], lambda part: F.transform(part, lambda ring: F.transform(
        ring, lambda v: F.struct(fx(v["x"]).alias("x"), fy(v["y"]).alias("y")))))
    return F.struct(g["kind"].alias("kind"), moved.alias("parts"))


def mercator_x(lon: Column | str) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.radians(_col(lon))


def mercator_y(lat: Column | str) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.ln(F.tan(F.pi() / 4 + F.radians(_col(lat)) / 2))


def to_web_mercator(geometry: Column | str) -> Column:
    """Longitude/latitude degrees (EPSG 4269 or 4326) to EPSG 3857 metres."""
    return map_vertices(geometry, mercator_x, mercator_y)


def haversine(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance in metres."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


# --- text forms -----------------------------------------------------------

def to_wkt(geometry: Column | str, digits: int | None = None) -> Column:
    """Well-known text; ``digits`` fixes the decimals, otherwise the shortest exact form is written."""
    g = _col(geometry)

    def number(v: Column) -> Column:
        return F.format_string(f"%.{digits}f", v) if digits is not None else v.cast("string")

    def pair(v: Column) -> Column:
        return F.concat(number(v["x"]), F.lit(" "), number(v["y"]))

    def ring_text(ring: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(ring, pair), ", "), F.lit(")"))

    def part_text(part: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(part, ring_text), ", "), F.lit(")"))

    return (
        F.when(F.size(g["parts"]) == 0, F.concat(g["kind"], F.lit(" EMPTY")))
        .when(g["kind"] == "POINT", F.concat(F.lit("POINT "), ring_text(g["parts"][0][0])))
        .when(g["kind"] == "POLYGON", F.concat(F.lit("POLYGON "), part_text(g["parts"][0])))
        .when(g["kind"] == "MULTIPOLYGON", F.concat(
            F.lit("MULTIPOLYGON ("), F.array_join(F.transform(g["parts"], part_text), ", "), F.lit(")")))
    )


def from_wkt(text: Column | str) -> Column:
    """Parse POINT, POLYGON and MULTIPOLYGON text; further ordinates are dropped; null for anything else."""
    t = F.trim(_col(text))
    kind = F.upper(F.regexp_extract(t, r"^([A-Za-z]+)", 1))
    body = F.regexp_replace(t, r"^[A-Za-z]+\s*(?i:(?:ZM|Z|M)\b\s*)?", "")
    # Depth of the innermost lists differs by kind; strip down to the ring lists of the parts.
    inner = (
        F.when(kind == "POINT", F.regexp_replace(body, r"^\(\s*|\s*\)$", ""))
        .when(kind == "POLYGON", F.regexp_replace(body, r"^\(\s*\(\s*|\s*\)\s*\)$", ""))
        .when(kind == "MULTIPOLYGON", F.regexp_replace(body, r"^\(\s*\(\s*\(\s*|\s*\)\s*\)\s*\)$", ""))
    )

    def to_vertex(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(xy, F.lit(0)).try_cast("double").alias("x"),
                        F.get(xy, F.lit(1)).try_cast("double").alias("y"))

    def to_ring(ring: Column) -> Column:
        return F.transform(F.split(ring, r"\s*,\s*"), to_vertex)

    def to_part(part: Column) -> Column:
        return F.transform(F.split(part, r"\)\s*,\s*\("), to_ring)

    parts = F.transform(F.split(inner, r"\)\s*\)\s*,\s*\(\s*\("), to_part)
    empty = F.from_json(F.lit("[]"), PARTS_TYPE)
    return F.when(inner.isNotNull(), F.struct(
        kind.alias("kind"),
        F.when(F.upper(body) == "EMPTY", empty).otherwise(parts).alias("parts")))


def from_geojson(text: Column | str) -> Column:
    """Parse the geometry object of a GeoJSON feature (Point, Polygon, MultiPolygon)."""
    t = _col(text)
    kind = F.get_json_object(t, "$.type")
    coordinates = F.get_json_object(t, "$.coordinates")

    def to_vertex(pair: Column) -> Column:
        return F.struct(pair[0].alias("x"), pair[1].alias("y"))

    def to_part(part: Column) -> Column:
        return F.transform(part, lambda ring: F.transform(ring, to_vertex))

    lone = F.from_json(coordinates, "array<double>")
    single = F.from_json(coordinates, "array<array<array<double>>>")
    several = F.from_json(coordinates, "array<array<array<array<double>>>>")
    parts = (
        F.when(kind == "Point", F.array(F.array(F.array(to_vertex(lone)))))
        .when(kind == "Polygon", F.array(to_part(single)))
        .when(kind == "MultiPolygon", F.transform(several, to_part))
    )
    return F.when(parts.isNotNull(), F.struct(F.upper(kind).alias("kind"), parts.alias("parts")))
