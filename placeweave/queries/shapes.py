"""Geometry: text forms, vintages of shapes, projections, spatial joins and crosswalks."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions.geometry import from_wkt, mercator_x, mercator_y, point, polygon, to_wkt, vertices
from placeweave.operators.quality import unmatched
from placeweave.operators.rank import scan_row_id
from placeweave.operators.spatial import crop, points_within, polygons_intersect
from placeweave.plans import crosswalks, geography
from placeweave.queries.registry import (
    STATE_SQL, query, raw_state, table, triangle_pairs_sql, triangle_sql, triangles,
)
from placeweave.session import scratch_folder
from placeweave.sources import readers, sinks


@query(f"""
WITH {triangle_sql('tri')}
SELECT vec_id, printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS wkt,
       4 AS vertices, ax AS first_x, cy AS third_y FROM tri
""")
def wkt_roundtrip(spark, sf_dir):
    """Shapes written as text in full precision and parsed back."""
    texts = triangles(spark, sf_dir).select("vec_id", to_wkt("geometry").alias("text"))
    parsed = texts.select("vec_id", from_wkt("text").alias("geometry"))
    return parsed.select(
        "vec_id", to_wkt("geometry", 4).alias("wkt"), F.size(vertices("geometry")).alias("vertices"),
        vertices("geometry")[0]["x"].alias("first_x"), vertices("geometry")[2]["y"].alias("third_y"))


@query(f"""
WITH {triangle_sql('tri')}, r AS (SELECT *, rank() OVER (PARTITION BY label ORDER BY vec_id % 3 DESC) AS r FROM tri)
SELECT lpad(CAST(label AS VARCHAR), 11, '0') AS census_geoid,
       printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS wkt FROM r WHERE r = 1
""")
def latest_shape_per_key(spark, sf_dir):
    """Every shape of each key's latest vintage."""
    tracts = triangles(spark, sf_dir).select(
        F.lpad(F.col("label").cast("string"), 11, "0").alias("census_geoid"), (F.col("vec_id") % 3).alias("year"), "geometry")
    return geography.census_shapes(tracts).select("census_geoid", to_wkt("geometry", 4).alias("wkt"))


@query(f"""
WITH {triangle_sql('tri')},
v AS (SELECT '01' || lpad(CAST(label AS VARCHAR), 3, '0') AS county_geoid, 1990 AS year, * FROM tri
      UNION ALL SELECT '01' || lpad(CAST(label AS VARCHAR), 3, '0'), 2018, * FROM tri WHERE label < 5 AND ax > 0),
r AS (SELECT *, rank() OVER (PARTITION BY county_geoid ORDER BY year DESC) AS r FROM v)
SELECT county_geoid, printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS county_geometry
FROM r WHERE r = 1
""")
def county_shapes_export(spark, sf_dir):
    """All polygons of each county's latest vintage, as a table of keys and texts."""
    shapes = triangles(spark, sf_dir)
    code = F.lpad(F.col("label").cast("string"), 3, "0")
    old = shapes.select(F.lit("01").alias("ST"), code.alias("CO"), F.concat(F.lit("County "), code).alias("NAME"), "geometry")
    east = vertices("geometry")[0]["x"] > 0  # what the newer vintage still lists
    new = shapes.filter((F.col("label") < 5) & east).select(
        F.lit("01").alias("STATEFP"), code.alias("COUNTYFP"), F.concat(F.lit("01"), code).alias("GEOID"),
        F.concat(F.lit("County "), code).alias("NAME"), "geometry")
    latest = geography.county_shapes(geography.county_vintage_1990(old), geography.county_vintage_2018(new))
    return latest.select("county_geoid", to_wkt("geometry", 4).alias("county_geometry"))


@query("""
SELECT lpad(CAST(label AS VARCHAR), 11, '0') AS census_geoid, vec_id / 8 AS longitude, -(vec_id / 4) AS latitude
FROM (SELECT *, rank() OVER (PARTITION BY label ORDER BY vec_id % 3 DESC) AS r FROM embeddings) WHERE r = 1
""")
def latest_point_per_key(spark, sf_dir):
    """Internal points given as signed, zero-padded text."""
    raw = table(spark, sf_dir, "embeddings").select(
        F.lpad(F.col("label").cast("string"), 11, "0").alias("GEOID"), (F.col("vec_id") % 3).alias("year"),
        F.lit("01").alias("STATEFP"), F.lit("001").alias("COUNTYFP"), F.lit("000100").alias("TRACTCE"),
        F.concat(F.lit("+"), (F.col("vec_id") / 8).cast("string")).alias("INTPTLON"),
        F.concat(F.lit("-0"), (F.col("vec_id") / 4).cast("string")).alias("INTPTLAT"))
    return geography.census_coordinates(geography.tract_vintage(raw))


@query("""
SELECT vec_id, CAST(CAST(6378137 * radians(lon) AS DECIMAL(18,3)) AS DOUBLE) AS x,
       CAST(CAST(6378137 * ln(tan(pi() / 4 + radians(lat) / 2)) AS DECIMAL(18,3)) AS DOUBLE) AS y, 3857 AS srid
FROM (SELECT vec_id, embedding[1]::DOUBLE * 400 AS lon, embedding[2]::DOUBLE * 200 AS lat FROM embeddings)
""")
def mercator_points(spark, sf_dir):
    e = F.col("embedding")
    placed = table(spark, sf_dir, "embeddings").select("vec_id", point(e[0].cast("double") * 400, e[1].cast("double") * 200).alias("g"))
    at = F.col("g.parts")[0][0][0]
    metres = lambda c: c.cast("decimal(18,3)").cast("double")
    return placed.select("vec_id", metres(mercator_x(at["x"])).alias("x"), metres(mercator_y(at["y"])).alias("y"),
                         F.lit(3857).alias("srid"))


@query("""
SELECT vec_id, lon, lat FROM (SELECT vec_id, -95 + embedding[1]::DOUBLE * 200 AS lon, 36 + embedding[2]::DOUBLE * 100 AS lat FROM embeddings)
WHERE lon BETWEEN -125 AND -65 AND lat BETWEEN 22 AND 50
""")
def bbox_crop(spark, sf_dir):
    e = F.col("embedding")
    placed = table(spark, sf_dir, "embeddings").select(
        "vec_id", (-95 + e[0].cast("double") * 200).alias("lon"), (36 + e[1].cast("double") * 100).alias("lat"))
    return crop(placed, "lon", "lat", (-125, -65), (22, 50))


@query(f"""
WITH {triangle_sql('lo', 'label < 5')}, {triangle_sql('hi', 'label >= 5')}, {triangle_pairs_sql('lo', 'hi')}
SELECT l AS left_id, r AS right_id FROM pairs
""")
def triangle_intersects(spark, sf_dir):
    shapes = triangles(spark, sf_dir)
    low = shapes.filter(F.col("label") < 5).withColumnRenamed("vec_id", "left_id")
    high = shapes.filter(F.col("label") >= 5).withColumnRenamed("vec_id", "right_id")
    return polygons_intersect(low, "left_id", high, "right_id")


# Corners on a grid of 1/64 m; the touching corner is a place along an edge, rounded down to the grid: on the edge, or within a unit of it.
_CORNERS = {name: [f"CAST(floor(CAST({{e}}[{{i{i}}}] AS DOUBLE) * 536870912) AS BIGINT) + 2147483648", f"CAST(floor(CAST({{e}}[{{i{i + 1}}}] AS DOUBLE) * 536870912) AS BIGINT) + 2147483648"]
            for name, i in (("a", 0), ("b", 2), ("c", 4))}


def _corner_columns(first: int) -> str:
    """The corners' grid coordinates; ``first`` is the number of an array's first element."""
    numbers = {f"i{i}": i + first for i in range(6)}
    return ", ".join(f"{text.format(e='embedding', **numbers)} AS {name}{axis}" for name, texts in _CORNERS.items() for axis, text in zip("01", texts))


_EDGE_PLACE = "({a} * (97 - vec_id % 97) + {b} * (vec_id % 97)) {div} 97"


@query(f"""
WITH corner AS (SELECT vec_id, {_corner_columns(1)} FROM embeddings),
tract AS (SELECT vec_id, a0::HUGEINT AS ax, a1::HUGEINT AS ay, b0::HUGEINT AS bx, b1::HUGEINT AS by_, c0::HUGEINT AS cx, c1::HUGEINT AS cy
          FROM corner WHERE vec_id % 3 = 0),
place AS (SELECT *, {_EDGE_PLACE.format(a='a0', b='b0', div='//')} AS p0, {_EDGE_PLACE.format(a='a1', b='b1', div='//')} AS p1 FROM corner WHERE vec_id % 3 = 0),
neighbour AS (SELECT vec_id, p0::HUGEINT AS ax, p1::HUGEINT AS ay, (p0 - c0 + a0)::HUGEINT AS bx, (p1 - c1 + a1)::HUGEINT AS by_,
                     (p0 - c0 + b0)::HUGEINT AS cx, (p1 - c1 + b1)::HUGEINT AS cy FROM place),
{triangle_pairs_sql('tract', 'neighbour')}
SELECT l AS tract_id, r AS neighbour_id, l = r AS own FROM pairs
""")
def touching_neighbours(spark, sf_dir):
    """Neighbours that reach a tract's edge with one corner, or miss it b1 less than a grid unit, at coordinates of Web Mercator's size.

    The SQL compares whole grid numbers in 128-bit integers; here they are metres in doubles, whose plain products are too short for it.
    """
    grid = table(spark, sf_dir, "embeddings").where("vec_id % 3 = 0").selectExpr("vec_id", *_corner_columns(0).split(", "))
    grid = grid.selectExpr("*", f"{_EDGE_PLACE.format(a='a0', b='b0', div='div')} AS p0", f"{_EDGE_PLACE.format(a='a1', b='b1', div='div')} AS p1")

    def metres(x: str, y: str):
        return F.expr(f"({x}) / 64D"), F.expr(f"({y}) / 64D")
    tracts = grid.select(F.col("vec_id").alias("tract_id"), polygon(metres("a0", "a1"), metres("b0", "b1"), metres("c0", "c1")).alias("geometry"))
    neighbours = grid.select(F.col("vec_id").alias("neighbour_id"), polygon(
        metres("p0", "p1"), metres("p0 - c0 + a0", "p1 - c1 + a1"), metres("p0 - c0 + b0", "p1 - c1 + b1")).alias("geometry"))
    return polygons_intersect(tracts, "tract_id", neighbours, "neighbour_id").withColumn("own", F.col("tract_id") == F.col("neighbour_id"))


@query(f"""
WITH {triangle_sql('t')}, p AS (SELECT vec_id AS id, embedding[7]::DOUBLE AS x, embedding[8]::DOUBLE AS y FROM embeddings),
s AS (SELECT p.id AS point_id, t.vec_id AS id, sign((bx - ax) * (y - ay) - (by_ - ay) * (x - ax)) AS s1,
             sign((cx - bx) * (y - by_) - (cy - by_) * (x - bx)) AS s2, sign((ax - cx) * (y - cy) - (ay - cy) * (x - cx)) AS s3 FROM p, t)
SELECT point_id, id FROM s WHERE (s1 >= 0 AND s2 >= 0 AND s3 >= 0) OR (s1 <= 0 AND s2 <= 0 AND s3 <= 0)
""")
def point_in_triangle(spark, sf_dir):
    e = F.col("embedding")
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), e[6].cast("double").alias("x"), e[7].cast("double").alias("y"))
    return points_within(points, triangles(spark, sf_dir).select(F.col("vec_id").alias("id"), "geometry"))


@query(f"""
WITH {triangle_sql('tri')}
SELECT lpad(CAST(label + 1 AS VARCHAR), 2, '0') AS state_fips, 4 AS vertices, ax AS first_x, 4269 AS srid,
       printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS wkt FROM tri
""")
def state_shapes(spark, sf_dir):
    """State shapes written as features, then read back as structs and as WKT text; both agree."""
    path = scratch_folder(spark, "states")
    raw = triangles(spark, sf_dir).select(F.lpad((F.col("label") + 1).cast("string"), 2, "0").alias("STATEFP"), "geometry")
    sinks.write_features(geography.state_shapes(raw), path, "state_fips")
    kept = readers.read_parquet(spark, f"{path}/shapes").select("state_fips", to_wkt("geometry", 4).alias("wkt"))
    parsed = readers.read_wkt_table(spark, f"{path}/wkt", ["state_fips", "geometry_wkt"], "geometry_wkt")
    shown = parsed.select("state_fips", to_wkt("geometry", 4).alias("wkt"), F.size(vertices("geometry")).alias("vertices"),
                          vertices("geometry")[0]["x"].alias("first_x"), "srid")
    both = shown.join(kept.groupBy("state_fips", "wkt").agg(F.count("*").alias("stored")), ["state_fips", "wkt"])
    return both.select("state_fips", "vertices", "first_x", "srid", "wkt")


# --- crosswalks -------------------------------------------------------------------------------

HIGH = (5, 6, 7, 8, 9)  # regions; the other labels are tracts


def _tracts(spark, sf_dir, scale=1.0):
    shapes = triangles(spark, sf_dir, scale).filter(~F.col("label").isin(*HIGH))
    geoid = F.lpad(F.col("vec_id").cast("string"), 11, "0")
    return shapes.select(geoid.alias("GEOID"), F.concat(F.lit("1400000US"), geoid).alias("GEOIDFQ"), "geometry")


def _regions(spark, sf_dir, labels, scale=1.0):
    return triangles(spark, sf_dir, scale).filter(F.col("label").isin(*labels)).withColumn("code", F.col("vec_id").cast("string"))


def raw_cbsa(spark, sf_dir):
    return _regions(spark, sf_dir, HIGH).select(
        F.col("code").alias("CBSAFP"), F.col("code").alias("GEOID"), F.concat(F.lit("310M700US"), "code").alias("GEOIDFQ"),
        F.concat(F.lit("Area "), "code").alias("NAME"), F.when(F.col("label") == 5, F.lit("M1")).otherwise(F.lit("M2")).alias("LSAD"),
        "geometry")


TRACT_ID_SQL = "lpad(CAST(r AS VARCHAR), 11, '0') AS census_geoid, '1400000US' || lpad(CAST(r AS VARCHAR), 11, '0') AS census_geoidfq"


@query(f"""
WITH {triangle_sql('area', 'label >= 5')}, {triangle_sql('tract', 'label < 5')}, {triangle_pairs_sql('area', 'tract')}
SELECT 'Area ' || l AS cbsa_name, CASE label WHEN 5 THEN 'metro' ELSE 'micro' END AS cbsa_type, CAST(l AS VARCHAR) AS cbsa_fips,
       CAST(l AS VARCHAR) AS cbsa_geoid, '310M700US' || l AS cbsa_geoidfq, {TRACT_ID_SQL}
FROM pairs JOIN area ON l = vec_id
""")
def cbsa_crosswalk(spark, sf_dir):
    return crosswalks.cbsa_to_tract(raw_cbsa(spark, sf_dir), _tracts(spark, sf_dir))


@query(f"""
WITH {triangle_sql('area', 'label >= 5')}, {triangle_sql('tract', 'label < 5')}, {triangle_pairs_sql('area', 'tract')}
SELECT CAST(l AS VARCHAR) AS csa_fips, CAST(l AS VARCHAR) AS csa_geoid, '330M700US' || l AS csa_geoidfq, 'Combined ' || l AS csa_name, {TRACT_ID_SQL}
FROM pairs
""")
def csa_crosswalk(spark, sf_dir):
    raw = _regions(spark, sf_dir, HIGH).select(
        F.col("code").alias("CSAFP"), F.col("code").alias("GEOID"), F.concat(F.lit("330M700US"), "code").alias("GEOIDFQ"),
        F.concat(F.lit("Combined "), "code").alias("NAME"), "geometry")
    return crosswalks.csa_to_tract(raw, _tracts(spark, sf_dir))


_LON = "6378137 * radians({})"
_LAT = "6378137 * ln(tan(pi() / 4 + radians({}) / 2))"


@query(f"""
WITH {triangle_sql('area', 'label >= 5', '100', _LON, _LAT)}, {triangle_sql('tract', 'label < 5', '100', _LON, _LAT)},
{triangle_pairs_sql('area', 'tract')},
n AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS edd_index FROM embeddings)
SELECT edd_index, 'District ' || CAST(999999 - l AS VARCHAR) AS edd_full_name, {TRACT_ID_SQL} FROM pairs JOIN n ON l = vec_id
""")
def edd_crosswalk(spark, sf_dir):
    """Districts against tracts in Web Mercator, with the district's place in its file, which is not the order of the names."""
    places = scan_row_id(table(spark, sf_dir, "embeddings"), "edd_index", first=0).select("vec_id", "edd_index")
    raw = _regions(spark, sf_dir, HIGH, 100.0).join(places, "vec_id").select(
        "edd_index", F.concat(F.lit("District "), (999_999 - F.col("vec_id")).cast("string")).alias("FullName"), "geometry")
    return crosswalks.edd_to_census_tract(raw, _tracts(spark, sf_dir, 100.0))


@query(f"""
WITH {triangle_sql('area', 'label >= 5')}, {triangle_sql('tract', 'label < 5')}, {triangle_pairs_sql('area', 'tract')}
SELECT CAST(vec_id AS VARCHAR) AS cbsa_geoid, 'Area ' || vec_id AS cbsa_name FROM area WHERE vec_id NOT IN (SELECT l FROM pairs)
""")
def regions_without_tract(spark, sf_dir):
    """Regions that meet no tract."""
    raw, tracts = raw_cbsa(spark, sf_dir), _tracts(spark, sf_dir)
    regions = crosswalks.cbsa_regions(raw).select("cbsa_geoid", "cbsa_name")
    return unmatched(regions, crosswalks.cbsa_to_tract(raw, tracts), "cbsa_geoid")


@query(f"""
WITH {triangle_sql('area', 'label >= 5')}, {triangle_sql('tract', 'label < 5')}, {triangle_pairs_sql('area', 'tract')}
SELECT 'metro' AS cbsa_type, '1400000US' || lpad(CAST(r AS VARCHAR), 11, '0') AS census_geoidfq,
       printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', t.ax, t.ay, t.bx, t.by_, t.cx, t.cy, t.ax, t.ay) AS wkt
FROM pairs JOIN area a ON l = a.vec_id JOIN tract t ON r = t.vec_id WHERE a.label = 5
""")
def region_tract_subset(spark, sf_dir):
    """Shapes of the tracts that regions of one type meet."""
    tracts = _tracts(spark, sf_dir)
    crosswalk = crosswalks.cbsa_to_tract(raw_cbsa(spark, sf_dir), tracts)
    # A tract's text is written once, however many regions meet it.
    shapes = tracts.select(F.col("GEOIDFQ").alias("census_geoidfq"), to_wkt("geometry", 4).alias("wkt"))
    return crosswalks.tracts_of_region(crosswalk, "cbsa_type", "metro", shapes)


@query(f"""
WITH {triangle_sql('tri')}, {STATE_SQL}
SELECT state_name, printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS wkt
FROM tri JOIN state ON state_fips = lpad(CAST(label + 1 AS VARCHAR), 2, '0') WHERE state_name NOT IN ('AFRICA', 'ASIA')
""")
def map_base(spark, sf_dir):
    """Named state shapes without the excluded states."""
    raw = triangles(spark, sf_dir).select(
        F.lpad((F.col("label") + 1).cast("string"), 2, "0").alias("STATEFP"), "geometry")
    shapes = geography.state_shapes(raw)
    base = geography.contiguous_state_shapes(shapes, geography.state_dims(raw_state(spark, sf_dir)), ("AFRICA", "ASIA"))
    return base.select("state_name", to_wkt("geometry", 4).alias("wkt"))
