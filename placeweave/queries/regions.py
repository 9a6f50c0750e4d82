"""Region metrics, rankings, drill-down and dyads."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators.joins import equi_join
from placeweave.plans import metrics
from placeweave.plans.crosswalks import points_to_regions
from placeweave.queries.registry import (
    PLACE_SQL, geoid_of, place_of_nation, query, table, triangle_sql, triangles,
)
from placeweave.session import scratch_folder
from placeweave.sources import readers, sinks


def _observations(spark, sf_dir):
    """Dollars and capacity per order, keyed by tract."""
    capacity = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").alias("capacity"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 0.0125).alias("dollars"))
    joined = equi_join(orders, capacity, [("o_orderkey", "l_orderkey")], "left", missing_matches=False)
    return joined.select("o_orderkey", geoid_of("o_custkey").alias("census_geoid"), "dollars", "capacity")


def _tracts(spark, sf_dir):
    place = place_of_nation(spark, sf_dir).select("n_nationkey", "county_name", "state_name")
    return table(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        geoid_of("c_custkey").alias("census_geoid"), "county_name", "state_name")


def _rollup(spark, sf_dir):
    levels = metrics.region_levels(
        _tracts(spark, sf_dir), "census_geoid", {"state": "state_name", "county": "county_name", "tract": "census_geoid"})
    return metrics.metric_rollup(_observations(spark, sf_dir), "census_geoid", ["dollars", "capacity"], levels)


ROLLUP_SQL = PLACE_SQL + """,
cap AS (SELECT l_orderkey, sum(l_quantity) AS capacity FROM lineitem GROUP BY 1),
obs AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS g, o_totalprice * 0.0125::DOUBLE AS dollars, capacity,
               county_name, state_name
        FROM orders LEFT JOIN cap ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey),
u AS (SELECT 'state' AS level, state_name AS region, dollars, capacity FROM obs
      UNION ALL SELECT 'county', county_name, dollars, capacity FROM obs UNION ALL SELECT 'tract', g, dollars, capacity FROM obs),
rollup_ AS (SELECT level, region, count(*) AS observations, sum(dollars) AS dollars, sum(capacity)::DOUBLE AS capacity FROM u GROUP BY 1, 2)"""

# Values are summed as they come; only what is shown is rounded, to six places.
SHOWN_SQL = "level, region, observations, dollars::DECIMAL(20,6)::DOUBLE AS dollars, capacity::DECIMAL(20,6)::DOUBLE AS capacity"


def _shown(df, *columns):
    return df.withColumns({c: F.col(c).cast("decimal(20,6)").cast("double") for c in columns})


@query(f"WITH {ROLLUP_SQL} SELECT {SHOWN_SQL} FROM rollup_")
def metric_rollup(spark, sf_dir):
    return _shown(_rollup(spark, sf_dir), "dollars", "capacity")


@query(f"""
WITH {ROLLUP_SQL},
m AS (SELECT g, 'market' AS level, lower(county_name) AS region, dollars FROM obs
      UNION ALL SELECT g, 'market', lower(state_name) || ' area', dollars FROM obs WHERE substr(g, 11, 1) = '7'
      UNION ALL SELECT g, 'county', county_name, dollars FROM obs)
SELECT level, region, count(*) AS observations, sum(dollars)::DECIMAL(20,6)::DOUBLE AS dollars, level = 'market' AS overlapping
FROM m GROUP BY level, region
""")
def labelled_totals(spark, sf_dir):
    """Totals of a level whose regions share tracts, and of one whose regions do not, each row saying which."""
    tracts = _tracts(spark, sf_dir)
    markets = tracts.withColumn("region", F.explode(F.array_compact(F.array(
        F.lower("county_name"), F.when(F.substring("census_geoid", 11, 1) == "7", F.concat(F.lower("state_name"), F.lit(" area")))))))
    crosswalk = markets.select("census_geoid", F.lit("market").alias("level"), "region").unionByName(
        tracts.select("census_geoid", F.lit("county").alias("level"), F.col("county_name").alias("region")))
    rollup = metrics.metric_rollup(_observations(spark, sf_dir), "census_geoid", ["dollars"], crosswalk)
    return _shown(metrics.label_overlaps(rollup, crosswalk), "dollars")


@query(f"""
WITH {ROLLUP_SQL},
p AS (SELECT *, percent_rank() OVER (PARTITION BY level ORDER BY dollars) AS dollars_rank,
             percent_rank() OVER (PARTITION BY level ORDER BY capacity) AS capacity_rank FROM rollup_),
s AS (SELECT *, 0.5::DOUBLE * dollars_rank + 0.5::DOUBLE * capacity_rank AS score FROM p)
SELECT {SHOWN_SQL}, dollars_rank, capacity_rank, score, rank() OVER (PARTITION BY level ORDER BY score DESC) AS place FROM s
""")
def region_rank(spark, sf_dir):
    return _shown(metrics.region_rank(_rollup(spark, sf_dir), {"dollars": 0.5, "capacity": 0.5}), "dollars", "capacity")


COMPETITIVE_SQL = ROLLUP_SQL + """,
lim AS (SELECT level, quantile_cont(dollars, 0.75) AS d, quantile_cont(capacity, 0.75) AS c, quantile_cont(observations::DOUBLE, 0.75) AS o FROM rollup_ GROUP BY 1),
comp AS (SELECT level, region, observations, dollars, capacity,
                (CASE WHEN dollars >= d THEN 1 ELSE 0 END + CASE WHEN capacity >= c THEN 1 ELSE 0 END + CASE WHEN observations >= o THEN 1 ELSE 0 END)::BIGINT AS high_metrics
         FROM rollup_ JOIN lim USING (level))"""


@query(f"WITH {COMPETITIVE_SQL} SELECT {SHOWN_SQL}, high_metrics, high_metrics >= 2 AS competitive FROM comp")
def competitive_regions(spark, sf_dir):
    flagged = metrics.competitive_regions(_rollup(spark, sf_dir), ["dollars", "capacity", "observations"])
    return _shown(flagged.withColumn("high_metrics", F.col("high_metrics").cast("long")), "dollars", "capacity")


@query(f"""
WITH {COMPETITIVE_SQL}
SELECT o_orderkey, o_totalprice * 0.0125::DOUBLE AS dollars, n_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN (SELECT region FROM comp WHERE level = 'county' AND high_metrics >= 2)
""")
def drill_down(spark, sf_dir):
    """The observations inside competitive counties."""
    counties = metrics.competitive_regions(
        _rollup(spark, sf_dir).filter(F.col("level") == "county"), ["dollars", "capacity", "observations"]
    ).filter("competitive")
    tracts = _tracts(spark, sf_dir).select("census_geoid", F.col("county_name").alias("region"))
    placed = equi_join(_observations(spark, sf_dir), tracts, ["census_geoid"])
    return metrics.drill_down(counties, "region", placed).select("o_orderkey", "dollars", "region")


@query(f"WITH {ROLLUP_SQL} SELECT {SHOWN_SQL}, (capacity / nullif(dollars, 0))::DECIMAL(20,9)::DOUBLE AS ratio FROM rollup_")
def ratio_by_region(spark, sf_dir):
    rates = metrics.ratio_by_region(_rollup(spark, sf_dir), "capacity", "dollars")
    return _shown(rates, "dollars", "capacity").withColumn("ratio", F.col("ratio").cast("decimal(20,9)").cast("double"))


@query(f"""
WITH {triangle_sql('t')}, p AS (SELECT vec_id AS id, embedding[7]::DOUBLE AS x, embedding[8]::DOUBLE AS y, vec_id * 1.0625::DOUBLE AS mw FROM embeddings),
s AS (SELECT label, t.vec_id AS region, mw, sign((bx - ax) * (y - ay) - (by_ - ay) * (x - ax)) AS s1,
             sign((cx - bx) * (y - by_) - (cy - by_) * (x - bx)) AS s2, sign((ax - cx) * (y - cy) - (ay - cy) * (x - cx)) AS s3 FROM p, t)
SELECT 'district' AS level, CAST(region AS VARCHAR) AS region, count(*) AS observations, sum(mw)::DECIMAL(20,6)::DOUBLE AS capacity_mw
FROM s WHERE (s1 >= 0 AND s2 >= 0 AND s3 >= 0) OR (s1 <= 0 AND s2 <= 0 AND s3 <= 0) GROUP BY region
""")
def capacity_by_district(spark, sf_dir):
    """Capacity of observations that have coordinates only, per overlapping region."""
    e = F.col("embedding")
    points = table(spark, sf_dir, "embeddings").select(
        "vec_id", e[6].cast("double").alias("x"), e[7].cast("double").alias("y"), (F.col("vec_id") * 1.0625).alias("capacity_mw"))
    regions = triangles(spark, sf_dir).select(F.col("vec_id").cast("string").alias("region"), "geometry")
    districts = points_to_regions(points, "vec_id", "x", "y", regions, "region").withColumn("level", F.lit("district"))
    return _shown(metrics.metric_rollup(points, "vec_id", ["capacity_mw"], districts), "capacity_mw")


@query(f"""
WITH {ROLLUP_SQL},
o AS (SELECT obs.*, c_mktsegment AS s FROM obs JOIN customer ON g = lpad(CAST(c_custkey AS VARCHAR), 11, '0'))
SELECT level, count(*) AS observations, sum(dollars)::DECIMAL(20,6)::DOUBLE AS dollars, sum(capacity)::DOUBLE AS capacity
FROM (SELECT 'tract' AS level, dollars, capacity FROM o WHERE s = 'BUILDING' UNION ALL SELECT 'county', dollars, capacity FROM o WHERE s IN ('BUILDING', 'MACHINERY')) GROUP BY 1
""")
def unplaced_by_level(spark, sf_dir):
    """Observations that a crosswalk with gaps leaves without a region, level by level."""
    tracts = _tracts(spark, sf_dir).join(
        table(spark, sf_dir, "customer").select(geoid_of("c_custkey").alias("census_geoid"), "c_mktsegment"), "census_geoid")
    known = tracts.filter(F.col("c_mktsegment") != "BUILDING").withColumn(
        "county_name", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("county_name")))
    crosswalk = metrics.region_levels(known, "census_geoid", {"county": "county_name", "tract": "census_geoid"})
    return _shown(metrics.unplaced_totals(_observations(spark, sf_dir), "census_geoid", ["dollars", "capacity"], crosswalk), "dollars")


@query(f"""
WITH {ROLLUP_SQL}
SELECT sink, {SHOWN_SQL} FROM rollup_, (VALUES ('parquet'), ('text')) AS sinks(sink) WHERE level <> 'tract'
""")
def region_table_export(spark, sf_dir):
    """The region table written as Parquet and as text, and read back from both."""
    path = scratch_folder(spark, "region-export")
    regions = _shown(_rollup(spark, sf_dir).filter(F.col("level") != "tract"), "dollars", "capacity")
    sinks.write_parquet(regions, f"{path}/parquet")
    sinks.write_text_table(regions, f"{path}/text")
    types = {"observations": "long", "dollars": "double", "capacity": "double"}
    text = readers.read_text_table(spark, f"{path}/text", regions.columns, types)
    return readers.read_parquet(spark, f"{path}/parquet").withColumn("sink", F.lit("parquet")).unionByName(text.withColumn("sink", F.lit("text")))


# --- dyads -----------------------------------------------------------------------------------

RADIUS = 400_000.0


def _places(spark, sf_dir, low: bool):
    """Points of low labels (capacity) or high labels (investment), in degrees; the day is the event date."""
    e = F.col("embedding")
    side = F.col("label") < 5 if low else F.col("label") >= 5
    return table(spark, sf_dir, "embeddings").filter(side).select(
        F.concat(F.lit("kind "), F.col("label").cast("string")).alias("kind"),
        (e[0].cast("double") * 400).alias("lon"), (e[1].cast("double") * 200).alias("lat"),
        (F.col("vec_id") * 1.0625).alias("worth"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("vec_id").cast("int") % 100).alias("day"))


DYAD_SQL = """
pl AS (SELECT label < 5 AS low, 'kind ' || label AS kind, embedding[1]::DOUBLE * 400 AS lon, embedding[2]::DOUBLE * 200 AS lat,
              DATE '2024-01-01' + (vec_id % 100)::INT AS day, vec_id * 1.0625::DOUBLE AS worth FROM embeddings),
g AS (SELECT low, kind, lon, lat, day, count(*) AS quantity, sum(worth)::DECIMAL(20,6)::DOUBLE AS worth FROM pl GROUP BY 1, 2, 3, 4, 5),
d AS (SELECT l.kind AS l_kind, r.kind AS r_kind, l.worth AS l_value, r.worth AS r_value, l.quantity * r.quantity AS quantity,
             (r.day - l.day)::BIGINT AS lag_days,
             2 * 6371008.8 * asin(sqrt(least(1::DOUBLE, pow(sin(radians(r.lat - l.lat) / 2), 2)
               + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2)))) AS distance
      FROM g l JOIN g r ON l.low AND NOT r.low),
near AS (SELECT * FROM d WHERE distance <= 400000)"""


@query(f"""
WITH {DYAD_SQL}
SELECT l_kind, r_kind, l_value, r_value, quantity, lag_days, CAST(CAST(distance AS DECIMAL(18,3)) AS DOUBLE) AS distance FROM near
""")
def dyad_within_radius(spark, sf_dir):
    """Pairs of places of two kinds within 400 km, with quantity, distance and lag."""
    pairs = metrics.dyads(_places(spark, sf_dir, True), _places(spark, sf_dir, False), RADIUS, value="worth", day="day")
    return _shown(pairs, "l_value", "r_value").select("l_kind", "r_kind", "l_value", "r_value", "quantity", F.col("lag_days").cast("long").alias("lag_days"),
                        F.col("distance").cast("decimal(18,3)").cast("double").alias("distance"))


@query(f"""
WITH {DYAD_SQL}
SELECT l_kind, r_kind, sum(quantity)::BIGINT AS dyads, CAST(CAST(min(distance) AS DECIMAL(18,3)) AS DOUBLE) AS nearest,
       CAST(CAST(sum(quantity * distance) / sum(quantity) AS DECIMAL(18,3)) AS DOUBLE) AS mean_distance
FROM near GROUP BY 1, 2
""")
def dyad_summary(spark, sf_dir):
    pairs = metrics.dyads(_places(spark, sf_dir, True), _places(spark, sf_dir, False), RADIUS)
    metres = lambda c: F.col(c).cast("decimal(18,3)").cast("double").alias(c)
    return metrics.dyad_summary(pairs).select("l_kind", "r_kind", "dyads", metres("nearest"), metres("mean_distance"))


@query("""
WITH p AS (SELECT label < 5 AS chosen, 'kind ' || label AS kind, embedding[1]::DOUBLE * 400 AS lon, embedding[2]::DOUBLE * 200 AS lat FROM embeddings),
g AS (SELECT chosen, kind, lon, lat, count(*) AS quantity FROM p GROUP BY 1, 2, 3, 4),
d AS (SELECT l.kind AS l_kind, l.lon AS l_lon, l.lat AS l_lat, r.kind AS r_kind, r.lon AS r_lon, r.lat AS r_lat, r.quantity AS r_quantity,
             2 * 6371008.8 * asin(sqrt(least(1::DOUBLE, pow(sin(radians(r.lat - l.lat) / 2), 2)
               + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2)))) AS distance
      FROM g l JOIN g r ON l.chosen AND NOT r.chosen),
n AS (SELECT *, row_number() OVER (PARTITION BY l_kind, l_lon, l_lat ORDER BY distance, r_kind, r_lon, r_lat) AS place FROM d WHERE distance <= 400000)
SELECT l_kind, l_lon, l_lat, r_kind, r_quantity, place, CAST(CAST(distance AS DECIMAL(18,3)) AS DOUBLE) AS distance FROM n WHERE place <= 3
""")
def remainder_nearby(spark, sf_dir):
    """Of the places of other kinds, the three nearest around each place of the chosen kinds."""
    projects = _places(spark, sf_dir, True).unionByName(_places(spark, sf_dir, False))
    low = F.substring("kind", 6, 9).cast("int") < 5
    found = metrics.remainder_nearby(projects, low, 3, RADIUS)
    return found.select("l_kind", "l_lon", "l_lat", "r_kind", "r_quantity", F.col("place").cast("long").alias("place"),
                        F.col("distance").cast("decimal(18,3)").cast("double").alias("distance"))


@query(f"WITH {DYAD_SQL} SELECT l_kind, r_kind, sum(quantity)::BIGINT AS dyads FROM near GROUP BY 1, 2")
def dyad_counts(spark, sf_dir):
    """How many dyads each pair of kinds has, counted by cells."""
    return metrics.dyad_counts(_places(spark, sf_dir, True), _places(spark, sf_dir, False), RADIUS)
