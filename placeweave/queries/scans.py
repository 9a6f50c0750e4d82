"""Scans and sinks: text, Parquet, preambles, many files, boundary text."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions.geometry import to_wkt, vertices
from placeweave.functions.text import text_to_double, text_to_int
from placeweave.operators.reshape import map_columns, stack_rows
from placeweave.plans.geography import state_dims, tract_dims_2023, warehouse_tract_dims
from placeweave.queries.registry import (
    PLACE_SQL, STATE_SQL, geoid_of, place_of_nation, query, raw_state, table, triangle_sql, triangles,
)
from placeweave.session import scratch_folder
from placeweave.sources import readers, sinks


@query("""
SELECT p_partkey AS part_id, CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', chr(10)) ELSE p_name END AS part_name,
       CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_brand END AS brand,
       CASE WHEN p_size > 40 THEN NULL ELSE CAST(p_size AS BIGINT) END AS size,
       p_retailprice AS retail_price
FROM part
""")
def typed_scan_cast(spark, sf_dir):
    """Text file with spaced headers, quoted line breaks and bad cells, read as text and then typed."""
    path = scratch_folder(spark, "parts")
    part = table(spark, sf_dir, "part")
    sinks.write_text_table(part.select(
        F.col("p_partkey").alias("Part ID"),
        F.when(F.col("p_partkey") % 5 == 0, F.replace("p_name", F.lit(" "), F.lit("\n"))).otherwise(F.col("p_name")).alias("Part Name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_brand")).alias("Brand"),
        F.when(F.col("p_size") > 40, F.lit("unknown")).otherwise(F.col("p_size").cast("string")).alias("Part Size"),
        F.col("p_retailprice").alias("Retail Price")), path)
    read = readers.read_text_table(
        spark, path, ["Part ID", "Part Name", "Brand", "Part Size", "Retail Price"], {"Part ID": "long"}, multiline=True)
    typed = map_columns(map_columns(read, ["Part Size"], text_to_int), ["Retail Price"], text_to_double)
    return typed.select(
        F.col("`Part ID`").alias("part_id"), F.col("`Part Name`").alias("part_name"), F.col("Brand").alias("brand"),
        F.col("`Part Size`").cast("long").alias("size"), F.col("`Retail Price`").alias("retail_price"))


@query(f"""
WITH {triangle_sql('tri')},
p AS (SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_name || ', "' || p_type || '"' END AS label,
             p_retailprice FROM part)
SELECT 'parquet' AS sink, p_partkey AS key, label, p_retailprice AS amount FROM p
UNION ALL SELECT 'text', p_partkey, label, p_retailprice FROM p
UNION ALL SELECT 'shapes', vec_id, NULL, bx FROM tri
UNION ALL SELECT 'wkt', vec_id, printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))',
                                       ax, ay, bx, by_, cx, cy, ax, ay), NULL FROM tri
""")
def sink_roundtrip(spark, sf_dir):
    """Parquet, text with missing and quoted cells, and feature sinks, read back."""
    path = scratch_folder(spark, "sinks")
    part = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(F.col("p_type") != "PROMO",
               F.concat("p_name", F.lit(', "'), "p_type", F.lit('"'))).alias("label"),
        "p_retailprice")
    sinks.write_parquet(part, f"{path}/parquet")
    sinks.write_text_table(part, f"{path}/text")
    shapes = triangles(spark, sf_dir).select("vec_id", "geometry")
    sinks.write_parquet(shapes, f"{path}/shapes")
    sinks.write_text_table(sinks.wkt_table(shapes, "vec_id", digits=4), f"{path}/wkt")

    def rows(sink, df, key, label, amount):
        return df.select(F.lit(sink).alias("sink"), F.col(key).cast("long").alias("key"),
                         label.alias("label"), amount.cast("double").alias("amount"))

    text = readers.read_text_table(spark, f"{path}/text", ["p_partkey", "label", "p_retailprice"])
    wkt = readers.read_text_table(spark, f"{path}/wkt", ["vec_id", "geometry_wkt"])
    nothing = F.lit(None).cast("string")
    return stack_rows(
        rows("parquet", readers.read_parquet(spark, f"{path}/parquet"), "p_partkey", F.col("label"), F.col("p_retailprice")),
        rows("text", text, "p_partkey", F.col("label"), text_to_double("p_retailprice")),
        rows("shapes", readers.read_parquet(spark, f"{path}/shapes"), "vec_id", nothing, vertices("geometry")[1]["x"]),
        rows("wkt", wkt, "vec_id", F.col("geometry_wkt"), nothing),
    )


@query("""
SELECT o_orderkey AS unique_id, o_orderstatus AS segment, 'No. ' || o_custkey || ', "' || o_orderpriority || '"' AS address,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS capex
FROM orders
""")
def skip_preamble_scan(spark, sf_dir):
    """Text files that each start with five banner lines, then a header."""
    path = scratch_folder(spark, "preamble")
    quoted = F.concat(F.lit('"No. '), "o_custkey", F.lit(', ""'), "o_orderpriority", F.lit('"""'))
    capex = F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", quoted, capex)
    banner = "\n".join(["Facility export", "not for citation", "", "see the manual, page 3", "----", "unique_id,segment,address,capex"])
    first_of_file = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    table(spark, sf_dir, "orders").select(
        F.when(first_of_file, F.concat(F.lit(banner + "\n"), line)).otherwise(line).alias("value")
    ).write.text(path)
    return readers.read_text_after_preamble(
        spark, path, ["unique_id", "segment", "address", "capex"], skip=5,
        types={"unique_id": "long", "capex": "double"})


@query("""
SELECT year(o_orderdate)::BIGINT AS vintage, 'orders' AS dataset_name, o_orderkey, o_custkey FROM orders
""")
def vintage_scan(spark, sf_dir):
    """One scan over a tree of per-vintage files; the vintage comes from the path."""
    path = scratch_folder(spark, "vintages")
    orders = table(spark, sf_dir, "orders").withColumn("in_year", F.year("o_orderdate"))
    sinks.write_parquet(orders, path, partition_by=["in_year"])
    tagged = readers.read_vintages(spark, path, r"in_year=(\d{4})", vintage_column="vintage")
    return tagged.select(F.col("vintage").cast("long").alias("vintage"), F.lit("orders").alias("dataset_name"),
                         "o_orderkey", "o_custkey")


@query(f"""
WITH {PLACE_SQL}
SELECT DISTINCT state_name, state_fips, county_fips, substr(lpad(CAST(o_custkey AS VARCHAR), 11, '0'), 6, 6) AS census_tract,
       lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS census_geoid
FROM orders JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey
ORDER BY state_fips, county_fips, census_geoid
""")
def distinct_ordered_dims(spark, sf_dir):
    """Distinct tract dimensions out of a table that repeats them, ordered."""
    place = place_of_nation(spark, sf_dir).select("n_nationkey", "state_name", "state_fips", "county_fips")
    # Keys first: the repeated rows need not travel through the dimension joins.
    ordered_keys = table(spark, sf_dir, "orders").select("o_custkey").distinct()
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geoid = geoid_of("o_custkey")
    repeated = (
        ordered_keys.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("state_name", F.col("state_fips").alias("state_fips_code"), F.col("county_fips").alias("county_fips_code"),
                F.substring(geoid, 6, 6).alias("tract_ce"), geoid.alias("geo_id")))
    return warehouse_tract_dims(repeated)


@query(f"""
WITH {STATE_SQL}
SELECT state_fips, state_name_abbrev, state_name FROM state ORDER BY state_fips
""")
def state_dimension(spark, sf_dir):
    return sinks.sorted_for_sink(state_dims(raw_state(spark, sf_dir)), "state_fips")


@query(f"""
WITH {PLACE_SQL}
SELECT state_fips, county_fips, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS census_geoid,
       '1400000US' || lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS census_geoidfq
FROM customer JOIN place ON c_nationkey = n_nationkey ORDER BY census_geoid
""")
def tract_dimension_2023(spark, sf_dir):
    place = place_of_nation(spark, sf_dir).select("n_nationkey", "state_fips", "county_fips")
    geoid = geoid_of("c_custkey")
    raw = table(spark, sf_dir, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("state_fips").alias("STATEFP"), F.col("county_fips").alias("COUNTYFP"), geoid.alias("GEOID"),
        F.concat(F.lit("1400000US"), geoid).alias("GEOIDFQ"))
    return sinks.sorted_for_sink(tract_dims_2023(raw), "census_geoid")


@query(f"""
WITH {triangle_sql('tri')}
SELECT CAST(vec_id AS VARCHAR) AS vec_id, 'label ' || label AS name, 'POLYGON' AS kind,
       printf('POLYGON ((%.4f %.4f, %.4f %.4f, %.4f %.4f, %.4f %.4f))', ax, ay, bx, by_, cx, cy, ax, ay) AS wkt
FROM tri
""")
def geojson_scan(spark, sf_dir):
    """Line-delimited GeoJSON features written from the triangles and parsed back."""
    path = scratch_folder(spark, "geojson")
    ring = F.array_join(F.transform(vertices("geometry"), lambda v: F.concat(
        F.lit("["), v["x"].cast("string"), F.lit(","), v["y"].cast("string"), F.lit("]"))), ",")
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"vec_id":"'), F.col("vec_id").cast("string"),
        F.lit('","name":"label '), F.col("label").cast("string"),
        F.lit('"},"geometry":{"type":"Polygon","coordinates":[['), ring, F.lit("]]}}"))
    triangles(spark, sf_dir).select(feature.alias("value")).write.text(path)
    features = readers.read_geojson_features(spark, path, ["vec_id", "name"])
    return features.select("vec_id", "name", F.col("geometry.kind").alias("kind"), to_wkt("geometry", 4).alias("wkt"))
