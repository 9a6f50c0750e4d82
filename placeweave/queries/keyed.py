"""Keys and joins: coverage, resolution, guarded and natural joins, vintages, name drift, key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions.text import pad_left, pad_right
from placeweave.operators.aggregate import member_rates, repeated_keys, row_ratio
from placeweave.operators.joins import (
    absent_from, equi_join, many_to_one, member_flag, name_changes, natural_join, present_in,
)
from placeweave.operators.keys import county_geoids, geoid_coverage as coverage, resolve_geoid, variant_coverage
from placeweave.operators.quality import (
    count_of, key_coverage, missing_share, no_duplicate_rows, no_fan_out, same_row_count, surviving_share, unique_key,
)
from placeweave.operators.rank import highest_per_key, lowest_per_key
from placeweave.operators.reshape import stack_rows
from placeweave.plans import geography
from placeweave.queries.registry import (
    JOINER_SQL, ORDER_KEY_SQL, PLACE_SQL, TRACT_SQL, customer_joiner, place_of_nation, query, table,
    tract_dims_of_customer, tract_key_of_order,
)


@query("""
SELECT l_returnflag, sum(CASE WHEN p_partkey IS NOT NULL THEN 1 ELSE 0 END) / count(*) AS prop,
       sum(CASE WHEN p_partkey IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS num_matches,
       sum(CASE WHEN p_partkey IS NOT NULL THEN 0 ELSE 1 END)::BIGINT AS num_bad
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) ON l_partkey = p_partkey
GROUP BY l_returnflag
""")
def membership_flag_rate(spark, sf_dir):
    small = table(spark, sf_dir, "part").filter(F.col("p_size") <= 25)
    return member_rates(table(spark, sf_dir, "lineitem"), "l_partkey", small, "p_partkey", "l_returnflag")


@query("""
SELECT o_orderkey, p_name IS NOT NULL AND p_name LIKE '%small%' AS is_known
FROM orders LEFT JOIN part ON o_custkey = p_partkey
""")
def membership_flag(spark, sf_dir):
    """A key looked up in a set: true or false for every row."""
    known = table(spark, sf_dir, "part").filter(F.col("p_name").contains("small"))
    flagged = member_flag(table(spark, sf_dir, "orders"), "o_custkey", known, "p_partkey", "is_known")
    return flagged.select("o_orderkey", "is_known")


@query(f"""
WITH k AS (SELECT {ORDER_KEY_SQL} AS geoid FROM orders),
c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS g FROM customer),
s AS (SELECT count(*) AS total, count(*) FILTER (geoid IN (SELECT g FROM c)) AS full_hits,
             count(*) FILTER (regexp_matches(geoid, '^[0-9]{{9}}') AND substr(geoid, 1, 9) IN (SELECT substr(g, 1, 9) FROM c)) AS short_hits FROM k)
SELECT 'as_is' AS match_kind, full_hits AS matched, total, full_hits / total AS rate,
       format('{{:,}} of {{:,}} census_geoids match as-is: {{}}%', full_hits, total, round_even(full_hits * 100 / total, 0)::INT) AS message FROM s
UNION ALL
SELECT 'abbreviated', short_hits, total, short_hits / total,
       format('{{:,}} of {{:,}} census_geoids match if abbreviated to 9 digits: {{}}%', short_hits, total, round_even(short_hits * 100 / total, 0)::INT) FROM s
""")
def geoid_coverage(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(tract_key_of_order().alias("geoid"))
    return coverage(keys, "geoid", customer_joiner(spark, sf_dir))


@query(f"""
WITH k AS (SELECT o_orderkey, {ORDER_KEY_SQL} AS geoid FROM orders),
c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS g FROM customer)
SELECT o_orderkey, geoid, CASE WHEN geoid IN (SELECT g FROM c) THEN geoid
       WHEN regexp_matches(geoid, '^[0-9]{{9}}') AND substr(geoid, 1, 9) IN (SELECT substr(g, 1, 9) FROM c) THEN substr(geoid, 1, 9)
       ELSE 'NO_MATCH' END AS census_geoid_joiner
FROM k
""")
def geoid_resolve(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey", tract_key_of_order().alias("geoid"))
    return resolve_geoid(keys, "geoid", customer_joiner(spark, sf_dir))


@query(f"WITH {JOINER_SQL} SELECT census_geoid, census_geoid_joiner FROM joiner")
def geoid_joiner(spark, sf_dir):
    return customer_joiner(spark, sf_dir)


@query(f"""
WITH {PLACE_SQL}, k AS (SELECT CAST(CAST(county_geoid AS INT) AS VARCHAR) AS county_geoid
                        FROM supplier JOIN place ON s_nationkey = n_nationkey),
v AS (SELECT 'county_geoid' AS variable, county_geoid AS value FROM k
      UNION ALL SELECT 'pad_left', CASE WHEN length(county_geoid) >= 5 THEN county_geoid ELSE lpad(county_geoid, 5, '0') END FROM k
      UNION ALL SELECT 'pad_right', CASE WHEN length(county_geoid) >= 5 THEN county_geoid ELSE rpad(county_geoid, 5, '0') END FROM k),
h AS (SELECT variable, value IN (SELECT county_geoid FROM place) AS hit FROM v)
SELECT variable, count(*) FILTER (hit) / count(*) AS prop, count(*) FILTER (hit) AS num_matches, count(*) FILTER (NOT hit) AS num_bad
FROM h GROUP BY variable
""")
def key_repair_rates(spark, sf_dir):
    """Match rate of a county key that lost its leading zero, as it is and padded on either side."""
    place = place_of_nation(spark, sf_dir)
    keys = table(spark, sf_dir, "supplier").join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("county_geoid").cast("int").cast("string").alias("county_geoid"))
    variants = {"county_geoid": F.col("county_geoid"), "pad_left": pad_left("county_geoid", 5),
                "pad_right": pad_right("county_geoid", 5)}
    return variant_coverage(keys, variants, county_geoids(place), "county_geoid")


# --- joins ------------------------------------------------------------------------

@query("""
SELECT o_orderkey, c_mktsegment, n_name, r_name
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def inner_join_dims(spark, sf_dir):
    place = equi_join(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), [("n_regionkey", "r_regionkey")], missing_matches=False)
    tract = equi_join(table(spark, sf_dir, "customer"), place, [("c_nationkey", "n_nationkey")], missing_matches=False)
    return equi_join(table(spark, sf_dir, "orders"), tract, [("o_custkey", "c_custkey")], missing_matches=False).select(
        "o_orderkey", "c_mktsegment", "n_name", "r_name")


@query("""
SELECT c_custkey, n_name, n_name IS NULL AS unnamed, n_name IS NOT NULL AND c_acctbal > 0 AS named_in_credit
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_name NOT IN ('NATION_1', 'NATION_7', 'NATION_13')) ON c_nationkey = n_nationkey
""")
def left_join_dims(spark, sf_dir):
    kept = table(spark, sf_dir, "nation").filter(
        (F.col("n_name") != "NATION_1") & (F.col("n_name") != "NATION_7") & (F.col("n_name") != "NATION_13"))
    joined = equi_join(table(spark, sf_dir, "customer"), kept, [("c_nationkey", "n_nationkey")], "left")
    return joined.select("c_custkey", "n_name", F.col("n_name").isNull().alias("unnamed"),
                         (F.col("n_name").isNotNull() & (F.col("c_acctbal") > 0)).alias("named_in_credit"))


@query("""
SELECT o_orderkey, c_mktsegment, n_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def many_to_one_join(spark, sf_dir):
    tract = many_to_one(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"),
                        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), [("c_nationkey", "n_nationkey")])
    return many_to_one(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), tract,
                       [("o_custkey", "c_custkey")]).select("o_orderkey", "c_mktsegment", "n_name")


@query("""
SELECT o_custkey, o_orderkey, year::BIGINT AS year
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY year DESC NULLS LAST) AS r
      FROM (SELECT o_custkey, o_orderkey, year(o_orderdate) AS year FROM orders)) WHERE r = 1
""")
def semi_latest_vintage(spark, sf_dir):
    """All rows of each key's latest vintage."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.year("o_orderdate").cast("long").alias("year"))
    return highest_per_key(orders, ["o_custkey"], "year")


@query("""
SELECT o_custkey, o_orderkey, year::BIGINT AS year
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY year) AS r
      FROM (SELECT o_custkey, o_orderkey, year(o_orderdate) AS year FROM orders)) WHERE r = 1
""")
def first_vintage(spark, sf_dir):
    """All rows of each key's earliest vintage."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.year("o_orderdate").cast("long").alias("year"))
    return lowest_per_key(orders, ["o_custkey"], "year")


@query(f"""
WITH {TRACT_SQL}, v AS (SELECT census_geoid, state_fips, county_fips, census_tract, year(o_orderdate)::BIGINT AS year
                        FROM tract JOIN orders ON census_geoid = lpad(CAST(o_custkey AS VARCHAR), 11, '0') GROUP BY ALL)
SELECT census_geoid, state_fips, county_fips, census_tract, max(year) AS census_year FROM v GROUP BY ALL
""")
def tract_dimension_latest(spark, sf_dir):
    """Tract dimensions as of the latest vintage that lists the tract."""
    vintages = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("year")).distinct()
    vintages = vintages.withColumn("census_geoid", F.lpad(F.col("o_custkey").cast("string"), 11, "0"))
    tracts = equi_join(tract_dims_of_customer(spark, sf_dir), vintages, ["census_geoid"], missing_matches=False)
    return geography.census_dims(tracts)


@query("""
SELECT n_nationkey::BIGINT AS n_nationkey, n_name, k::BIGINT AS r_key, r_name
FROM (SELECT n_nationkey, n_name, n_regionkey AS k FROM nation) JOIN (SELECT r_regionkey AS k, r_name FROM region) USING (k)
""")
def natural_join_shared_keys(spark, sf_dir):
    left = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_key")
    right = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "r_key")
    joined = natural_join(left, right)
    return joined.withColumns({c: F.col(c).cast("long") for c in ("n_nationkey", "r_key")})


@query("""
SELECT s_suppkey, s_name, n_name, c.n AS customers
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON s_nationkey = c_nationkey
""")
def renamed_key_join(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    named = equi_join(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation"), [("s_nationkey", "n_nationkey")])
    return equi_join(named, customers, [("s_nationkey", "c_nationkey")]).select("s_suppkey", "s_name", "n_name", "customers")


@query("""
SELECT 'with orders' AS kind, c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
UNION ALL SELECT 'without', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def present_and_absent_keys(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    large = table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 450000)
    on = [("c_custkey", "o_custkey")]
    return stack_rows(
        present_in(customer, large, on).select(F.lit("with orders").alias("kind"), "c_custkey"),
        absent_from(customer, large, on).select(F.lit("without").alias("kind"), "c_custkey"))


# --- county vintages -----------------------------------------------------------------

def _county_vintages(spark, sf_dir):
    """Two vintages of part names: state = brand, county = part.  Some names lost their "Old", some gained a
    "New", and one part type is missing from the newer vintage."""
    part = table(spark, sf_dir, "part").select(
        F.lpad(F.substring_index("p_brand", "#", -1), 2, "0").alias("state"),
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("county"), "p_name", "p_size", "p_type")
    old = part.select(F.col("state").alias("ST"), F.col("county").alias("CO"), F.when(
        F.col("p_size") <= 10, F.concat(F.lit("Old "), "p_name")).otherwise(F.col("p_name")).alias("NAME"))
    new = part.filter(F.col("p_type") != "PROMO").select(
        F.col("state").alias("STATEFP"), F.col("county").alias("COUNTYFP"),
        F.concat("state", "county").alias("GEOID"),
        F.when(F.col("p_size") <= 3, F.concat(F.lit("New "), "p_name")).otherwise(F.col("p_name")).alias("NAME"))
    return geography.county_vintage_1990(old), geography.county_vintage_2018(new)


COUNTY_SQL = """
p AS (SELECT lpad(split_part(p_brand, '#', 2), 2, '0') AS s, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS c, p_name, p_size, p_type FROM part),
v90 AS (SELECT s || c AS county_geoid, s AS state_fips, c AS county_fips, CASE WHEN p_size <= 10 THEN 'Old ' || p_name ELSE p_name END AS county_name FROM p),
v18 AS (SELECT s || c AS county_geoid, s AS state_fips, c AS county_fips, CASE WHEN p_size <= 3 THEN 'New ' || p_name ELSE p_name END AS county_name FROM p WHERE p_type <> 'PROMO'),
changes AS (SELECT DISTINCT a.state_fips, a.county_fips, a.county_name AS county_name_1990, b.county_name AS county_name_2018
            FROM v90 a JOIN v18 b USING (state_fips, county_fips) WHERE a.county_name <> b.county_name),
dims AS (SELECT DISTINCT u.county_geoid, u.state_fips, u.county_fips, coalesce(g.county_name_2018, u.county_name) AS county_name
         FROM (SELECT * FROM v90 UNION SELECT * FROM v18) u
         LEFT JOIN (SELECT DISTINCT state_fips, county_name_1990, county_name_2018 FROM changes) g
           ON u.state_fips = g.state_fips AND u.county_name = g.county_name_1990)"""


@query(f"WITH {COUNTY_SQL} SELECT * FROM changes")
def name_drift(spark, sf_dir):
    """Entities whose name changed between two vintages."""
    return geography.county_name_changes(*_county_vintages(spark, sf_dir))


@query(f"WITH {COUNTY_SQL} SELECT * FROM dims")
def name_drift_fix(spark, sf_dir):
    """Both vintages under corrected names; an old name with two successors fans out on purpose."""
    return geography.county_dims(*_county_vintages(spark, sf_dir))


@query(f"WITH {COUNTY_SQL} SELECT state_fips, county_name, count(*) AS n FROM dims GROUP BY 1, 2 HAVING count(*) > 1")
def names_with_several_codes(spark, sf_dir):
    return geography.county_names_with_several_codes(geography.county_dims(*_county_vintages(spark, sf_dir)))


@query(f"""
WITH {COUNTY_SQL}
SELECT county_geoid, state_fips, county_fips, county_name
FROM (SELECT *, rank() OVER (PARTITION BY state_fips, county_name ORDER BY county_fips DESC) AS r FROM dims) WHERE r = 1
""")
def unique_names_highest_code(spark, sf_dir):
    return geography.county_dims_unique_names(geography.county_dims(*_county_vintages(spark, sf_dir)))


# --- checks --------------------------------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    repeated = repeated_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
    return repeated.withColumn("l_linenumber", F.col("l_linenumber").cast("long"))


@query("""
SELECT 'unique_key' AS "check", subject, n = 0 AS passed, n::DOUBLE AS value FROM (
  SELECT 'orders' AS subject, (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS n
  UNION ALL SELECT 'lineitem', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'events', (SELECT count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1))
  UNION ALL SELECT 'events by user', (SELECT count(*) FROM (SELECT 1 FROM events GROUP BY user_id HAVING count(*) > 1)))
""")
def key_uniqueness(spark, sf_dir):
    return stack_rows(
        unique_key(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
        unique_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
        unique_key(table(spark, sf_dir, "events"), ["event_id"], "events"),
        unique_key(table(spark, sf_dir, "events"), ["user_id"], "events by user"))


@query(f"""
WITH {COUNTY_SQL}, j AS (SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
q AS (
  SELECT 'no_duplicate_rows' AS "check", 'county dims' AS subject, (SELECT count(*) FROM dims) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dims)) AS value, 0 AS goal, '=' AS op
  UNION ALL SELECT 'same_row_count', 'county dims against the 1990 list', (SELECT count(*) FROM dims) - (SELECT count(*) FROM v90), 0, '='
  UNION ALL SELECT 'unique_key', 'order to customer: right key', (SELECT count(*) FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)), 0, '='
  UNION ALL SELECT 'same_row_count', 'order to customer: rows', (SELECT count(*) FROM j) - (SELECT count(*) FROM orders), 0, '='
  UNION ALL SELECT 'surviving_share', 'counties of 2018 in 1990', (SELECT count(*) FROM v18)::DOUBLE / (SELECT count(*) FROM v90), 1, '>='
  UNION ALL SELECT 'key_coverage', 'lineitem parts', (SELECT avg(CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO') THEN 1.0 ELSE 0.0 END) FROM lineitem), 1, '>='
  UNION ALL SELECT 'missing_share', 'segment of the customer', (SELECT avg(CASE WHEN c_mktsegment IS NULL THEN 1.0 ELSE 0.0 END) FROM j), 0, '='
  UNION ALL SELECT 'renamed', 'counties', (SELECT count(*) FROM changes), 0, '=')
SELECT "check", subject, CASE op WHEN '=' THEN value = goal ELSE value >= goal END AS passed, value::DOUBLE AS value FROM q
""")
def quality_report(spark, sf_dir):
    """One table of checks over the county vintages and an order-to-customer join."""
    old, new = _county_vintages(spark, sf_dir)
    dims = geography.county_dims(old, new)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = equi_join(orders, customer, [("o_custkey", "c_custkey")], "left")
    lasting = table(spark, sf_dir, "part").filter(F.col("p_type") != "PROMO")
    return stack_rows(
        no_duplicate_rows(dims, "county dims"),
        same_row_count(dims, old, "county dims against the 1990 list"),
        no_fan_out(joined, orders, customer, ["c_custkey"], "order to customer"),
        surviving_share(equi_join(new, old.select("county_geoid"), ["county_geoid"], "left_semi"), old, "counties of 2018 in 1990"),
        key_coverage(table(spark, sf_dir, "lineitem"), "l_partkey", lasting, "p_partkey", "lineitem parts"),
        missing_share(joined, "c_mktsegment", "segment of the customer"),
        count_of(name_changes(old, new, ["state_fips", "county_fips"], "county_name", "a", "b"), "renamed", "counties"),
    )


@query(f"""
WITH k AS (SELECT {ORDER_KEY_SQL} AS geoid FROM orders),
c AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS g FROM customer),
s AS (SELECT count(*) AS source_rows, count(*) FILTER (geoid IN (SELECT g FROM c)) AS result_rows FROM k)
SELECT result_rows, source_rows, result_rows / source_rows AS ratio FROM s
""")
def surviving_rows(spark, sf_dir):
    """Rows an inner join on the unrepaired key keeps, per row of the source."""
    keys = table(spark, sf_dir, "orders").select(tract_key_of_order().alias("census_geoid"))
    tracts = tract_dims_of_customer(spark, sf_dir).select("census_geoid")
    return row_ratio(equi_join(keys, tracts, ["census_geoid"]), keys)
