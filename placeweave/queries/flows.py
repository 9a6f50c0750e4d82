"""The dataset builds, run over raw tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators.rank import scan_row_id
from placeweave.plans import consolidated, metrics, observations
from placeweave.queries.registry import (
    JOINER_SQL, ORDER_KEY_SQL, PLACE_SQL, STATE_SQL, customer_joiner, geoid_of, place_of_nation, query,
    raw_state, table, tract_dims_of_customer, tract_key_of_order,
)
from placeweave.plans.geography import state_dims

CUSTOMER_KEY_SQL = """
CASE c_mktsegment WHEN 'AUTOMOBILE' THEN substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 1, 9) || 'XX'
                  WHEN 'BUILDING' THEN '9' || substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 2, 10)
                  WHEN 'MACHINERY' THEN CAST(c_custkey AS VARCHAR)
                  ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '0') END"""


@query(f"""
WITH {JOINER_SQL},
raw AS (SELECT row_number() OVER (ORDER BY c_custkey) AS rowid, {CUSTOMER_KEY_SQL} AS geoid,
               CASE WHEN c_acctbal > 5000 THEN 'Mine closure' END AS m, CASE WHEN c_nationkey < 8 THEN 'Generator closure' END AS g,
               CASE WHEN c_acctbal < 0 OR c_nationkey % 5 = 2 THEN 'Adjacent to closure' END AS a FROM customer),
resolved AS (SELECT *, CASE WHEN geoid IN (SELECT census_geoid FROM joiner) THEN geoid
                            WHEN regexp_matches(geoid, '^[0-9]{{9}}') THEN substr(geoid, 1, 9) END AS k FROM raw),
long AS (SELECT rowid, census_geoid, 1 AS place, m AS label FROM resolved JOIN joiner ON k = census_geoid_joiner
         UNION ALL SELECT rowid, census_geoid, 2, g FROM resolved JOIN joiner ON k = census_geoid_joiner
         UNION ALL SELECT rowid, census_geoid, 3, a FROM resolved JOIN joiner ON k = census_geoid_joiner)
SELECT 'clean_energy_tax_credit__coal_closures' AS dataset_name, 'clean_energy_tax_credit__coal_closures_' || rowid AS observation_id,
       census_geoid, string_agg(label, ': ' ORDER BY place) AS info
FROM long WHERE label IS NOT NULL GROUP BY rowid, census_geoid
""")
def coal_closures_flow(spark, sf_dir):
    """Row ids in file order, keys repaired through the joiner, closure flags flattened."""
    geoid = geoid_of("c_custkey")
    published = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(F.substring(geoid, 1, 9), F.lit("XX")))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("9"), F.substring(geoid, 2, 10)))
        .when(F.col("c_mktsegment") == "MACHINERY", F.col("c_custkey").cast("string"))
        .otherwise(geoid))
    yes_no = lambda c: F.when(c, F.lit("Yes")).otherwise(F.lit("No"))
    raw = scan_row_id(table(spark, sf_dir, "customer")).select(
        "rowid", published.alias("geoid_tract_2020"),
        yes_no(F.col("c_acctbal") > 5000).alias("Mine_Closure"),
        F.when(F.col("c_nationkey") < 8, F.lit("Yes")).alias("Generator_Closure"),
        yes_no((F.col("c_acctbal") < 0) | (F.col("c_nationkey") % 5 == 2)).alias("Adjacent_to_Closure"))
    return observations.coal_closures(raw, customer_joiner(spark, sf_dir))


def _placed_orders(spark, sf_dir, orders):
    """Orders with the county and state of their customer."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        place_of_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))


@query(f"""
WITH {PLACE_SQL},
raw AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS rowid, o_custkey, o_orderstatus, o_orderpriority FROM orders),
r AS (SELECT rowid, state_fips, county_fips, o_orderstatus AS s, o_orderpriority AS p
      FROM raw JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey WHERE o_orderpriority <> '5-LOW')
SELECT 'clean_energy_tax_credit__fossil_fuels' AS dataset_name, 'clean_energy_tax_credit__fossil_fuels_' || rowid AS observation_id,
       state_fips, county_fips,
       CASE s WHEN 'F' THEN 'FFE Yes: County is within a MSA or non-MSA that meets the 0.17 percent threshold for fossil fuel employment (ffe) as of June 7, 2024'
              WHEN 'O' THEN 'FFE No: County is not within a MSA or non-MSA that meets the 0.17 percent threshold for fossil fuel employment (ffe) as of June 7, 2024'
              ELSE 'NA' END || ': ' ||
       CASE p WHEN '1-URGENT' THEN 'EC Yes: County is within a MSA or non-MSA that meets both the 0.17 percent threshold for fossil fuel employment, and the unemployment rate requirement as of June 7, 2024.'
              WHEN '2-HIGH' THEN 'EC No: County is not within a MSA or non-MSA that meets both the 0.17 percent threshold for fossil fuel employment, and the unemployment rate requirement as of June 7, 2024.'
              ELSE 'NA' END AS label
FROM r
""")
def employment_status_flow(spark, sf_dir):
    orders = scan_row_id(table(spark, sf_dir, "orders")).select("rowid", "o_custkey", "o_orderstatus", "o_orderpriority")
    unknown = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("X")).otherwise(F.lit(""))
    raw = _placed_orders(spark, sf_dir, orders).select(
        "rowid", F.col("state_fips").alias("fipstate_2020"), F.concat("county_fips", unknown).alias("fipscounty_2020"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes")).when(F.col("o_orderstatus") == "O", F.lit("No")).alias("ffe_qual_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Yes")).when(F.col("o_orderpriority") == "2-HIGH", F.lit("No")).alias("ec_qual_status"))
    return observations.fossil_fuel_employment(raw, tract_dims_of_customer(spark, sf_dir))


@query(f"""
WITH {JOINER_SQL},
raw AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, {ORDER_KEY_SQL} AS geoid FROM orders),
resolved AS (SELECT *, CASE WHEN geoid IN (SELECT census_geoid FROM joiner) THEN geoid
                            WHEN regexp_matches(geoid, '^[0-9]{{9}}') THEN substr(geoid, 1, 9) END AS k FROM raw)
SELECT 'designations_48c_' AS dataset_name,
       'designations_48c_' || o_orderkey AS observation_id, census_geoid,
       CASE WHEN s = 'O' AND p < '3' THEN 'Census tract is eligible for 48C tax credit as a designated energy community'
            WHEN s = 'O' THEN 'Census tract is eligible for 48C tax credit but NOT as a designated energy community'
            ELSE 'DEFAULT_UNKNOWN' END AS f48c_status,
       nullif(CASE WHEN p = '5-LOW' THEN 'N/A' ELSE p END, 'N/A') AS f48c_tract, p AS label
FROM resolved JOIN joiner ON k = census_geoid_joiner
""")
def designation_flow(spark, sf_dir):
    """Designations whose status comes as 1, 0.5 (rounds to 0), 1.5 (rounds to 2) or not at all."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("OID_"), tract_key_of_order().alias("CTract_GEO"),
        F.when((status == "O") & (priority < "3"), 1.0).when(status == "O", 0.5).when(status == "P", 1.5).alias("F48C_Statu"),
        F.when(priority == "5-LOW", F.lit("N/A")).otherwise(priority).alias("F48C_Tract"), priority.alias("Label"))
    return observations.designations_48c(raw, customer_joiner(spark, sf_dir))


@query(f"""
WITH {PLACE_SQL}
SELECT state_fips, county_fips, 'iwg_closed_coalmines' AS dataset, 'iwg_closed_coalmines_' || s_suppkey AS observation_id,
       'M' || s_suppkey AS mine_id, s_name AS mine_name, CASE WHEN s_acctbal > 5000 THEN 'Surface' ELSE 'Underground' END AS mine_type,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE 1990 + s_nationkey::BIGINT END AS year_closed, state_name
FROM supplier JOIN place ON s_nationkey = n_nationkey WHERE s_nationkey <> 13
""")
def closed_site_flow(spark, sf_dir):
    """County keys without their leading zero; one county with a key too long to match; years in words."""
    lost = F.col("county_geoid").cast("int").cast("string")
    raw = table(spark, sf_dir, "supplier").join(
        place_of_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").cast("string").alias("OID_"), F.concat(F.lit("M"), "s_suppkey").alias("Mine_ID"),
        F.col("s_name").alias("Current_Mine_Name"),
        F.when(F.col("s_acctbal") > 5000, F.lit("Surface")).otherwise(F.lit("Underground")).alias("Current_Mine_Type"),
        F.when(F.col("s_acctbal") < 0, F.lit("before 2005")).otherwise((F.col("s_nationkey") + 1990).cast("string")).alias("Year_Closed"),
        F.when(F.col("s_nationkey") == 13, F.concat("county_geoid", F.lit("9"))).otherwise(lost).alias("County_GEOID"),
        F.col("state_name").alias("State"))
    closed = observations.closed_coal_mines(raw, tract_dims_of_customer(spark, sf_dir))
    return closed.withColumn("year_closed", F.col("year_closed").cast("long"))


@query(f"""
WITH {PLACE_SQL}
SELECT state_fips, county_fips, 'iwg_retired_powerplants_coal_' AS dataset, 'iwg_retired_powerplants_coal__' || o_orderkey AS observation_id,
       'Plant ' || o_custkey AS plant_name, o_totalprice AS nameplate_capacity_mw, o_orderpriority AS technology,
       year(o_orderdate)::BIGINT AS operating_year, year(o_orderdate)::BIGINT + 5 AS retirement_year
FROM orders JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey
""")
def retired_site_flow(spark, sf_dir):
    raw = _placed_orders(spark, sf_dir, table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").cast("string").alias("OID_"), F.concat(F.lit("Plant "), "o_custkey").alias("Plant_Name"),
        F.col("o_totalprice").alias("Nameplate_Capacity__MW_"), F.col("o_orderpriority").alias("Technology"),
        F.year("o_orderdate").cast("long").alias("Operating_Year"), (F.year("o_orderdate").cast("long") + 5).alias("Retirement_Year"),
        F.col("county_geoid").cast("int").cast("string").alias("County_GEOID"))
    return observations.retired_coal_plants(raw, tract_dims_of_customer(spark, sf_dir))


# --- facilities, repowering and what is built from both --------------------------------------

def raw_facilities(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    geoid = geoid_of("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    seat = F.col("o_custkey") % 2500
    return _placed_orders(spark, sf_dir, orders).select(
        F.col("o_orderkey").cast("string").alias("Unique_ID"),
        F.when(status != "P", F.concat(F.lit("Segment "), status)).alias("Segment"),
        F.concat(F.lit("Company "), "o_custkey").alias("Company"), priority.alias("Technology"),
        F.when(priority != "5-LOW", F.substring(priority, 3, 20)).alias("Subcategory"),
        F.when(F.col("o_totalprice") > 250000, F.lit("new")).otherwise(F.lit("expansion")).alias("Project_Type"),
        F.lit("operating").alias("Current_Facility_Status"),
        F.date_format("o_orderdate", "yyyy").alias("Status_Description"),
        F.substring(geoid, 6, 6).alias("census_tract_2010_id"),
        F.when(status != "F", geoid).alias("census_tract_2010_geoid"),
        F.when(priority != "1-URGENT", 25 + seat / F.lit(100.0)).alias("Latitude"),
        F.when(priority != "1-URGENT", -120 + seat / F.lit(50.0)).alias("Longitude"),
        F.concat(F.lit("No. "), "o_custkey", F.lit(", "), "county_name").alias("Address"),
        F.col("state_name_abbrev").alias("State"),
        F.when(status != "P", F.col("o_totalprice")).alias("Total_Facility_Capex_Estimated"))


FACILITY_SQL = PLACE_SQL + """,
facility AS (
SELECT 'Clean Investment Monitor' AS dataset_name, 'Clean Investment Monitor__' || o_orderkey AS observation_id,
       CASE WHEN o_orderstatus <> 'P' THEN 'Segment ' || o_orderstatus END AS segment, 'Company ' || o_custkey AS company,
       o_orderpriority AS technology, CASE WHEN o_orderpriority <> '5-LOW' THEN substr(o_orderpriority, 3, 20) END AS subcategory,
       CASE WHEN o_totalprice > 250000 THEN 'new' ELSE 'expansion' END AS project_type, 'operating' AS current_facility_status,
       CAST(year(o_orderdate) AS VARCHAR) AS status_description, substr(lpad(CAST(o_custkey AS VARCHAR), 11, '0'), 6, 6) AS census_tract,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN 25 + (o_custkey % 2500) / 100::DOUBLE END AS latitude,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN -120 + (o_custkey % 2500) / 50::DOUBLE END AS longitude,
       'No. ' || o_custkey || ', ' || county_name AS address, state_name_abbrev,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total_facility_capex_estimated
FROM orders JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey)"""


@query(f"WITH {FACILITY_SQL} SELECT * FROM facility")
def facility_flow(spark, sf_dir):
    return observations.facilities(raw_facilities(spark, sf_dir))


@query("""
SELECT 'Clean Investment Monitor: Manufacturing, industrial, and energy facility metadata' AS dataset_name,
       'Clean Investment Monitor: Manufacturing, industrial, and energy facility metadata__' || o_orderkey AS observation_id,
       CASE WHEN o_orderstatus <> 'P' THEN 'Segment ' || o_orderstatus ELSE 'NA' END || ': ' || o_orderpriority AS segment_technology,
       'Company ' || o_custkey AS company, CASE WHEN o_totalprice > 250000 THEN 'new' ELSE 'expansion' END AS project_type,
       CAST(year(o_orderdate) AS VARCHAR) AS status_description, lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS census_geoid
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F'
""")
def facility_by_tract_flow(spark, sf_dir):
    return observations.facilities_by_tract(raw_facilities(spark, sf_dir))


def raw_repowering(spark, sf_dir):
    """Lines as repowering candidates with spaced headers, numbered in file order."""
    lines = scan_row_id(table(spark, sf_dir, "lineitem")).select(
        "rowid", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    place = place_of_nation(spark, sf_dir).select("n_nationkey", "state_name_abbrev")
    joined = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        place, F.col("s_nationkey") == F.col("n_nationkey"))
    seat = F.col("l_partkey") % 2000
    return joined.select(
        "rowid", F.col("s_name").alias("Majority Owner"), F.col("state_name_abbrev").alias("State"),
        F.concat("l_returnflag", F.lit("/"), "l_linestatus").alias("Opportunity by Technology"),
        (25 + seat / F.lit(100.0)).alias("Latitude"), (-120 + seat / F.lit(50.0)).alias("Longitude"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("Capacity MW"))


REPOWERING_SQL = """
line AS (SELECT row_number() OVER () AS rowid, * FROM lineitem),
repower AS (
SELECT 'Clean Repowering' AS dataset_name, 'Clean Repowering__' || rowid AS observation_id, state_name_abbrev,
       s_name AS majority_owner, l_returnflag || '/' || l_linestatus AS technology,
       25 + (l_partkey % 2000) / 100::DOUBLE AS latitude, -120 + (l_partkey % 2000) / 50::DOUBLE AS longitude,
       CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS capacity_mw
FROM line JOIN supplier ON l_suppkey = s_suppkey JOIN place ON s_nationkey = n_nationkey)"""


@query(f"WITH {PLACE_SQL}, {REPOWERING_SQL} SELECT * FROM repower")
def capacity_flow(spark, sf_dir):
    return observations.repowering(raw_repowering(spark, sf_dir))


@query(f"""
WITH {FACILITY_SQL}, {REPOWERING_SQL}, {STATE_SQL}
SELECT dataset_name, state_name, observation_id, majority_owner, technology, capacity_mw
FROM repower LEFT JOIN state USING (state_name_abbrev) WHERE capacity_mw IS NOT NULL
UNION ALL BY NAME
SELECT dataset_name, state_name, observation_id, census_tract, segment, company, technology, subcategory, project_type,
       status_description, total_facility_capex_estimated
FROM facility LEFT JOIN state USING (state_name_abbrev)
WHERE segment IS NOT NULL AND subcategory IS NOT NULL AND total_facility_capex_estimated IS NOT NULL
""")
def consolidated_observations(spark, sf_dir):
    return consolidated.consolidated_observations(
        observations.repowering(raw_repowering(spark, sf_dir)), observations.facilities(raw_facilities(spark, sf_dir)),
        state_dims(raw_state(spark, sf_dir)))


@query(f"""
WITH {PLACE_SQL}, {REPOWERING_SQL}, {STATE_SQL}
SELECT state_name, technology, count(*) AS n, sum(capacity_mw * 1.0625)::DECIMAL(20,6)::DOUBLE AS capacity_mw
FROM repower LEFT JOIN state USING (state_name_abbrev) WHERE capacity_mw IS NOT NULL GROUP BY 1, 2
""")
def dataset_filter(spark, sf_dir):
    """One dataset out of the consolidated table, summed by state and technology."""
    chosen = metrics.of_dataset(consolidated_observations(spark, sf_dir), observations.REPOWERING)
    return chosen.groupBy("state_name", "technology").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("capacity_mw") * 1.0625).cast("decimal(20,6)").cast("double").alias("capacity_mw"))


@query(f"""
WITH {FACILITY_SQL}, {REPOWERING_SQL},
v AS (SELECT longitude, latitude, capacity_mw AS value, 'Clean Repowering: Capacity MW' AS label FROM repower
      WHERE longitude IS NOT NULL AND latitude IS NOT NULL AND capacity_mw IS NOT NULL
      UNION ALL SELECT longitude, latitude, total_facility_capex_estimated, 'Clean Investment Monitor: Total Facility Capex (Estimated)' FROM facility
      WHERE longitude IS NOT NULL AND latitude IS NOT NULL AND total_facility_capex_estimated IS NOT NULL),
s AS (SELECT label, avg(value) AS m, stddev_samp(value) AS d FROM v GROUP BY 1)
SELECT label, longitude, latitude, value, CAST(CAST((value - m) / d AS DECIMAL(18,6)) AS DOUBLE) AS value_std, 4269 AS srid
FROM v JOIN s USING (label)
""")
def point_layer(spark, sf_dir):
    layer = consolidated.point_layer(
        observations.repowering(raw_repowering(spark, sf_dir)), observations.facilities(raw_facilities(spark, sf_dir)))
    at = F.col("geometry.parts")[0][0][0]
    return layer.select("label", at["x"].alias("longitude"), at["y"].alias("latitude"), "value",
                        F.col("value_std").cast("decimal(18,6)").cast("double").alias("value_std"), "srid")


@query(f"""
WITH {FACILITY_SQL}
SELECT segment, project_type, technology, count(*) AS n FROM facility GROUP BY 1, 2, 3
""")
def facility_flow_counts(spark, sf_dir):
    """Five technologies: none is lumped."""
    return consolidated.facility_flows(observations.facilities(raw_facilities(spark, sf_dir)))


@query(f"""
WITH {PLACE_SQL}, {REPOWERING_SQL},
q AS (SELECT technology AS t, count(capacity_mw) AS n, quantile_cont(capacity_mw, 0.25) AS q1, quantile_cont(capacity_mw, 0.5) AS median,
             quantile_cont(capacity_mw, 0.75) AS q3 FROM repower WHERE capacity_mw IS NOT NULL GROUP BY 1)
SELECT technology, n, q1, median, q3,
       min(capacity_mw) FILTER (capacity_mw BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(capacity_mw) FILTER (capacity_mw BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (capacity_mw NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM q JOIN repower ON technology = t GROUP BY ALL
""")
def capacity_box_stats(spark, sf_dir):
    return consolidated.capacity_boxes(observations.repowering(raw_repowering(spark, sf_dir)))


# --- public investments --------------------------------------------------------------------------

# Two nations carry names that the curated rules lead to.
RENAMED_COUNTIES = {"NATION_0": "Chilton", "NATION_6": "Matanuska-Susitna"}


@query(r"""
WITH """ + PLACE_SQL.replace("n_name AS county_name", """
        CASE n_name WHEN 'NATION_0' THEN 'Chilton' WHEN 'NATION_6' THEN 'Matanuska-Susitna' ELSE n_name END AS county_name""") + r""",
raw AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'U.S. Virgin Islands' ELSE state_name END AS state,
               CASE WHEN n_nationkey = 0 THEN 'Chilton,Jefferson County' WHEN n_nationkey = 6 THEN 'Chugach Census Area'
                    WHEN o_orderpriority = '1-URGENT' THEN county_name || ' County (part)'
                    WHEN o_orderpriority = '2-HIGH' THEN chr(9) || 'county  ' || county_name || '  borough'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'Parish of ' || county_name
                    WHEN o_orderpriority = '5-LOW' THEN county_name || ' Parish' ELSE county_name END AS county,
               o_custkey, o_orderpriority, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN place ON c_nationkey = n_nationkey),
t AS (SELECT *, CASE WHEN state = 'U.S. Virgin Islands' THEN 'United States Virgin Islands' ELSE state END AS state_name FROM raw),
f AS (SELECT t.*, s.state_fips FROM t LEFT JOIN (SELECT DISTINCT state_name, state_fips FROM place) s USING (state_name)),
w AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(lower(county), '\(.*\)', ''), '\bcounty\b', ''), '\bborough\b', ''), '\bcensus\b', ''), '\barea\b', ''),
        '\bmunicipal\b', ''), '\bregion\b', ''), '\bparish$', '') AS x FROM f),
c AS (SELECT *, regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '\s{2,}', ' ', 'g') AS y FROM w),
z AS (SELECT *, CASE WHEN state_fips = '01' AND y = 'chilton,jefferson' THEN 'chilton'
                     WHEN state_fips = '02' AND y = 'chugach' THEN 'matanuska-susitna' ELSE y END AS name_lower FROM c)
SELECT 'Invest.gov' AS dataset_name, 'Invest.gov_' || o_orderkey AS observation_id, z.state_fips, p.county_geoid, z.county AS county_name,
       z.state_name, 'Agency ' || substr(o_orderpriority, 1, 1) AS agency_name, 'Bureau' AS bureau_name, o_orderpriority AS program_name,
       'Project ' || o_orderkey AS project_name, 'category' AS category, 'subcategory' AS subcategory, 'fund' AS funding_source,
       CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS funding_amount, p.county_fips
FROM z LEFT JOIN place p ON z.state_fips = p.state_fips AND z.name_lower = lower(p.county_name)
""")
def conformed_investment_flow(spark, sf_dir):
    """Free-text places cleaned, recoded and matched to counties through guarded joins."""
    place = place_of_nation(spark, sf_dir).replace(RENAMED_COUNTIES, subset=["county_name"])
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        place, F.col("c_nationkey") == F.col("n_nationkey"))
    name, priority = F.col("county_name"), F.col("o_orderpriority")
    county = (
        F.when(F.col("n_nationkey") == 0, F.lit("Chilton,Jefferson County"))
        .when(F.col("n_nationkey") == 6, F.lit("Chugach Census Area"))
        .when(priority == "1-URGENT", F.concat(name, F.lit(" County (part)")))
        .when(priority == "2-HIGH", F.concat(F.lit("\tcounty  "), name, F.lit("  borough")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("Parish of "), name))
        .when(priority == "5-LOW", F.concat(name, F.lit(" Parish")))
        .otherwise(name))
    state = F.when((F.col("o_orderstatus") == "P") & (priority == "5-LOW"), F.lit("U.S. Virgin Islands")).otherwise(F.col("state_name"))
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("Unique ID"), county.alias("County"), state.alias("State"),
        F.concat(F.lit("Agency "), F.substring(priority, 1, 1)).alias("Agency Name"), F.lit("Bureau").alias("Bureau Name"),
        priority.alias("Program Name"), F.concat(F.lit("Project "), "o_orderkey").alias("Project Name"),
        F.lit("category").alias("Category"), F.lit("subcategory").alias("Subcategory"), F.lit("fund").alias("Funding Source"),
        F.floor("o_totalprice").cast("long").cast("string").alias("Funding Amount"))
    dims = place.select("county_geoid", "state_fips", "county_fips", "county_name")
    return observations.public_investments(raw, state_dims(raw_state(spark, sf_dir)), dims)
