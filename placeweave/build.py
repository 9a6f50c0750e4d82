"""From raw files to clean tables, dataset by dataset.

    python -m placeweave.build RAW_FOLDER CLEAN_FOLDER

``RAW_FOLDER`` holds one file or folder per input, named as in ``RAW_COLUMNS``; columns are found by header name,
and further ones are ignored.  Boundary inputs carry their shape as WKT text in the column ``wkt``.  ``tract/2013``
and ``tract/2023`` may be nested at will.  Every step reads earlier results back from ``CLEAN_FOLDER``, so a step can
be run again on its own.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions.geometry import from_wkt
from placeweave.operators.aggregate import repeated_keys
from placeweave.operators.joins import equi_join
from placeweave.operators.keys import geoid_coverage
from placeweave.operators.quality import no_duplicate_rows, require, same_row_count, unique_key, unmatched
from placeweave.operators.reshape import stack_rows
from placeweave.plans import consolidated, crosswalks, geography, metrics, observations
from placeweave.session import SCALE_SETTINGS, scratch_released
from placeweave.sources import readers, sinks

SHAPE = "wkt"

# Columns used of the raw inputs.
RAW_COLUMNS = {
    "state": ["STATEFP", "STUSPS", "NAME", SHAPE],
    "county_1990": ["ST", "CO", "NAME", SHAPE],
    "county_2018": ["STATEFP", "COUNTYFP", "GEOID", "NAME", SHAPE],
    "tract": ["STATEFP", "COUNTYFP", "TRACTCE", "GEOID", "GEOIDFQ", "INTPTLON", "INTPTLAT", SHAPE],
    "cbsa": ["CBSAFP", "GEOID", "GEOIDFQ", "NAME", "LSAD", SHAPE],
    "csa": ["CSAFP", "GEOID", "GEOIDFQ", "NAME", SHAPE],
    "edd": ["FullName", "State", "County", SHAPE],
    "coal_closures": ["geoid_tract_2020", "Mine_Closure", "Generator_Closure", "Adjacent_to_Closure"],
    "fossil_fuel_emp": ["fipstate_2020", "fipscounty_2020", "ffe_qual_status", "ec_qual_status"],
    "designations_48c": ["OID_", "CTract_GEO", "F48C_Statu", "F48C_Tract", "Label", "date_last_"],
    "closed_coal": ["OID_", "Mine_ID", "Current_Mine_Name", "Current_Mine_Type", "Year_Closed", "County_GEOID", "State", "State code"],
    "retired_plants": ["OID_", "Plant_Name", "Technology", "County_GEOID", "Nameplate_Capacity__MW_", "Operating_Year", "Retirement_Year"],
    "facilities": ["unique_id", "segment", "company", "technology", "subcategory", "project_type", "current_facility_status",
                   "status_description", "census_tract_2010_id", "census_tract_2010_geoid", "address", "state", "latitude",
                   "longitude", "total_facility_capex_estimated"],
    "repowering": ["Majority Owner", "State", "Opportunity by Technology", "Latitude", "Longitude", "Capacity MW"],
    "public_investments": ["Unique ID", "County", "State", "Agency Name", "Bureau Name", "Program Name", "Project Name",
                           "Category", "Subcategory", "Funding Source", "Funding Amount"],
}
RAW_TYPES = {
    "designations_48c": {"F48C_Statu": "double", "date_last_": "date"},
    "retired_plants": {"Nameplate_Capacity__MW_": "double", "Operating_Year": "int", "Retirement_Year": "int"},
    "facilities": {"latitude": "double", "longitude": "double", "total_facility_capex_estimated": "double"},
    "repowering": {"Latitude": "double", "Longitude": "double", "Capacity MW": "double"},
}
FACILITY_PREAMBLE = 5
DYAD_METRES = 100_000.0
TRACT_VINTAGES = (2013, 2023)


class Workspace:
    """Reads raw inputs and earlier results, writes new ones."""

    def __init__(self, spark: SparkSession, raw: str, clean: str):
        self.spark, self.raw_root, self.clean_root = spark, raw.rstrip("/"), clean.rstrip("/")

    def raw(self, name: str, row_id: str | None = None, first: int = 1) -> DataFrame:
        table = readers.read_text_table(
            self.spark, f"{self.raw_root}/{name}", RAW_COLUMNS[name], RAW_TYPES.get(name), multiline=True, row_id=row_id, first=first)
        return table.withColumn("geometry", from_wkt(SHAPE)).drop(SHAPE) if SHAPE in table.columns else table

    def facilities(self) -> DataFrame:
        return readers.read_text_after_preamble(
            self.spark, f"{self.raw_root}/facilities", RAW_COLUMNS["facilities"], FACILITY_PREAMBLE, RAW_TYPES["facilities"], multiline=True)

    def tracts(self) -> DataFrame:
        """Both vintages with their year; only the later one has fully qualified keys."""
        vintages = []
        for year in TRACT_VINTAGES:
            tagged = readers.read_vintages(
                self.spark, f"{self.raw_root}/tract/{year}", r"/tract/(\d{4})/", "*.csv", "csv")
            known = {c.lower() for c in tagged.columns}
            vintages.append(tagged.select("year", *[c for c in RAW_COLUMNS["tract"] if c.lower() in known]))
        return stack_rows(*vintages, fill=True).withColumn("geometry", from_wkt(SHAPE)).drop(SHAPE)

    def clean(self, name: str) -> DataFrame:
        return readers.read_parquet(self.spark, f"{self.clean_root}/{name}")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        sinks.write_parquet(df, f"{self.clean_root}/{name}")
        return self.clean(name)

    def write_sorted(self, df: DataFrame, name: str, *order: str) -> DataFrame:
        """Parquet for later steps and text for people, both in key order."""
        stored = self.write(sinks.sorted_for_sink(df, *order), name)
        sinks.write_text_table(sinks.sorted_for_sink(stored, *order), f"{self.clean_root}/{name}_text")
        return stored

    def write_shapes(self, df: DataFrame, name: str, key: str) -> DataFrame:
        stored = self.write(df, name)
        sinks.write_text_table(sinks.wkt_table(stored, key), f"{self.clean_root}/{name}_for_upload")
        return stored


def build_geography(ws: Workspace) -> None:
    raw_state = ws.raw("state")
    states = ws.write_sorted(geography.state_dims(raw_state), "state_dims", "state_fips")
    ws.write_shapes(geography.state_shapes(raw_state), "state_shapes", "state_fips")
    require(unique_key(states, ["state_fips"], "state_dims")).collect()

    old = geography.county_vintage_1990(ws.raw("county_1990"))
    new = geography.county_vintage_2018(ws.raw("county_2018"))
    counties = ws.write_sorted(geography.county_dims(old, new), "county_dims", "county_geoid")
    ws.write_sorted(geography.county_dims_unique_names(counties), "county_dims_unique_county_names", "county_geoid")
    ws.write_shapes(geography.county_shapes(old, new), "county_shapes", "county_geoid")

    raw_tracts = ws.tracts()
    # Parsed once: three results need the shapes or points of both vintages.
    tracts = ws.write(geography.tract_vintage(raw_tracts), "tract_vintages")
    dims = ws.write_sorted(geography.census_dims(tracts), "census_dims", "census_geoid")
    shapes = ws.write_shapes(geography.census_shapes(tracts), "census_shapes", "census_geoid")
    ws.write_sorted(geography.census_coordinates(tracts), "census_coordinates", "census_geoid")
    ws.write(geography.census_coverage(tracts), "census_coverage")
    ws.write(geography.census_joiner(dims), "census_joiner")
    latest = raw_tracts.filter(F.col("year") == 2023)
    ws.write_sorted(geography.tract_dims_2023(latest), "tract_dims_2023", "census_geoid")
    ws.write(latest.select("GEOID", "GEOIDFQ", "geometry"), "tract_shapes_2023")
    require(stack_rows(unique_key(dims, ["census_geoid"], "census_dims"), same_row_count(shapes, dims, "census_shapes"))).collect()


def build_crosswalks(ws: Workspace) -> None:
    tracts = ws.clean("tract_shapes_2023")
    regions = {
        "cbsa_to_tract": (crosswalks.cbsa_to_tract, ws.raw("cbsa")),
        "csa_to_tract": (crosswalks.csa_to_tract, ws.raw("csa")),
        "edd_to_census_tract": (crosswalks.edd_to_census_tract, ws.raw("edd", "edd_index", first=0)),
    }
    for name, (crosswalk, source) in regions.items():
        require(no_duplicate_rows(ws.write(crosswalk(source, tracts), name), name)).collect()
    cbsa = crosswalks.cbsa_regions(ws.raw("cbsa")).drop("geometry")
    ws.write(unmatched(cbsa, ws.clean("cbsa_to_tract"), "cbsa_geoid"), "cbsa_without_tract")


def build_observations(ws: Workspace) -> None:
    joiner, dims = ws.clean("census_joiner"), ws.clean("census_dims")
    closures = ws.raw("coal_closures", "rowid")
    ws.write(geoid_coverage(closures, "geoid_tract_2020", joiner), "coal_closures_coverage")
    ws.write(observations.coal_closures(closures, joiner), "coal_closures")
    ws.write(observations.fossil_fuel_employment(ws.raw("fossil_fuel_emp", "rowid"), dims), "fossil_fuel_employment")
    ws.write(observations.designations_48c(ws.raw("designations_48c"), joiner), "designations_48c")
    ws.write(observations.closed_coal_mines(ws.raw("closed_coal"), dims), "iwg_closed_coal")
    ws.write(observations.retired_coal_plants(ws.raw("retired_plants"), dims), "iwg_retired_powerplants_coal")
    facilities = ws.facilities()
    ws.write(observations.facilities(facilities), "facilities")
    ws.write(observations.facilities_by_tract(facilities), "facilities_by_tract")
    ws.write(observations.repowering(ws.raw("repowering", "rowid")), "repowering")
    ws.write(repeated_keys(ws.raw("public_investments"), "Unique ID"), "public_investments_repeated_ids")
    ws.write(observations.public_investments(
        ws.raw("public_investments"), ws.clean("state_dims"), ws.clean("county_dims_unique_county_names")), "public_investments")


def build_consolidated(ws: Workspace) -> None:
    repowering, facilities, states = ws.clean("repowering"), ws.clean("facilities"), ws.clean("state_dims")
    ws.write(consolidated.consolidated_observations(repowering, facilities, states), "observations")
    ws.write(consolidated.point_layer(repowering, facilities), "observation_points")
    ws.write(consolidated.value_histogram(repowering, facilities), "value_histogram")
    ws.write(consolidated.facility_flows(facilities), "facility_flows")
    ws.write(consolidated.capacity_boxes(repowering), "capacity_boxes")
    ws.write(geography.contiguous_state_shapes(ws.clean("state_shapes"), states), "map_base")


def build_metrics(ws: Workspace) -> None:
    """Dollars and capacity per district, county and state, ranked.

    Facilities carry a tract key; repowering candidates only coordinates, so the tract that holds them is
    looked up first (the lower of two that share a border).
    """
    dims = ws.clean("census_dims").withColumn("county_geoid", F.concat("state_fips", "county_fips"))
    levels = metrics.region_levels(dims, "census_geoid", {"state": "state_fips", "county": "county_geoid"})
    districts = ws.clean("edd_to_census_tract").select(
        "census_geoid", F.lit("edd").alias("level"), F.col("edd_full_name").alias("region"))
    dollars = ws.facilities().select(
        F.col("census_tract_2010_geoid").alias("census_geoid"), F.col("total_facility_capex_estimated").alias("dollars"))
    repowering = ws.clean("repowering")
    tracts = crosswalks.points_to_regions(
        repowering, "observation_id", "longitude", "latitude",
        ws.clean("tract_shapes_2023").withColumnRenamed("GEOID", "census_geoid"), "census_geoid")
    tracts = tracts.groupBy("observation_id").agg(F.min("census_geoid").alias("census_geoid"))
    capacity = equi_join(repowering.select("observation_id", "capacity_mw"), tracts, ["observation_id"]).drop("observation_id")
    areas = ws.clean("cbsa_to_tract").select(
        "census_geoid", F.lit("cbsa").alias("level"), F.col("cbsa_name").alias("region"))
    placed, values = stack_rows(dollars, capacity, fill=True), ["dollars", "capacity_mw"]
    crosswalk = levels.unionByName(districts).unionByName(areas)
    ws.write(metrics.unplaced_totals(placed, "census_geoid", values, crosswalk), "observations_without_region")
    rollup = metrics.label_overlaps(metrics.metric_rollup(placed, "census_geoid", values, crosswalk), crosswalk)
    ranked = ws.write(metrics.region_rank(rollup, {"dollars": 0.5, "capacity_mw": 0.5}), "region_ranks")
    flagged = metrics.competitive_regions(ranked.select("level", "region", "dollars", "capacity_mw"), ["dollars", "capacity_mw"])
    ws.write(metrics.ratio_by_region(flagged, "capacity_mw", "dollars", "mw_per_dollar"), "competitive_regions")


def build_dyads(ws: Workspace) -> None:
    """Facilities and repowering candidates near each other."""
    def places(df: DataFrame, kind: str, lon: str, lat: str, value: str) -> DataFrame:
        placed = df.select(F.coalesce(F.col(kind), F.lit("NA")).alias("kind"), F.col(lon).alias("lon"), F.col(lat).alias("lat"), F.col(value).alias("value"))
        return placed.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    facilities = places(ws.facilities(), "segment", "longitude", "latitude", "total_facility_capex_estimated")
    candidates = places(ws.clean("repowering"), "technology", "longitude", "latitude", "capacity_mw")
    dyads = ws.write(metrics.dyads(facilities, candidates, DYAD_METRES, value="value"), "dyads")
    ws.write(metrics.dyad_summary(dyads), "dyad_summary")


STEPS = (build_geography, build_crosswalks, build_observations, build_consolidated, build_metrics, build_dyads)


def build_all(spark: SparkSession, raw: str, clean: str) -> Workspace:
    """Every step, in the order in which they need each other."""
    workspace = Workspace(spark, raw, clean)
    for step in STEPS:
        with scratch_released(spark):
            step(workspace)
    return workspace


if __name__ == "__main__":
    builder = SparkSession.builder.appName("placeweave").config(map=SCALE_SETTINGS)
    if len(sys.argv) > 3:  # a folder that all executors reach
        builder = builder.config("spark.checkpoint.dir", sys.argv[3])
    build_all(builder.getOrCreate(), *sys.argv[1:3])
