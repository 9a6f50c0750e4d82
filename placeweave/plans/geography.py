"""Conformed geography: states, counties and census tracts from several vintages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions.text import glue, number_in_text
from placeweave.operators.aggregate import repeated_keys, row_counts, share
from placeweave.operators.joins import apply_name_changes, equi_join, name_changes
from placeweave.operators.keys import geoid_aliases
from placeweave.operators.rank import highest_per_key
from placeweave.operators.reshape import long_to_flags, map_columns, stack_rows
from placeweave.sources.readers import distinct_dims, select_as


# --- states -----------------------------------------------------------------

def state_dims(raw_state: DataFrame) -> DataFrame:
    return select_as(raw_state, state_fips="STATEFP", state_name_abbrev="STUSPS", state_name="NAME")


def state_shapes(raw_state: DataFrame) -> DataFrame:
    return select_as(raw_state, state_fips="STATEFP", geometry="geometry")


# --- counties ---------------------------------------------------------------

COUNTY_COLUMNS = ("county_geoid", "state_fips", "county_fips", "county_name", "year")


def county_vintage_2018(raw_county: DataFrame) -> DataFrame:
    named = raw_county.withColumnsRenamed(
        {"STATEFP": "state_fips", "COUNTYFP": "county_fips", "GEOID": "county_geoid", "NAME": "county_name"})
    return _county_columns(named, 2018)


def county_vintage_1990(raw_county: DataFrame) -> DataFrame:
    named = raw_county.withColumnsRenamed({"ST": "state_fips", "CO": "county_fips", "NAME": "county_name"})
    return _county_columns(named.withColumn("county_geoid", glue("state_fips", "county_fips")), 1990)


def _county_columns(df: DataFrame, year: int) -> DataFrame:
    shape = ["geometry"] if "geometry" in df.columns else []
    return df.withColumn("year", F.lit(year)).select(*COUNTY_COLUMNS, *shape)


def county_name_changes(county_1990: DataFrame, county_2018: DataFrame) -> DataFrame:
    """Counties whose name differs between the vintages."""
    return name_changes(county_1990, county_2018, ["state_fips", "county_fips"], "county_name",
                        "county_name_1990", "county_name_2018")


def county_dims(county_1990: DataFrame, county_2018: DataFrame) -> DataFrame:
    """Both vintages under the newer names; one name may still own several codes."""
    changes = county_name_changes(county_1990, county_2018)
    columns = ["county_geoid", "state_fips", "county_fips", "county_name"]
    both = stack_rows(county_1990.select(*columns), county_2018.select(*columns)).distinct()
    renamed = apply_name_changes(
        both, changes, ["state_fips"], "county_name", "county_name_1990", "county_name_2018")
    return renamed.select(*columns).distinct()


def county_names_with_several_codes(dims: DataFrame) -> DataFrame:
    return repeated_keys(dims, "state_fips", "county_name")


def county_dims_unique_names(dims: DataFrame) -> DataFrame:
    """One code per state and name: the highest, so that a join by name cannot fan out."""
    return highest_per_key(dims, ["state_fips", "county_name"], "county_fips")


def county_shapes(county_1990: DataFrame, county_2018: DataFrame) -> DataFrame:
    """Every polygon of each county's latest vintage."""
    columns = ["county_geoid", "year", "geometry"]
    both = stack_rows(county_1990.select(*columns), county_2018.select(*columns))
    return highest_per_key(both, ["county_geoid"], "year").select("county_geoid", "geometry")


# --- tracts -----------------------------------------------------------------

TRACT_COLUMNS = {
    "STATEFP": "state_fips", "COUNTYFP": "county_fips", "TRACTCE": "census_tract",
    "GEOID": "census_geoid", "INTPTLON": "longitude", "INTPTLAT": "latitude",
}


def tract_vintage(raw_tract: DataFrame) -> DataFrame:
    """Conformed columns of tract files already tagged with their ``year``."""
    shape = ["geometry"] if "geometry" in raw_tract.columns else []
    named = raw_tract.withColumnsRenamed(TRACT_COLUMNS).select("year", *TRACT_COLUMNS.values(), *shape)
    return map_columns(named, ["longitude", "latitude"], number_in_text)


def census_coverage(tracts: DataFrame, first: int = 2013, second: int = 2023) -> DataFrame:
    """Tracts in both vintages or in one only, with shares rounded to two digits."""
    flags = long_to_flags(tracts.select("census_geoid", "year"), "census_geoid", "year", [first, second])
    a, b = F.col(f"`{first}`"), F.col(f"`{second}`")
    coverage = (
        F.when(a & b, F.lit("Both")).when(a, F.lit(str(first))).when(b, F.lit(str(second)))
        .when(~a & ~b, F.lit("Neither")).otherwise(F.lit("DEFAULT_UNKNOWN")))
    return share(row_counts(flags.select(coverage.alias("coverage")), "coverage"), digits=2)


def census_shapes(tracts: DataFrame) -> DataFrame:
    """The most recent shape of every tract."""
    latest = highest_per_key(tracts.select("census_geoid", "year", "geometry"), ["census_geoid"], "year")
    return latest.select("census_geoid", "geometry")


def census_coordinates(tracts: DataFrame) -> DataFrame:
    columns = ["census_geoid", "longitude", "latitude"]
    latest = highest_per_key(tracts.select("year", *columns), ["census_geoid"], "year")
    return latest.select(*columns)


def census_dims(tracts: DataFrame) -> DataFrame:
    columns = ["census_geoid", "state_fips", "county_fips", "census_tract", "year"]
    latest = highest_per_key(tracts.select(*columns), ["census_geoid"], "year")
    return latest.withColumnRenamed("year", "census_year")


def census_joiner(dims: DataFrame) -> DataFrame:
    """Full keys and nine-digit prefixes, each with the tract it stands for."""
    return geoid_aliases(dims)


def tract_dims_2023(raw_tract: DataFrame) -> DataFrame:
    return select_as(raw_tract, state_fips="STATEFP", county_fips="COUNTYFP",
                     census_geoid="GEOID", census_geoidfq="GEOIDFQ")


def warehouse_tract_dims(tracts: DataFrame) -> DataFrame:
    """Distinct tract dimensions of a warehouse table, ordered."""
    return distinct_dims(
        tracts, "warehouse_tracts",
        {"state_name": "state_name", "state_fips_code": "state_fips", "county_fips_code": "county_fips",
         "tract_ce": "census_tract", "geo_id": "census_geoid"},
        ["state_fips", "county_fips", "census_geoid"])


def contiguous_state_shapes(shapes: DataFrame, dims: DataFrame,
                            excluded: tuple[str, ...] = ("Alaska", "Puerto Rico", "Hawaii")) -> DataFrame:
    """Map base: named state shapes without the excluded states; unnamed states drop out."""
    named = equi_join(shapes, dims, ["state_fips"], "left")
    for name in excluded:
        named = named.filter(F.col("state_name") != name)
    return named.select("state_name", "geometry")
