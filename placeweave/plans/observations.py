"""Observation tables: each row carries ``dataset_name``, ``observation_id`` and a geography key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions.text import (
    drop_first, drop_first_word, first_match, glue, round_even, squeeze_spaces, text_to_int, trim_all, unite,
)
from placeweave.operators.aggregate import flattened_flags
from placeweave.operators.joins import many_to_one, present_in
from placeweave.operators.keys import conform_to_tract, padded_county_join
from placeweave.operators.reshape import drop_missing
from placeweave.sources.readers import front, lower_names, replace_in_names

# Dataset tags.
COAL_CLOSURES = "clean_energy_tax_credit__coal_closures"
FOSSIL_FUELS = "clean_energy_tax_credit__fossil_fuels"
DESIGNATIONS_48C = "designations_48c_"
CLOSED_COAL = "iwg_closed_coalmines"
RETIRED_PLANTS = "iwg_retired_powerplants_coal_"
FACILITIES = "Clean Investment Monitor"
FACILITIES_BY_TRACT = "Clean Investment Monitor: Manufacturing, industrial, and energy facility metadata"
REPOWERING = "Clean Repowering"
PUBLIC_INVESTMENTS = "Invest.gov"

# Label texts.
MINE_CLOSURE = "Mine closure"
GENERATOR_CLOSURE = "Generator closure"
ADJACENT_TO_CLOSURE = "Adjacent to closure"
FFE_YES = "FFE Yes: County is within a MSA or non-MSA that meets the 0.17 percent threshold for fossil fuel employment (ffe) as of June 7, 2024"
FFE_NO = "FFE No: County is not within a MSA or non-MSA that meets the 0.17 percent threshold for fossil fuel employment (ffe) as of June 7, 2024"
EC_YES = "EC Yes: County is within a MSA or non-MSA that meets both the 0.17 percent threshold for fossil fuel employment, and the unemployment rate requirement as of June 7, 2024."
EC_NO = "EC No: County is not within a MSA or non-MSA that meets both the 0.17 percent threshold for fossil fuel employment, and the unemployment rate requirement as of June 7, 2024."
DESIGNATED_48C = "Census tract is eligible for 48C tax credit as a designated energy community"
NOT_DESIGNATED_48C = "Census tract is eligible for 48C tax credit but NOT as a designated energy community"
UNKNOWN = "DEFAULT_UNKNOWN"


def coal_closures(numbered: DataFrame, joiner: DataFrame) -> DataFrame:
    """Closure flags per tract as one text; rows without a flag or a tract drop out.

    ``numbered`` is the raw table with its ``rowid``, given before anything was filtered.  The row id
    makes every output group a single input row, so the labels are joined in the row itself.
    """
    def label(flag: str, text: str) -> Column:
        return F.when(F.col(flag) == "Yes", F.lit(text))

    located = conform_to_tract(numbered, "geoid_tract_2020", joiner)
    stamped = located.withColumn("dataset_name", F.lit(COAL_CLOSURES)).withColumn(
        "observation_id", glue("dataset_name", F.col("rowid").cast("string"), sep="_"))
    labels = [
        label("Mine_Closure", MINE_CLOSURE),
        label("Generator_Closure", GENERATOR_CLOSURE),
        label("Adjacent_to_Closure", ADJACENT_TO_CLOSURE),
    ]
    return flattened_flags(stamped, labels).select("dataset_name", "observation_id", "census_geoid", "info")


def fossil_fuel_employment(numbered: DataFrame, census_dims: DataFrame) -> DataFrame:
    """County employment and unemployment status as one label, for known counties."""
    def status(column: str, yes: str, no: str) -> Column:
        return first_match([(F.col(column) == "Yes", yes), (F.col(column) == "No", no)])

    counties = numbered.withColumnsRenamed({"fipstate_2020": "state_fips", "fipscounty_2020": "county_fips"})
    known = present_in(counties, census_dims, ["state_fips", "county_fips"])
    return known.select(
        F.lit(FOSSIL_FUELS).alias("dataset_name"),
        glue(F.lit(FOSSIL_FUELS), F.col("rowid").cast("string"), sep="_").alias("observation_id"),
        "state_fips", "county_fips",
        unite(status("ffe_qual_status", FFE_YES, FFE_NO), status("ec_qual_status", EC_YES, EC_NO),
              sep=": ").alias("label"),
    )


def designations_48c(raw: DataFrame, joiner: DataFrame) -> DataFrame:
    """Tract designations; a fractional status is rounded half to even."""
    rounded = round_even("F48C_Statu")
    status = first_match([(rounded == 1, DESIGNATED_48C), (rounded == 0, NOT_DESIGNATED_48C)], UNKNOWN)
    return conform_to_tract(raw, "CTract_GEO", joiner).select(
        F.lit(DESIGNATIONS_48C).alias("dataset_name"),
        glue(F.lit(DESIGNATIONS_48C), "OID_").alias("observation_id"),
        "census_geoid",
        status.alias("f48c_status"),
        F.nullif(F.col("F48C_Tract"), F.lit("N/A")).alias("f48c_tract"),
        F.col("Label").alias("label"),
    )


def closed_coal_mines(raw: DataFrame, census_dims: DataFrame) -> DataFrame:
    stamped = lower_names(raw).select(
        F.lit(CLOSED_COAL).alias("dataset"),
        glue(F.lit(CLOSED_COAL), "oid_", sep="_").alias("observation_id"),
        "mine_id",
        F.col("current_mine_name").alias("mine_name"),
        F.col("current_mine_type").alias("mine_type"),
        text_to_int("year_closed").alias("year_closed"),
        "county_geoid",
        F.col("state").alias("state_name"),
    )
    return front(padded_county_join(stamped, "county_geoid", census_dims), "state_fips", "county_fips")


def retired_coal_plants(raw: DataFrame, census_dims: DataFrame) -> DataFrame:
    stamped = lower_names(raw).select(
        F.lit(RETIRED_PLANTS).alias("dataset"),
        glue(F.lit(RETIRED_PLANTS), "oid_", sep="_").alias("observation_id"),
        "plant_name",
        F.col("nameplate_capacity__mw_").alias("nameplate_capacity_mw"),
        "technology", "operating_year", "retirement_year", "county_geoid",
    )
    return front(padded_county_join(stamped, "county_geoid", census_dims), "state_fips", "county_fips")


FACILITY_COLUMNS = ("segment", "company", "technology", "subcategory", "project_type",
                    "current_facility_status", "status_description")


def facilities(raw: DataFrame) -> DataFrame:
    """Facility investments with coordinates and capital expenditure."""
    return lower_names(raw).select(
        F.lit(FACILITIES).alias("dataset_name"),
        glue(F.lit(FACILITIES), "unique_id", sep="__").alias("observation_id"),
        *FACILITY_COLUMNS,
        F.col("census_tract_2010_id").alias("census_tract"),
        "latitude", "longitude", "address",
        F.col("state").alias("state_name_abbrev"),
        "total_facility_capex_estimated",
    )


def facilities_by_tract(raw: DataFrame) -> DataFrame:
    """Facilities with a tract key; segment and technology in one column, missing written as ``NA``."""
    keyed = lower_names(raw).select(
        F.lit(FACILITIES_BY_TRACT).alias("dataset_name"),
        glue(F.lit(FACILITIES_BY_TRACT), "unique_id", sep="__").alias("observation_id"),
        unite("segment", "technology", sep=": ").alias("segment_technology"),
        "company", "project_type", "status_description",
        F.col("census_tract_2010_geoid").alias("census_geoid"),
    )
    return drop_missing(keyed, ["census_geoid"])


def repowering(numbered: DataFrame) -> DataFrame:
    """Repowering candidates; ``numbered`` is the raw table with its ``rowid``."""
    tidy = replace_in_names(lower_names(numbered))
    return tidy.select(
        F.lit(REPOWERING).alias("dataset_name"),
        glue(F.lit(REPOWERING), F.col("rowid").cast("string"), sep="__").alias("observation_id"),
        F.col("state").alias("state_name_abbrev"),
        "majority_owner",
        F.col("opportunity_by_technology").alias("technology"),
        "latitude", "longitude", "capacity_mw",
    )


# --- public investments -----------------------------------------------------

# Words dropped once each, in this order, and a word dropped only at the end.
NAME_WORDS = ("county", "borough", "census", "area", "municipal", "region")
NAME_ENDING = "parish"

# Curated names by state code; "is" compares the whole cleaned name, "has" looks inside.
COUNTY_RULES = (
    ("01", "is", "chilton,jefferson", "chilton"),
    ("02", "is", "anchorage municipality", "anchorage"),
    ("02", "is", "chugach", "matanuska-susitna"),
    ("02", "is", "copper river", "lake and peninsula"),
    ("02", "is", "valdez cordova", "valdez-cordova"),
    ("06", "has", "los angeles", "los angeles"),
    ("09", "is", "capitol", "hartford"),
    ("09", "is", "naugatuck valley", "litchfield"),
    ("09", "is", "western connecticut", "fairfield"),
    ("12", "has", "broward", "broward"),
    ("13", "is", "athens-clarke", "clarke"),
    ("13", "is", "augusta richmond", "richmond"),
    ("13", "is", "gwinnett board of commissioners", "gwinnett"),
    ("15", "is", "kaua‘i", "kauai"),
    ("22", "is", "st james", "st. james"),
    ("22", "is", "st mary", "st. mary"),
    ("25", "is", "ashby", "middlesex"),
    ("35", "is", "dona ana", "doña ana"),
    ("35", "is", "of dona ana", "doña ana"),
    ("37", "is", "durham government", "durham"),
    ("39", "has", "butler", "butler"),
    ("39", "is", "dayton", "montgomery"),
    ("42", "has", "berks", "berks"),
    ("42", "is", "schuykill", "schuylkill"),
    ("51", "is", "southhampton", "southampton"),
)

# State names as the dimension writes them.
STATE_NAMES = {"U.S. Virgin Islands": "United States Virgin Islands"}

INVESTMENT_COLUMNS = {
    "county_name": "County", "state_name": "State", "agency_name": "Agency Name",
    "bureau_name": "Bureau Name", "program_name": "Program Name", "project_name": "Project Name",
    "category": "Category", "subcategory": "Subcategory", "funding_source": "Funding Source",
    "funding_amount": "Funding Amount",
}


def clean_county_name(name: Column | str) -> Column:
    """Lower-cased name without brackets and kind words, spaces tidied."""
    lowered = F.lower(name)
    stripped = drop_first(lowered, r"\(.*\)")
    stripped = reduce(drop_first_word, NAME_WORDS, stripped)
    stripped = drop_first(stripped, rf"\b{NAME_ENDING}$")
    return squeeze_spaces(trim_all(stripped))


def recode_by_rules(scope: Column, value: Column, rules) -> Column:
    """Replacement of the first rule of the list that holds for the row, else the value.

    The rules are one constant array that is searched, not a branch each: generated code for dozens of
    branches grows beyond what the virtual machine compiles.
    """
    listed = F.array(*[
        F.struct(F.lit(code).alias("scope"), F.lit(kind == "is").alias("whole"), F.lit(text).alias("text"), F.lit(good).alias("good"))
        for code, kind, text, good in rules])

    def holds(rule: Column) -> Column:
        return (rule["scope"] == scope) & F.when(rule["whole"], rule["text"] == value).otherwise(value.contains(rule["text"]))

    return F.coalesce(F.get(F.filter(listed, holds), F.lit(0))["good"], value)


GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct pieces of ``size`` characters; the empty piece is in every text."""
    if size == 0:
        return F.array(F.lit(""))
    pieces = F.transform(F.sequence(F.lit(1), F.length(text) - size + 1), lambda at: F.substr(text, at, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def _inside_rules(names: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules (priority, good) whose text lies inside a name (``__scope``, ``__name``).

    Every rule is posted under one of its pieces, the one that fewest names of its scope hold, and met by the names that hold this
    piece; only these are searched.
    """
    rules = rules.withColumn("__size", F.least(F.length("__text"), F.lit(GRAM)))
    sizes = sorted(r[0] for r in rules.select("__size").distinct().collect())  # at most four rows
    if not sizes:
        return names.join(rules.select("__scope", "priority", "good"), "__scope").limit(0)
    held = names.select("__scope", "__name", F.explode(F.concat(*[_grams(F.col("__name"), n) for n in sizes])).alias("__gram"))
    often = held.groupBy("__scope", "__gram").agg(F.count(F.lit(1)).alias("__names"))
    own = reduce(lambda rest, n: F.when(F.col("__size") == n, _grams(F.col("__text"), n)).otherwise(rest), sizes, F.lit(None))
    posted = (rules.select("__scope", "__text", "priority", "good", F.explode(own).alias("__gram")).join(often, ["__scope", "__gram"])
              .groupBy("__scope", "__text", "priority", "good").agg(F.min(F.struct("__names", "__gram")).alias("__least")))
    posted = posted.select("__scope", F.col("__least.__gram").alias("__gram"), "__text", "priority", "good")
    met = held.join(posted, ["__scope", "__gram"]).filter(F.col("__name").contains(F.col("__text")))
    return met.select("__scope", "__name", "priority", "good")


def recode_by_table(df: DataFrame, scope: str, value: str, rules: DataFrame) -> DataFrame:
    """The same for rules held in a table ``(scope, kind, text, good, priority)`` of any length.

    Scopes and texts of rules are never missing.  Distinct names are looked up, whole-name rules by an equi-join on (scope, text) and texts to
    look inside for by an index of pieces, and what was found goes back to the rows.  The lowest priority wins.
    """
    names = df.select(F.col(scope).alias("__scope"), F.col(value).alias("__name")).filter(
        F.col("__scope").isNotNull() & F.col("__name").isNotNull()).distinct()
    listed = rules.select(F.col("scope").alias("__scope"), "kind", F.col("text").alias("__text"), "priority", "good")
    whole = names.join(listed.filter("kind = 'is'").withColumnRenamed("__text", "__name"), ["__scope", "__name"])
    found = whole.select("__scope", "__name", "priority", "good").unionByName(
        _inside_rules(names, listed.filter("kind = 'has'").drop("kind")).select("__scope", "__name", "priority", "good"))
    best = found.groupBy("__scope", "__name").agg(F.min(F.struct("priority", "good")).alias("__best"))
    joined = df.join(best, F.col(scope).eqNullSafe(F.col("__scope")) & F.col(value).eqNullSafe(F.col("__name")), "left")
    return joined.withColumn(value, F.coalesce("__best.good", F.col(value))).drop("__best", "__scope", "__name")


def public_investments(raw: DataFrame, state_dims: DataFrame, county_unique: DataFrame) -> DataFrame:
    """Public investments with the county their free-text place names mean.

    Both name lookups are many-to-one.  The county table with unique names already carries the county
    key, so neither a further lookup nor a join back by ``observation_id`` is needed.
    """
    tidy = raw.select(
        F.lit(PUBLIC_INVESTMENTS).alias("dataset_name"),
        glue(F.lit(f"{PUBLIC_INVESTMENTS}_"), "`Unique ID`").alias("observation_id"),
        *[F.col(f"`{old}`").alias(new) for new, old in INVESTMENT_COLUMNS.items()],
    ).replace(STATE_NAMES, subset=["state_name"])
    with_state = many_to_one(tidy, state_dims.select("state_name", "state_fips"), ["state_name"])
    cleaned = with_state.withColumn("county_name_lower", clean_county_name("county_name"))
    cleaned = cleaned.withColumn(
        "county_name_lower", recode_by_rules(F.col("state_fips"), F.col("county_name_lower"), COUNTY_RULES))
    by_name = county_unique.select(
        "state_fips", F.lower("county_name").alias("county_name_lower"), "county_fips", "county_geoid")
    located = many_to_one(cleaned, by_name, ["state_fips", "county_name_lower"]).drop("county_name_lower")
    return front(located, "dataset_name", "observation_id", "state_fips", "county_geoid")
