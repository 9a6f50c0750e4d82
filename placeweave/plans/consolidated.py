"""Observation tables brought together: one table, one point layer, and the summaries drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions.geometry import point
from placeweave.operators.aggregate import box_stats, flow_counts, histogram
from placeweave.operators.joins import equi_join
from placeweave.operators.rank import standard_scores
from placeweave.operators.reshape import drop_missing, stack_rows

# Point layer labels.
CAPACITY_LABEL = "Clean Repowering: Capacity MW"
CAPEX_LABEL = "Clean Investment Monitor: Total Facility Capex (Estimated)"

FACILITY_COLUMNS = ("dataset_name", "state_name", "observation_id", "census_tract", "segment", "company",
                    "technology", "subcategory", "project_type", "status_description",
                    "total_facility_capex_estimated")
REPOWERING_COLUMNS = ("dataset_name", "state_name", "observation_id", "majority_owner", "technology",
                      "capacity_mw")


def consolidated_observations(repowering: DataFrame, facilities: DataFrame, state_dims: DataFrame) -> DataFrame:
    """Complete rows of both datasets under full state names; columns one side lacks are missing."""
    def complete(df: DataFrame, columns) -> DataFrame:
        return drop_missing(equi_join(df, state_dims, ["state_name_abbrev"], "left").select(*columns))

    return stack_rows(complete(repowering, REPOWERING_COLUMNS), complete(facilities, FACILITY_COLUMNS), fill=True)


def point_values(repowering: DataFrame, facilities: DataFrame) -> DataFrame:
    """``label, longitude, latitude, value`` of all rows with coordinates and a value."""
    def layer(df: DataFrame, value: str, label: str) -> DataFrame:
        placed = drop_missing(df.select("longitude", "latitude", F.col(value).alias("value")))
        return placed.withColumn("label", F.lit(label))

    return stack_rows(layer(repowering, "capacity_mw", CAPACITY_LABEL),
                      layer(facilities, "total_facility_capex_estimated", CAPEX_LABEL))


def point_layer(repowering: DataFrame, facilities: DataFrame, srid: int = 4269) -> DataFrame:
    """Points with their value and its standard score within the label."""
    scored = standard_scores(point_values(repowering, facilities), "label", "value", "value_std")
    return scored.select(point("longitude", "latitude").alias("geometry"), F.lit(srid).alias("srid"),
                         "label", "value", "value_std")


def value_histogram(repowering: DataFrame, facilities: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(point_values(repowering, facilities), "label", "value", bins)


def capacity_boxes(repowering: DataFrame) -> DataFrame:
    return box_stats(repowering, "technology", "capacity_mw")


def facility_flows(facilities: DataFrame) -> DataFrame:
    return flow_counts(facilities, ["segment", "project_type", "technology"], lump="technology", keep=5)
