"""The whole chain on small raw files."""

import csv
from pathlib import Path

import pytest

from placeweave.build import RAW_COLUMNS, build_all
from placeweave.operators.rank import text_row_id
from placeweave.sources import readers


def box(x, y, size):
    return f"POLYGON (({x} {y}, {x + size} {y}, {x + size} {y + size}, {x} {y + size}, {x} {y}))"


def write(path: Path, columns, rows, banner=()):
    """Raw files have more columns than are used, in another order and case."""
    path.parent.mkdir(parents=True, exist_ok=True)
    columns = ["unused 1", *[c.upper() if i % 3 == 0 and c != "Unique ID" else c for i, c in enumerate(columns)][::-1], "unused 2"]
    rows = [["x", *row[::-1], "NA"] for row in rows]
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.writelines(f"{line}\n" for line in banner)
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows([["NA" if c is None else c for c in row] for row in rows])


@pytest.fixture(scope="module")
def workspace(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")

    def table(name, rows, file=None, banner=()):
        write(raw / (file or name) / "part.csv" if not file else raw / file, RAW_COLUMNS[name], rows, banner)

    table("state", [("01", "AL", "Alabama", box(-90, 30, 4)), ("02", "AK", "Alaska", box(-160, 60, 9)), ("26", "MI", "Michigan", box(-85, 41, 3))])
    table("county_1990", [("01", "001", "Autaga", box(-90, 30, 1)), ("26", "163", "Wayne", box(-85, 41, 1))])
    table("county_2018", [("01", "001", "01001", "Autauga", box(-90, 30, 1)), ("26", "163", "26163", "Wayne", box(-85, 41, 1))])
    tract = lambda s, c, t, x, y: (s, c, t, s + c + t, f"1400000US{s + c + t}", f"-0{abs(x)}.5", f"+{y}.5", box(x, y, 1))
    old = [c for c in RAW_COLUMNS["tract"] if c != "GEOIDFQ"]
    write(raw / "tract/2013/01/a.csv", old, [
        (t[:4] + t[5:]) for t in (tract("01", "001", "020100", -90, 30), tract("26", "163", "031100", -85, 41))])
    table("tract", [tract("01", "001", "020100", -90, 30), tract("01", "001", "020200", -89, 30)], "tract/2023/01/a.csv")
    table("tract", [tract("26", "163", "031102", -85, 41)], "tract/2023/26/b.csv")
    table("cbsa", [("10", "10", "F10", "A", "M1", box(-90, 30, 0.5)), ("20", "20", "F20", "B", "M2", box(0, 0, 1))])
    table("csa", [("c", "c", "Fc", "C", box(-89.5, 30.2, 0.5))])
    table("edd", [("Delta", "Alabama", "x", box(-89.5, 30.5, 2)), ("Bayou", "Alabama", "x", box(-89.9, 30.1, 0.1))])
    table("coal_closures", [("01001020100", "Yes", None, "Yes"), ("99999999999", "Yes", "No", "No"), ("26163031177", "No", "Yes", "No")])
    table("fossil_fuel_emp", [("01", "001", "Yes", "No"), ("77", "001", "Yes", "No"), ("26", "163", None, "Yes")])
    table("designations_48c", [("1", "01001020100", "0.5", "N/A", "x", "2024-01-31"), ("2", "26163031177", "1", "t", "y", "bad")])
    table("closed_coal", [("7", "m", "Mine", "Surface", "2010", "1001", "AL", "1")])
    table("retired_plants", [("8", "Plant", "steam", "26163", "12.5", "1970", "n/a")])
    facility = lambda i, segment, geoid, lat, capex: (
        i, segment, "Co", "Wind", "sub", "new", "open", "d", "020100", geoid, "1 Main St, Town", "AL", lat, None if lat is None else "-89.5", capex)
    table("facilities", [facility("1", "Mfg", "01001020100", "30.5", "10"), facility("2", None, "01001020200", None, "30"), facility("3", "Mfg", None, "30.6", None)],
          banner=["Export", "", "a,b", "c", "-"])
    table("repowering", [("Own", "AL", "Wind", "30.1", "-89.9", "100"), ("Own", "AL", "Solar", "30.2", "-89.8", None), ("Own", "MI", "Solar", "41", "-85", "300")])
    table("public_investments", [("1", "Autauga County", "Alabama", *"abcdefgh"), ("2", "wayne (part)", "Michigan", *"abcdefgh"), ("3", None, "Nowhere", *"abcdefgh")])
    return build_all(spark, str(raw), str(tmp_path_factory.mktemp("clean")))


def got(workspace, name, *columns):
    df = workspace.clean(name)
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_geography(workspace):
    assert got(workspace, "state_dims", "state_fips") == [("01",), ("02",), ("26",)]
    assert got(workspace, "county_dims", "county_geoid", "county_name") == [("01001", "Autauga"), ("26163", "Wayne")]
    assert got(workspace, "census_dims", "census_geoid", "census_year") == [
        ("01001020100", 2023), ("01001020200", 2023), ("26163031100", 2013), ("26163031102", 2023)]
    assert got(workspace, "census_coverage", "coverage", "n") == [("2013", 1), ("2023", 2), ("Both", 1)]
    assert ("26163031100", -85.5, 41.5) in got(workspace, "census_coordinates")
    assert ("26163031100", "261630311") in got(workspace, "census_joiner", "census_geoid", "census_geoid_joiner")
    assert len(got(workspace, "tract_dims_2023")) == 3


def test_text_copies(spark, workspace):
    dims = readers.read_text_table(spark, f"{workspace.clean_root}/state_dims_text", ["state_fips", "state_name_abbrev", "state_name"])
    assert [r["state_fips"] for r in dims.collect()] == ["01", "02", "26"]
    shapes = readers.read_wkt_table(spark, f"{workspace.clean_root}/county_shapes_for_upload", ["county_geoid", "geometry_wkt"], "geometry_wkt")
    assert {r["geometry"]["kind"] for r in shapes.collect()} == {"POLYGON"}


def test_crosswalks(workspace):
    assert got(workspace, "cbsa_to_tract", "cbsa_name", "cbsa_type", "census_geoid") == [("A", "metro", "01001020100")]
    assert got(workspace, "cbsa_without_tract", "cbsa_name") == [("B",)]
    # a region that ends on the edge of two tracts meets both
    assert got(workspace, "csa_to_tract", "census_geoid") == [("01001020100",), ("01001020200",)]
    assert got(workspace, "edd_to_census_tract", "edd_index", "edd_full_name", "census_geoid") == [
        (0, "Delta", "01001020100"), (0, "Delta", "01001020200"), (1, "Bayou", "01001020100")]


def test_observations(workspace):
    tag = "clean_energy_tax_credit__coal_closures"
    assert got(workspace, "coal_closures", "observation_id", "census_geoid", "info") == [
        (f"{tag}_1", "01001020100", "Mine closure: Adjacent to closure"), (f"{tag}_3", "26163031100", "Generator closure")]
    assert [r[0][-1] for r in got(workspace, "fossil_fuel_employment", "observation_id")] == ["1", "3"]
    assert got(workspace, "coal_closures_coverage", "match_kind", "matched") == [("abbreviated", 2), ("as_is", 1)]
    assert {r[0] for r in got(workspace, "designations_48c", "f48c_tract")} == {None, "t"}
    assert got(workspace, "iwg_closed_coal", "state_fips", "county_fips", "year_closed") == [("01", "001", 2010)]
    assert got(workspace, "iwg_retired_powerplants_coal", "nameplate_capacity_mw", "operating_year", "retirement_year") == [(12.5, 1970, None)]
    assert got(workspace, "facilities_by_tract", "segment_technology") == [("Mfg: Wind",), ("NA: Wind",)]
    assert got(workspace, "public_investments", "observation_id", "county_geoid") == [
        ("Invest.gov_1", "01001"), ("Invest.gov_2", "26163"), ("Invest.gov_3", None)]
    assert got(workspace, "public_investments_repeated_ids") == []


def test_consolidated_and_metrics(workspace):
    assert sorted(r[0] for r in got(workspace, "observations", "observation_id")) == [
        "Clean Investment Monitor__1", "Clean Repowering__1", "Clean Repowering__3"]
    assert len(got(workspace, "observation_points")) == 3
    assert got(workspace, "map_base", "state_name") == [("Alabama",), ("Michigan",)]
    ranks = {(r["level"], r["region"]): (r["dollars"], r["capacity_mw"], r["place"]) for r in workspace.clean("region_ranks").collect()}
    assert ranks == {
        ("county", "01001"): (40.0, 100.0, 1), ("county", "26163"): (0.0, 300.0, 1),
        ("state", "01"): (40.0, 100.0, 1), ("state", "26"): (0.0, 300.0, 1),
        ("edd", "Bayou"): (10.0, 100.0, 2), ("edd", "Delta"): (40.0, 100.0, 1), ("cbsa", "A"): (10.0, 100.0, 1)}
    # Without a cbsa: the facility in the tract next to it, the one without a tract, and the plant in the other state.
    assert {r["level"]: r["observations"] for r in workspace.clean("observations_without_region").collect()}.items() >= {"cbsa": 3}.items()
    # Two facilities have coordinates, and two candidates lie in their reach; one of either has no value.
    assert got(workspace, "dyads", "l_kind", "r_kind", "l_value", "r_value", "quantity") == [
        ("Mfg", "Solar", 10.0, None, 1), ("Mfg", "Solar", None, None, 1), ("Mfg", "Wind", 10.0, 100.0, 1), ("Mfg", "Wind", None, 100.0, 1)]
    flags = {r["region"]: (r["competitive"], r["mw_per_dollar"]) for r in workspace.clean("competitive_regions").collect()}
    assert flags["Delta"] == (True, 2.5) and flags["26163"] == (False, None)


def test_row_ids_of_split_text_files(spark, tmp_path):
    for name, start in (("a", 0), ("b", 3000)):
        (tmp_path / f"{name}.csv").write_text("k,v\n" + "".join(f"{start + i},x\n" for i in range(3000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        numbered = text_row_id(readers.read_text_table(spark, str(tmp_path), ["k", "v"], {"k": "int"}))
        assert numbered.count() == 6000 and numbered.filter("rowid <> k + 1").count() == 0
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
