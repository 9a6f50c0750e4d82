import gzip
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placeweave.functions.geometry import polygon
from placeweave.session import scratch_folder
from placeweave.sources import readers, sinks


@pytest.fixture
def folder(spark, tmp_path):
    return Path(tmp_path)


def test_text_table_keeps_zeros_and_quotes(spark, folder):
    (folder / "t.csv").write_text('key,label,year\n01001020100,"a, ""b""",2010\n0400,NA,bad\n,x,\n', encoding="utf-8")
    table = readers.read_text_table(spark, str(folder / "t.csv"), ["key", "label", "year"], {"year": "int"}).collect()
    assert [tuple(r) for r in table] == [("01001020100", 'a, "b"', 2010), ("0400", None, None), (None, "x", None)]


def test_columns_are_found_by_name(spark, folder):
    (folder / "t.csv").write_text("extra,B b,A\n1,2,3\n", encoding="utf-8")
    table = readers.read_text_table(spark, str(folder / "t.csv"), ["a", "B b"], {"a": "int"})
    assert table.columns == ["a", "B b"] and tuple(table.first()) == (3, "2")
    assert readers.read_text_table(spark, str(folder / "t.csv")).columns == ["extra", "B b", "A"]
    (folder / "u.csv").write_text("A,extra,B b\n1,2,3\n", encoding="utf-8")
    with pytest.raises(Exception, match="header does not conform"):
        readers.read_text_table(spark, str(folder)).collect()


def test_other_encodings(spark, folder):
    (folder / "t.csv").write_bytes("name\nDoña Ana\n".encode("latin-1"))
    assert readers.read_text_table(spark, str(folder / "t.csv"), encoding="ISO-8859-1").first()["name"] == "Doña Ana"


def test_quoted_line_breaks(spark, folder):
    (folder / "t.csv").write_text('a,b\n1,"two\nlines"\n', encoding="utf-8")
    path = str(folder / "t.csv")
    assert readers.read_text_table(spark, path, ["a", "b"], multiline=True).first()["b"] == "two\nlines"
    assert readers.unbalanced_quotes(spark, path).first()["lines"] == 2


def test_preamble_is_dropped_from_every_file(spark, folder):
    banner = "Title\n\n,,,\nnote, with comma\n-----\nid,address,capex\n"
    for i in range(3):
        body = "".join(f'{i * 100 + j},"No. {j}, Main St",{j}.5\n' for j in range(i * 40))
        (folder / f"f{i}.csv").write_text(banner + body, encoding="utf-8")
    with gzip.open(folder / "g.csv.gz", "wt") as f:
        f.write(banner + '900,"No. 1, Zip St",NA\n')
    df = readers.read_text_after_preamble(spark, str(folder), ["id", "address", "capex"], skip=5, types={"id": "int", "capex": "double"})
    assert df.count() == 121
    assert df.filter("id = 205").first()["address"] == "No. 5, Main St"
    assert df.filter("id = 900").first()["capex"] is None
    assert df.filter("id is null").count() == 0


def test_preamble_with_split_files(spark, folder):
    (folder / "big.csv").write_text("b1\nb2\nid\n" + "".join(f"{i}\n" for i in range(20000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_text_after_preamble(spark, str(folder), ["id"], skip=2, types={"id": "int"})
        assert df.rdd.getNumPartitions() > 3
        assert df.agg(F.count("id"), F.sum("id"), F.count(F.lit(1))).first() == (20000, 199990000, 20000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("second", ["b1\nb2\nv,id\n1,2\n", "b1\n"])
def test_preamble_files_must_share_their_header(spark, folder, second):
    (folder / "a.csv").write_text("b1\nb2\nid,v\n1,2\n", encoding="utf-8")
    (folder / "b.csv").write_text(second, encoding="utf-8")
    with pytest.raises(PySparkException, match="no header like"):
        readers.read_text_after_preamble(spark, str(folder), skip=2).collect()


def test_preamble_needs_a_header(spark, folder):
    (folder / "a.csv").write_text("b1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no header"):
        readers.read_text_after_preamble(spark, str(folder), skip=2)


def test_preamble_with_small_batches(spark, folder):
    for i in range(4):
        (folder / f"f{i}.csv").write_text("b1\nb2\nb3\nid\n" + "".join(f"{i * 10 + j}\n" for j in range(10)), encoding="utf-8")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = readers.read_text_after_preamble(spark, str(folder), skip=3, types={"id": "int"})
        assert sorted(r["id"] for r in df.collect()) == list(range(40))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_vintages_come_from_the_path(spark):
    root = scratch_folder(spark, "vintages")
    for year in (2013, 2023):
        spark.range(year - 2010).write.parquet(f"{root}/{year}/state_01")
    df = readers.read_vintages(spark, root, r"/(\d{4})/")
    assert {r["year"]: r["count"] for r in df.groupBy("year").count().collect()} == {2013: 3, 2023: 13}


def test_csv_vintages(spark, folder):
    for year in ("1990", "2018"):
        (folder / year).mkdir()
        (folder / year / "counties.csv").write_text("ST,CO\n01,003\n", encoding="utf-8")
        (folder / year / "readme.txt").write_text("not data", encoding="utf-8")
    df = readers.read_vintages(spark, str(folder), r"/(\d{4})/", "*.csv", "csv", readers.string_schema(["ST", "CO"]))
    assert sorted(tuple(r) for r in df.collect()) == [("01", "003", 1990), ("01", "003", 2018)]


def test_sinks_write_missing_as_text(spark, folder):
    path = str(folder / "out")
    sinks.write_text_table(spark.createDataFrame([("01", None), ("02", 'q "x", y')], "k string, v string"), path)
    assert sorted(tuple(r) for r in readers.read_text_table(spark, path, ["k", "v"]).collect()) == [
        ("01", None), ("02", 'q "x", y')]
    assert any("NA" in f.read_text() for f in Path(path).glob("part-*"))


def test_features_and_wkt(spark, folder):
    corners = [(F.lit(0.0), F.lit(0.0)), (F.lit(2.0), F.lit(0.0)), (F.lit(2.0), F.lit(2.5))]
    df = spark.range(2).select(F.col("id").cast("string").alias("state_fips"), polygon(*corners).alias("geometry"))
    sinks.write_features(df, str(folder / "f"), "state_fips")
    back = readers.read_wkt_table(spark, str(folder / "f" / "wkt"), ["state_fips", "geometry_wkt"], "geometry_wkt")
    stored = readers.read_parquet(spark, str(folder / "f" / "shapes"))
    assert back.join(stored, ["state_fips"]).filter(back["geometry"].eqNullSafe(stored["geometry"])).count() == 2
    assert back.first()["srid"] == 4269


def test_geojson_features(spark, folder):
    (folder / "f.json").write_text(
        '{"type":"Feature","properties":{"name":"Doña","n":1},"geometry":{"type":"Point","coordinates":[1,2]}}\n', encoding="utf-8")
    row = readers.read_geojson_features(spark, str(folder / "f.json"), ["name", "n"]).first()
    assert (row["name"], row["n"], row["geometry"]["kind"]) == ("Doña", "1", "POINT")


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Majority Owner` int, `Capacity MW` int, State int")
    tidy = readers.replace_in_names(readers.lower_names(df))
    assert tidy.columns == ["majority_owner", "capacity_mw", "state"]
    assert readers.front(tidy, "state").columns == ["state", "majority_owner", "capacity_mw"]
    assert readers.names_containing(tidy, "o").columns == ["majority_owner"]
    assert readers.select_as(df, owner="Majority Owner", s="State").columns == ["owner", "s"]
    with pytest.raises(ValueError):
        readers.lower_names(spark.createDataFrame([(1, 2)], "a int, b int").toDF("A", "a"))


def test_distinct_dims(spark):
    df = spark.createDataFrame([("b", "2"), ("a", "1"), ("b", "2"), (None, "3")], "state string, code string")
    dims = readers.distinct_dims(df, "tmp_view", {"state": "state_name", "code": "fips"}, ["state_name"])
    assert [tuple(r) for r in dims.collect()] == [("a", "1"), ("b", "2"), (None, "3")]


def _broken_lines(n: int, start: int = 0) -> str:
    """Records of which every third holds breaks, quotes and blank lines inside its quotes."""
    cell = {0: '"one\n\n""two"", three\r\nfour"', 1: "plain", 2: '"a, b"'}
    return "".join(f"{start + i},{cell[i % 3]},{i}.5\n" for i in range(n))


@pytest.mark.parametrize("block", ["700", "100000000"])
def test_quoted_breaks_across_blocks(spark, folder, block):
    (folder / "f10.csv").write_text("id,label,v\n" + _broken_lines(900, 400), encoding="utf-8", newline="")
    (folder / "f9.csv").write_text("id,label,v\n" + _broken_lines(400) + "\n", encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        df = readers.read_text_table(spark, str(folder), ["id", "label", "v"], {"id": "long", "v": "double"}, multiline=True, row_id="rowid", first=0)
        whole = spark.read.csv(str(folder), header=True, multiLine=True, **readers.CSV_OPTIONS)
        assert sorted(map(tuple, df.select("id", "label", "v").collect())) == sorted((int(i), label, float(v)) for i, label, v in whole.collect())
        assert df.filter("rowid <> id").count() == 0 and df.count() == 1300
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quoted_breaks_longer_than_a_block_and_after_a_preamble(spark, folder):
    long_cell = "x\n" * 3000
    (folder / "a.csv").write_text(f'it"s a banner\n\nid,label\n1,"{long_cell}"\n2,b\n', encoding="utf-8")
    (folder / "b.csv").write_text('banner\n,\nid,label\r\n3,"c\r\nd"\r\n', encoding="utf-8", newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = readers.read_text_after_preamble(spark, str(folder), ["id", "label"], skip=2, multiline=True)
        assert {r["id"]: r["label"] for r in df.collect()} == {"1": long_cell, "2": "b", "3": "c\r\nd"}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_open_quotes_and_other_headers_stop_the_read(spark, folder):
    (folder / "a.csv").write_text('id,label\n1,"open\n2,b\n', encoding="utf-8")
    with pytest.raises(PySparkException, match="opened in line 2 is never closed"):
        readers.read_text_table(spark, str(folder), multiline=True).collect()
    (folder / "a.csv").write_text("id,label\n1,a\n", encoding="utf-8")
    (folder / "b.csv").write_text("label,id\na,1\n", encoding="utf-8")
    with pytest.raises(PySparkException, match="no header like"):
        readers.read_text_table(spark, str(folder), multiline=True).collect()


def test_multiline_tables_without_records_names_or_ascii(spark, folder):
    (folder / "t.csv").write_bytes("id,,naïve,ID\n".encode("latin-1"))
    empty = readers.read_text_table(spark, str(folder / "t.csv"), multiline=True, encoding="ISO-8859-1", row_id="n")
    assert empty.columns == ["id0", "_c1", "naïve", "ID3", "n"] and empty.count() == 0
    (folder / "t.csv").write_bytes('id,name\n1,"Doña\nAna"\n'.encode("latin-1"))
    assert readers.read_text_table(spark, str(folder / "t.csv"), multiline=True, encoding="ISO-8859-1").first()["name"] == "Doña\nAna"


def test_row_ids_after_a_preamble(spark, folder):
    (folder / "a.csv").write_text("banner\nid\n" + "".join(f"{i}\n" for i in range(9000)), encoding="utf-8")
    df = readers.read_text_after_preamble(spark, str(folder), ["id"], skip=1, types={"id": "int"}, row_id="rowid", first=0)
    assert df.filter("rowid <> id").count() == 0 and df.count() == 9000
