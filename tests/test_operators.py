import random
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from placeweave.operators import aggregate, joins, keys, quality, rank, reshape
from placeweave.session import counted_side, scratch_folder


# --- joins ------------------------------------------------------------------------

def test_missing_keys_match_missing_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    assert rows(joins.equi_join(left, right, ["k"], "left")) == rows(
        spark.createDataFrame([(None, 2, 20), ("a", 1, 10), ("b", 3, None)], "k string, x int, y int"))
    assert joins.equi_join(left, right, ["k"], missing_matches=False).count() == 1


def test_join_on_differently_named_keys_keeps_the_left_name(spark):
    left = spark.createDataFrame([("1", "x")], "county_geoid string, v string")
    right = spark.createDataFrame([("1", "y")], "County_ID string, w string")
    assert joins.equi_join(left, right, [("county_geoid", "County_ID")]).columns == ["county_geoid", "v", "w"]


def test_hot_keys_are_cut_and_nothing_is_lost(spark, rows):
    left = spark.createDataFrame([("hot", i) for i in range(200)] + [(f"k{i % 9}", 1000 + i) for i in range(90)] + [(None, 5)], "k string, i int")
    right = spark.createDataFrame([("hot", j) for j in range(7)] + [(f"k{j}", j) for j in range(5)] + [(None, 1)], "k string, j int")
    plain = joins.equi_join(left, right, ["k"], missing_matches=False)
    for chunks, least in ((1000, 10_000), (10, 1), (3, 20)):
        assert rows(joins.hot_key_join(left, right, ["k"], ["i"], chunks, least), "k", "i", "j") == rows(plain, "k", "i", "j")


def test_natural_join_uses_shared_names(spark, rows):
    left = spark.createDataFrame([(1, 2, "x"), (1, 3, "y")], "a int, b int, v string")
    right = spark.createDataFrame([(1, 2, "z")], "a int, b int, w string")
    assert rows(joins.natural_join(left, right), "v", "w") == [("x", "z")]
    with pytest.raises(ValueError):
        joins.natural_join(left.select("a"), right.select("b"))


def test_self_join_of_one_lineage(spark):
    df = spark.createDataFrame([(1, 5), (1, 7), (2, 3)], "k int, v int")
    assert joins.equi_join(df, df.groupBy("k").agg(F.max("v").alias("m")), ["k"]).count() == 3


def test_many_to_one_raises_only_for_matched_keys(spark, rows):
    left = spark.createDataFrame([("a",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    assert rows(joins.many_to_one(left, right, ["k"])) == [("a", 1), ("c", None)]
    with pytest.raises(PySparkException, match="many-to-one"):
        joins.many_to_one(left.union(spark.createDataFrame([("b",)], "k string")), right, ["k"]).collect()


@pytest.mark.parametrize("use", [lambda df: df.count(), lambda df: df.select("i").collect(), lambda df: df.agg({"i": "max"}).collect()])
@pytest.mark.parametrize("payload", [True, False])
def test_many_to_one_raises_whatever_is_read(spark, use, payload):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "k string, i int")
    right = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    with pytest.raises(PySparkException, match="many-to-one"):
        use(joins.many_to_one(left, right if payload else right.select("k"), ["k"]))


def test_membership_is_never_missing(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    with_null = spark.createDataFrame([("a",), (None,), ("a",)], "v string")
    assert rows(joins.member_flag(df, "k", with_null, "v", "hit")) == [(None, True), ("a", True), ("b", False)]
    without = with_null.na.drop()
    assert rows(joins.member_flag(df, "k", without, "v", "hit")) == [(None, False), ("a", True), ("b", False)]


def test_semi_and_anti_do_not_fan_out(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert joins.present_in(left, right, ["k"]).count() == 2
    assert joins.absent_from(left, right, ["k"]).count() == 1


def test_name_changes_fan_out_on_purpose(spark, rows):
    old = spark.createDataFrame([("01", "1", "Old"), ("01", "2", "Old"), ("01", "3", "Same"), ("02", "1", "Old")],
                                "s string, c string, name string")
    new = spark.createDataFrame([("01", "1", "New A"), ("01", "2", "New B"), ("01", "3", "Same"), ("02", "1", "Old")],
                                "s string, c string, name string")
    changes = joins.name_changes(old, new, ["s", "c"], "name", "was", "now")
    assert rows(changes, "s", "c", "was", "now") == [("01", "1", "Old", "New A"), ("01", "2", "Old", "New B")]
    fixed = joins.apply_name_changes(old, changes, ["s"], "name", "was", "now")
    assert rows(fixed.filter("s = '01' and c = '1'"), "name") == [("New A",), ("New B",)]
    assert rows(fixed.filter("s = '02'"), "name") == [("Old",)]


# --- keys --------------------------------------------------------------------------

@pytest.fixture
def joiner(spark):
    dims = spark.createDataFrame([("26163031100",), ("26163031102",), ("01001020100",)], "census_geoid string")
    return keys.geoid_aliases(dims)


def test_alias_names_the_lowest_key(joiner):
    by_alias = {r["census_geoid_joiner"]: r["census_geoid"] for r in joiner.collect()}
    assert by_alias["261630311"] == "26163031100" and by_alias["26163031102"] == "26163031102"
    assert joiner.count() == 5


def test_resolution(spark, joiner):
    df = spark.createDataFrame([("26163031102",), ("26163031199",), ("99999999999",), ("2616",), (None,)], "k string")
    resolved = {r["k"]: r["census_geoid_joiner"] for r in keys.resolve_geoid(df, "k", joiner).collect()}
    assert resolved == {"26163031102": "26163031102", "26163031199": "261630311", "99999999999": "NO_MATCH",
                        "2616": "NO_MATCH", None: "NO_MATCH"}


def test_resolution_is_idempotent(spark, joiner):
    df = spark.createDataFrame([("26163031102",), ("26163031199",)], "k string")
    once = keys.resolve_geoid(df, "k", joiner, out="once")
    twice = keys.resolve_geoid(once.drop("k"), "once", joiner, out="twice")
    assert twice.filter("once <> twice").count() == 0


def test_conforming_equals_resolving_then_joining(spark, joiner, rows):
    df = spark.createDataFrame([(1, "26163031102"), (2, "26163031199"), (3, "99999999999"), (4, None), (5, "261630311")],
                               "i int, k string")
    direct = keys.conform_to_tract(df, "k", joiner)
    stepwise = joins.equi_join(keys.resolve_geoid(df, "k", joiner), joiner, ["census_geoid_joiner"])
    assert rows(direct, "i", "census_geoid") == rows(stepwise, "i", "census_geoid") == [
        (1, "26163031102"), (2, "26163031100"), (5, "26163031100")]


def test_keys_of_any_length(spark):
    """Fifteen digits leave six open behind a prefix: no row of the lookup grows with them."""
    dims = spark.range(30_000).select(F.concat(F.lit("261630311"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("census_geoid"))
    joiner = keys.geoid_aliases(dims)
    df = spark.createDataFrame([("261630311029999",), ("261630311999999",), ("261630312000000",), ("261630311",), (None,)], "k string")
    got = {r["k"]: r["out"] for r in keys.resolve_geoid(df, "k", joiner, out="out").collect()}
    assert got == {"261630311029999": "261630311029999", "261630311999999": "261630311", "261630312000000": "NO_MATCH",
                   "261630311": "261630311", None: "NO_MATCH"}
    tracts = {r["k"]: r["t"] for r in keys.conform_to_tract(df, "k", joiner, out="t").collect()}
    assert tracts == {"261630311029999": "261630311029999", "261630311999999": "261630311000000", "261630311": "261630311000000"}


def test_resolving_keeps_columns_of_the_frame(spark, joiner):
    df = spark.createDataFrame([("26163031102", "x")], "census_geoid string, census_geoid_joiner string")
    assert keys.resolve_geoid(df, "census_geoid", joiner, out="out").columns == ["census_geoid", "census_geoid_joiner", "out"]


def test_coverage(spark, joiner):
    df = spark.createDataFrame([("26163031102",)] * 3 + [("26163031199",), (None,)], "k string")
    report = {r["match_kind"]: r for r in keys.geoid_coverage(df, "k", joiner).collect()}
    assert (report["as_is"]["matched"], report["as_is"]["total"], report["as_is"]["rate"]) == (3, 5, 0.6)
    assert report["abbreviated"]["matched"] == 4
    assert report["as_is"]["message"] == "3 of 5 census_geoids match as-is: 60%"
    assert report["abbreviated"]["message"] == "4 of 5 census_geoids match if abbreviated to 9 digits: 80%"


# --- reshape ---------------------------------------------------------------------------

def test_rows_are_bound_by_name(spark, rows):
    a = spark.createDataFrame([("1", "2")], "x string, y string")
    b = spark.createDataFrame([("4", "3")], "y string, x string")
    assert rows(reshape.stack_rows(a, b), "x", "y") == [("1", "2"), ("3", "4")]
    assert rows(reshape.stack_rows(a, b.drop("y"), fill=True), "x", "y") == [("1", "2"), ("3", None)]


def test_long_to_flags_and_duplicate_cells(spark, rows):
    df = spark.createDataFrame([("a", 2013), ("a", 2023), ("b", 2023)], "k string, year int")
    assert rows(reshape.long_to_flags(df, "k", "year", [2013, 2023])) == [("a", True, True), ("b", False, True)]
    with pytest.raises(PySparkException, match="duplicate cell"):
        reshape.long_to_flags(df.union(df), "k", "year", [2013, 2023]).collect()


def test_unpivot_then_pivot_is_identity(spark, rows):
    df = spark.createDataFrame([("a", "1", None), ("b", "2", "3")], "k string, x string, y string")
    long = reshape.wide_to_long(df, ["k"])
    assert long.count() == 4
    assert rows(long.groupBy("k").pivot("variable", ["x", "y"]).agg(F.first("value")), "k", "x", "y") == rows(df)


def test_missing_values(spark, rows):
    df = spark.createDataFrame([(1.0, "a", True), (float("nan"), "b", None), (None, "c", False), (2.0, None, True)],
                               "v double, s string, b boolean")
    assert reshape.drop_missing(df).count() == 1
    assert reshape.drop_missing(df, ["v"]).count() == 2
    assert reshape.fill_booleans(df).filter("b is null").count() == 0
    assert rows(reshape.recode(df.select("s"), "s", {"a": "A"})) == [(None,), ("A",), ("b",), ("c",)]


# --- rank ----------------------------------------------------------------------------------

def test_extremes_keep_ties(spark, rows):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 2, "r"), ("b", None, "s"), (None, 5, "t")],
                               "k string, v int, w string")
    assert rows(rank.highest_per_key(df, ["k"], "v"), "w") == [("q",), ("r",), ("s",), ("t",)]
    assert rows(rank.lowest_per_key(df, ["k"], "v"), "w") == [("p",), ("s",), ("t",)]


def test_standard_scores(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("one", 9.0), ("flat", 4.0), ("flat", 4.0)], "g string, v double")
    scores = {(r["g"], r["v"]): r["z"] for r in rank.standard_scores(df, "g", "v", "z").collect()}
    assert scores[("a", 1.0)] == -1.0 and scores[("a", 3.0)] == 1.0
    assert scores[("one", 9.0)] is None and scores[("flat", 4.0)] is None


def levels(spark, counts):
    return spark.createDataFrame([(name,) for name, n in counts.items() for _ in range(n)], "x string")


@pytest.mark.parametrize("counts, expected", [
    ({"a": 6, "b": 5, "c": 4, "d": 3, "e": 2, "f": 1}, {"a", "b", "c", "d", "e", "f"}),
    ({"a": 7, "b": 6, "c": 5, "d": 4, "e": 3, "f": 2, "g": 1}, {"a", "b", "c", "d", "e", "Other"}),
    ({"a": 7, "b": 6, "c": 5, "d": 4, "e": 2, "f": 2, "g": 1, "h": 1}, {"a", "b", "c", "d", "e", "f", "Other"}),
    ({"a": 2, "b": 1}, {"a", "b"}),
])
def test_lumping(spark, counts, expected):
    df = levels(spark, counts).union(spark.createDataFrame([(None,)], "x string"))
    lumped = rank.lump_levels(df, "x", 5)
    assert lumped.count() == sum(counts.values()) + 1
    assert {r["x"] for r in lumped.collect()} == expected | {None}


def test_frequency_order(spark, rows):
    df = rank.frequency_order(levels(spark, {"a": 1, "b": 3, "c": 1, "d": 2}), "x")
    assert [r["x"] for r in df.orderBy("position").collect()] == ["b", "d", "a", "c"]
    assert [r["position"] for r in df.orderBy("position").collect()] == [1, 2, 3, 4]


def test_ordered_ids_are_dense_over_many_files(spark):
    rng = random.Random(3)
    values = list(range(500))
    rng.shuffle(values)
    df = spark.createDataFrame([(v, f"t{v:04d}") for v in values], "v int, t string").repartition(7)
    numbered = rank.ordered_row_id(df, [F.col("t").desc()], "i", first=0)
    assert {(r["v"], r["i"]) for r in numbered.collect()} == {(v, 499 - v) for v in range(500)}


def test_scan_ids_follow_file_order(spark):
    path = scratch_folder(spark, "scan")
    spark.range(0, 1000, numPartitions=5).write.parquet(path)
    numbered = rank.scan_row_id(spark.read.parquet(path))
    assert numbered.filter("rowid <> id + 1").count() == 0 and numbered.count() == 1000
    assert numbered.filter("id >= 990").agg(F.min("rowid")).first()[0] == 991  # given before any filter


def test_scan_ids_follow_numbers_in_file_names(spark, tmp_path):
    for i, name in enumerate(["part-99998", "part-99999", "part-100000", "part-100001"]):
        written = str(tmp_path / "one")
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.mode("overwrite").parquet(written)
        file = next(p for p in (tmp_path / "one").iterdir() if p.suffix == ".parquet")
        (tmp_path / "all").mkdir(exist_ok=True)
        file.rename(tmp_path / "all" / f"{name}.parquet")
    numbered = rank.scan_row_id(spark.read.parquet(str(tmp_path / "all")))
    assert numbered.filter("rowid <> id + 1").count() == 0 and numbered.count() == 40


def test_scratch_needs_a_shared_folder_off_a_local_master(spark, monkeypatch):
    from placeweave import session

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Cluster:
        sparkContext = Context
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_folder(Cluster, "x")
    Context.master = "local[2]"
    assert session.scratch_folder(Cluster, "x")


def test_scratch_is_released(spark, tmp_path):
    from pathlib import Path

    from placeweave import session
    with session.scratch_released(spark):
        path = scratch_folder(spark, "gone")
        spark.range(3).write.parquet(path)
        assert Path(path.removeprefix("file:")).exists()
    assert not Path(path.removeprefix("file:")).exists()


def test_sample_is_repeatable(spark, rows):
    df = spark.range(100)
    first = rows(rank.seeded_sample(df, 10, ["id"], "s"))
    assert len(first) == 10 and first == rows(rank.seeded_sample(df.repartition(5), 10, ["id"], "s"))
    assert first != rows(rank.seeded_sample(df, 10, ["id"], "t"))


# --- aggregates --------------------------------------------------------------------------------

def test_counts_and_shares(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(aggregate.row_counts(df, "k")) == [(None, 1), ("a", 2), ("b", 1)]
    assert rows(aggregate.repeated_keys(df, "k")) == [("a", 2)]
    assert rows(aggregate.share(aggregate.row_counts(df, "k"), digits=1), "k", "prop") == [(None, 0.2), ("a", 0.5), ("b", 0.2)]
    assert rows(aggregate.counts_of_counts(df, "k")) == [(1, 1, 0.5), (2, 1, 0.5)]
    assert rows(aggregate.missing_rates(df)) == [("k", 0.25)]


def test_flag_rates(spark, rows):
    df = spark.createDataFrame([("l", True), ("l", False), ("l", True), ("r", False)], "variable string, hit boolean")
    assert rows(aggregate.flag_rates(df, "hit", "variable")) == [("l", 2 / 3, 2, 1), ("r", 0.0, 0, 1)]


def test_row_ratio(spark):
    assert tuple(aggregate.row_ratio(spark.range(3), spark.range(4)).first()) == (3, 4, 0.75)


def test_flattening_long_and_wide_agree(spark, rows):
    wide = spark.createDataFrame([(1, "Mine", None, "Adjacent"), (2, None, None, None), (3, None, "Generator", None)],
                                 "i int, a string, b string, c string")
    by_row = aggregate.flattened_flags(wide, [F.col("a"), F.col("b"), F.col("c")]).select("i", "info")
    long = reshape.wide_to_long(wide, ["i"]).withColumn("place", F.col("variable"))
    by_key = aggregate.flattened_text(long, ["i"], "value", "place")
    assert rows(by_row) == rows(by_key) == [(1, "Mine: Adjacent"), (3, "Generator")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_flattening_a_key_that_spans_ranges(spark, partitions):
    hot = [("hot", i % 400, f"v{i % 800}") for i in range(1600)]
    df = spark.createDataFrame([*hot, ("b", 2, "y"), ("b", 1, "x"), ("b", 1, None), (None, None, "z"), (None, 1, "w")], "k string, o int, v string")
    got = {r["k"]: r["info"] for r in aggregate.flattened_text(df, ["k"], "v", "o", partitions=partitions).collect()}
    assert got == {"hot": ": ".join(v for _, _, v in sorted(set(hot))), "b": "x: y", None: "z: w"}


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", float("nan")), (None, None, 2.0)], "n int, s string, d double")
    for exact in (False, True):
        table = {r["variable"]: r for r in aggregate.profile(df.select("n", "s"), exact).collect()}
        assert (table["n"]["n_rows"], table["n"]["n_missing"], table["n"]["n_distinct"], table["n"]["mean"]) == (3, 1, 2, 1.5)
        assert (table["s"]["n_distinct"], table["s"]["lowest"], table["s"]["mean"], table["s"]["median"]) == (1, "a", None, None)
        assert table["n"]["median"] == (1.5 if exact else 1.0) and table["n"]["q3"] == (1.75 if exact else 2.0)
    assert aggregate.profile(df.select("s"), True).first()["n_distinct"] == 1
    rates = {r["variable"]: r["missing_rate"] for r in aggregate.missing_rates(df).collect()}
    assert rates == {"n": 1 / 3, "s": 1 / 3, "d": 1 / 3}


def test_histogram_counts_every_value(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(61)] + [("flat", 5.0)] * 3, "g string, v double")
    bins = aggregate.histogram(df, "g", "v", 30).collect()
    assert sum(r["n"] for r in bins if r["g"] == "a") == 61 and max(r["bin"] for r in bins) == 29
    assert [(r["bin"], r["n"]) for r in bins if r["g"] == "flat"] == [(0, 3)]


def quantile(values, q):
    values = sorted(values)
    place = (len(values) - 1) * q
    low, high = int(place), min(int(place) + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (place - low)


@pytest.mark.parametrize("accuracy", [10_000, 40, 5])
def test_exact_quantiles_with_a_hot_value(spark, accuracy):
    rng = random.Random(11)
    groups = {"hot": [7.0] * 400 + [rng.gauss(0, 50) for _ in range(500)], "one": [3.0],
              "two": [1.0, 2.0], "even": [float(v) for v in range(100)], None: [1.0, 5.0, 9.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("one", None)], "g string, v double").repartition(5)
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    for r in aggregate.exact_quantiles(df, "g", "v", wanted, accuracy).collect():
        assert r["n"] == len(groups[r["g"]])
        for name, q in wanted.items():
            assert r[name] == pytest.approx(quantile(groups[r["g"]], q), abs=1e-12)


def test_box_stats(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in values], "g string, v double")
    r = aggregate.box_stats(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"]) == tuple(quantile(values, q) for q in (0.25, 0.5, 0.75))
    assert r["whisker_high"] == 100.0 and r["outliers"] == 0
    narrow = spark.createDataFrame([("a", v) for v in [1.0, 2.0, 2.0, 2.0, 3.0, 50.0]], "g string, v double")
    r = aggregate.box_stats(narrow, "g", "v").first()
    assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (1.0, 3.0, 1)


@pytest.mark.parametrize("accuracy", [10_000, 50, 4])
def test_box_stats_of_spans_and_gaps(spark, accuracy):
    """A coarse sketch leaves gaps, and a very coarse one is noticed and refined."""
    rng = random.Random(5)
    groups = {g: [round(rng.gauss(0, 10) ** 3, 1) for _ in range(900)] + [5.0] * 300 for g in "ab"} | {"c": [1.0, float("nan")], None: [2.0] * 60}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("a", None)], "g string, v double").repartition(4)
    for r in aggregate.box_stats(df, "g", "v", accuracy).collect():
        values = groups[r["g"]]
        assert r["n"] == len(values)
        if r["g"] == "c":
            continue
        q1, q3 = quantile(values, 0.25), quantile(values, 0.75)
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, quantile(values, 0.5), q3), abs=1e-9)
        within = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (min(within), max(within), len(values) - len(within))


def test_only_a_sliver_of_a_large_group_is_counted_by_value(spark):
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
    condensed = aggregate._condensed(df, "g", "v", [0.25, 0.5, 0.75], 1000, 0.002, False)
    assert condensed.agg(F.sum("n")).first()[0] == 200_000 and condensed.count() < 5_000


def test_value_ranks_over_many_blocks(spark):
    df = spark.createDataFrame([("a", float(v % 17)) for v in range(300)], "g string, v double")
    ranks = {r["v"]: (r["below"], r["n"], r["total"]) for r in aggregate.value_ranks(df, "g", "v", partitions=6).collect()}
    values = sorted(float(v % 17) for v in range(300))
    assert len(ranks) == 17
    assert ranks == {v: (values.index(v), values.count(v), 300) for v in set(values)}
    assert statistics.median(values) == aggregate.exact_quantiles(df, "g", "v", {"m": 0.5}).first()["m"]


def test_value_ranks_of_several_columns(spark):
    rng = random.Random(2)
    data = [(rng.choice(["a", None]), rng.randrange(2), rng.choice([None, 0.0, 1.5, 2.0, 9.0])) for _ in range(400)]
    ranks = aggregate.value_ranks(spark.createDataFrame(data, "g string, h int, v double"), ["g", "h"], "v", partitions=5).collect()
    for g, h in {(g, h) for g, h, _ in data}:
        values = sorted(v for a, b, v in data if (a, b) == (g, h) and v is not None)
        got = {r["v"]: (r["below"], r["n"], r["total"]) for r in ranks if (r["g"], r["h"]) == (g, h)}
        assert got == {v: (values.index(v), values.count(v), len(values)) for v in set(values)}


def test_only_small_sides_are_marked_for_broadcast(spark):
    small, large = counted_side(spark.range(5), rows=5), counted_side(spark.range(6), rows=5)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()


# --- checks ---------------------------------------------------------------------------------------

def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    value = lambda d: (d.first()["passed"], d.first()["value"])
    assert value(quality.unique_key(df, ["k"], "t")) == (False, 1.0)
    assert value(quality.unique_key(df.distinct(), ["k"], "t")) == (True, 0.0)
    assert value(quality.no_duplicate_rows(df, "t")) == (False, 1.0)
    assert value(quality.same_row_count(df, df, "t")) == (True, 0.0)
    assert value(quality.surviving_share(df.limit(1), df, "t")) == (False, 1 / 3)
    assert value(quality.missing_share(df, "v", "t")) == (False, 1 / 3)
    assert value(quality.key_coverage(df, "v", df.filter("v = 'a'"), "v", "t")) == (False, 2 / 3)
    assert [r["passed"] for r in quality.no_fan_out(df, df, df, ["k"], "t").collect()] == [False, True]
    assert quality.unmatched(spark.range(3), spark.range(2), "id").collect()[0]["id"] == 2


def test_require_raises_on_a_failed_check(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    assert quality.require(quality.unique_key(df.distinct(), ["k"], "t")).first()["passed"]
    with pytest.raises(PySparkException, match="unique_key"):
        quality.require(quality.unique_key(df, ["k"], "t")).collect()
