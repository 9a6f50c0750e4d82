"""Plans: what reaches the scan, what is shuffled, and that a hot key stays splittable."""

from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from placeweave.operators import aggregate, joins, keys, rank
from placeweave.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def settings(spark, **values):
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["coverage_pivot"](spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    plan = plan_of(QUERIES["membership_flag_rate"](spark, SF_DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in plan and "LessThanOrEqual(p_size,25)" in plan


@needs_tables
def test_flags_are_flattened_without_a_shuffle_of_their_own(spark):
    df = spark.createDataFrame([(1, "a", None)], "i int, x string, y string")
    assert "Exchange" not in plan_of(aggregate.flattened_flags(df, [F.col("x"), F.col("y")]))


@needs_tables
@pytest.mark.parametrize("name", ["zscore_points", "histogram_bins"])
def test_group_statistics_do_not_shuffle_the_rows(spark, name):
    """Statistics of few groups are broadcast after counting, even where size estimates are switched off."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """A third of the rows on one key and, on that key, one vintage."""
    path = str(tmp_path_factory.mktemp("hot"))
    is_hot = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    spark.range(0, 300_000, numPartitions=8).select(
        F.col("id"),
        F.lpad(F.when(is_hot, F.lit(7)).otherwise(F.col("id") % 5000).cast("string"), 11, "0").alias("geoid"),
        F.when(is_hot, F.lit(2023)).otherwise(2000 + F.col("id") % 20).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    ).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def tract_joiner(spark):
    return keys.geoid_aliases(spark.range(5000).select(F.lpad(F.col("id").cast("string"), 11, "0").alias("census_geoid")))


OPERATORS = {
    "resolve": lambda df, joiner: keys.resolve_geoid(df, "geoid", joiner),
    "conform": lambda df, joiner: keys.conform_to_tract(df, "geoid", joiner),
    "latest": lambda df, joiner: rank.highest_per_key(df, ["geoid"], "year"),
    "many to one": lambda df, joiner: joins.many_to_one(
        df, joiner.filter("length(census_geoid_joiner) = 11").withColumn("n", F.lit(1)).drop("census_geoid_joiner"),
        [("geoid", "census_geoid")]),
    "flag": lambda df, joiner: joins.member_flag(df, "geoid", joiner, "census_geoid", "known"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_hot_key_is_split(spark, hot, tract_joiner, name):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                  spark__sql__shuffle__partitions="16", spark__sql__adaptive__advisoryPartitionSizeInBytes="512KB",
                  spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
                  spark__sql__adaptive__skewJoin__skewedPartitionFactor="3"):
        df = OPERATORS[name](hot, tract_joiner)
        table = df.toArrow()
        plan = plan_of(df)
    assert "skew=true" in plan
    if name != "latest":
        assert table.num_rows == 300_000
