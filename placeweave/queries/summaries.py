"""Counts, shares, profiles and chart summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.operators import aggregate
from placeweave.operators.joins import equi_join
from placeweave.operators.rank import frequency_order, lump_levels, seeded_sample, standard_scores
from placeweave.operators.reshape import long_to_flags, stack_rows, wide_to_long
from placeweave.plans.geography import census_coverage
from placeweave.queries.registry import query, table


@query("""
WITH f AS (SELECT o_custkey, bool_or(year(o_orderdate) = 1995) AS a, bool_or(year(o_orderdate) = 1996) AS b
           FROM orders WHERE year(o_orderdate) IN (1995, 1996) GROUP BY 1),
c AS (SELECT CASE WHEN a AND b THEN 'Both' WHEN a THEN '1995' ELSE '1996' END AS coverage, count(*) AS n FROM f GROUP BY 1)
SELECT coverage, n, round_even(n / (SELECT sum(n) FROM c), 2) AS prop FROM c
""")
def coverage_pivot(spark, sf_dir):
    """Keys present in both of two vintages or in one only."""
    day = F.col("o_orderdate")
    # A range on the column itself reaches the scan; its year would not.
    two = table(spark, sf_dir, "orders").filter(
        (day >= F.lit("1995-01-01").cast("timestamp_ntz")) & (day < F.lit("1997-01-01").cast("timestamp_ntz")))
    vintages = two.select(F.col("o_custkey").alias("census_geoid"), F.year(day).alias("year")).distinct()
    return census_coverage(vintages, 1995, 1996)


@query("""
SELECT o_custkey, bool_or(o_orderstatus = 'F') AS "F", bool_or(o_orderstatus = 'O') AS "O", bool_or(o_orderstatus = 'P') AS "P"
FROM orders GROUP BY 1
""")
def flags_per_level(spark, sf_dir):
    """Long to wide: one flag per status."""
    pairs = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus").distinct()
    return long_to_flags(pairs, "o_custkey", "o_orderstatus", ["F", "O", "P"])


@query("""
SELECT s_suppkey, 'nation' AS variable, CAST(s_nationkey AS VARCHAR) AS value FROM supplier
UNION ALL SELECT s_suppkey, 'name', s_name FROM supplier
UNION ALL SELECT s_suppkey, 'debtor', CASE WHEN s_acctbal < 0 THEN 'yes' END FROM supplier
""")
def wide_to_long_rows(spark, sf_dir):
    wide = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("string").alias("nation"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") < 0, F.lit("yes")).alias("debtor"))
    return wide_to_long(wide, ["s_suppkey"])


@query("""
WITH c AS (SELECT occurrences, count(*) AS n FROM (SELECT count(*) AS occurrences FROM orders GROUP BY o_custkey) GROUP BY 1)
SELECT occurrences, n, n / (SELECT sum(n) FROM c) AS prop FROM c
""")
def frequency_of_frequencies(spark, sf_dir):
    return aggregate.counts_of_counts(table(spark, sf_dir, "orders"), "o_custkey")


@query("""
WITH j AS (SELECT c_custkey, n, t FROM customer LEFT JOIN
             (SELECT o_custkey, count(*) AS n, CASE WHEN count(*) > 3 THEN 'busy' END AS t FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey)
SELECT 'c_custkey' AS variable, avg(CASE WHEN c_custkey IS NULL THEN 1::DOUBLE ELSE 0 END) AS missing_rate FROM j
UNION ALL SELECT 'finished', avg(CASE WHEN n IS NULL THEN 1::DOUBLE ELSE 0 END) FROM j
UNION ALL SELECT 'pace', avg(CASE WHEN t IS NULL THEN 1::DOUBLE ELSE 0 END) FROM j
""")
def null_rate_by_column(spark, sf_dir):
    finished = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("finished")).withColumn("pace", F.when(F.col("finished") > 3, F.lit("busy")))
    joined = equi_join(table(spark, sf_dir, "customer").select("c_custkey"), finished, [("c_custkey", "o_custkey")], "left")
    return aggregate.missing_rates(joined)


@query("""
SELECT l_orderkey, string_agg(label, ': ' ORDER BY place) AS info
FROM (SELECT DISTINCT l_orderkey, l_linenumber AS place, l_returnflag || l_linestatus || l_linenumber AS label
      FROM (SELECT l_orderkey, l_linenumber, min(nullif(l_returnflag, 'N')) AS l_returnflag, min(l_linestatus) AS l_linestatus
            FROM lineitem GROUP BY 1, 2))
WHERE label IS NOT NULL GROUP BY 1
""")
def ordered_text_by_key(spark, sf_dir):
    """Labels of each key flattened in their order; lines without a flag have no label, which is skipped."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.nullif("l_returnflag", F.lit("N"))).alias("f"), F.min("l_linestatus").alias("s"))
    labels = lines.select("l_orderkey", "l_linenumber", F.concat("f", "s", F.col("l_linenumber").cast("string")).alias("label"))
    return aggregate.flattened_text(labels, ["l_orderkey"], "label", "l_linenumber")


@query("""
SELECT CASE WHEN p_size > 25 THEN true ELSE false END AS is_large, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS prop
FROM part GROUP BY 1
""")
def flag_table(spark, sf_dir):
    """Counts and shares of a boolean."""
    flagged = table(spark, sf_dir, "part").select((F.col("p_size") > 25).alias("is_large"))
    return aggregate.share(aggregate.row_counts(flagged, "is_large"))


@query("""
SELECT count(*) AS n, sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END)::BIGINT AS num_matches,
       sum(CASE WHEN p_size > 25 THEN 0 ELSE 1 END)::BIGINT AS num_bad, avg(CASE WHEN p_size > 25 THEN 1::DOUBLE ELSE 0 END) AS prop FROM part
""")
def overall_rate(spark, sf_dir):
    """Grand total and overall rate of a boolean."""
    flagged = table(spark, sf_dir, "part").select((F.col("p_size") > 25).alias("is_large"))
    return aggregate.flag_rates(flagged, "is_large").withColumn("n", F.col("num_matches") + F.col("num_bad"))


def _profile_sql(column: str, number: bool, expression: str | None = None) -> str:
    e = expression or column
    moments = (f"avg({e}), stddev_samp({e}), quantile_cont({e}::DOUBLE, 0.25), quantile_cont({e}::DOUBLE, 0.5), quantile_cont({e}::DOUBLE, 0.75)"
               if number else "NULL, NULL, NULL, NULL, NULL")
    return (f"SELECT '{column}', count(*), count(*) - count({e}), count(DISTINCT {e}), CAST(min({e}) AS VARCHAR), "
            f"CAST(max({e}) AS VARCHAR), {moments} FROM part")


_PROFILED = " UNION ALL ".join([
    _profile_sql("p_partkey", True), _profile_sql("p_name", False), _profile_sql("p_brand", False), _profile_sql("p_type", False),
    _profile_sql("p_size", True), _profile_sql("p_retailprice", True),
    _profile_sql("p_class", False, "CASE WHEN p_size > 40 THEN 'large' END")])
_PROFILE_NUMBERS = ("mean", "deviation", "q1", "median", "q3")


@query(f"""
WITH c(variable, n_rows, n_missing, n_distinct, lowest, highest, mean, deviation, q1, median, q3) AS ({_PROFILED})
SELECT variable, n_rows, n_missing, n_distinct, lowest, highest,
       {', '.join(f'CAST(CAST({c} AS DECIMAL(18,6)) AS DOUBLE) AS {c}' for c in _PROFILE_NUMBERS)} FROM c
""")
def profile_table(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("p_class", F.when(F.col("p_size") > 40, F.lit("large")))
    profiled = aggregate.profile(part, exact=True)
    return profiled.withColumns({c: F.col(c).cast("decimal(18,6)").cast("double") for c in _PROFILE_NUMBERS})


# --- levels ------------------------------------------------------------------------------

@query("""
SELECT p_name AS level, n, row_number() OVER (ORDER BY n DESC, p_name) AS position FROM (SELECT p_name, count(*) AS n FROM part GROUP BY 1)
""")
def levels_by_frequency(spark, sf_dir):
    return frequency_order(table(spark, sf_dir, "part"), "p_name").withColumnRenamed("p_name", "level")


@query("""
WITH b AS (SELECT p_brand, rank() OVER (ORDER BY count(*) DESC) AS r FROM part GROUP BY 1),
t AS (SELECT p_type, rank() OVER (ORDER BY count(*) DESC) AS r FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN b.r <= 5 OR (SELECT count(*) FROM b WHERE r > 5) <= 1 THEN p_brand ELSE 'Other' END AS brand,
       CASE WHEN t.r <= 5 OR (SELECT count(*) FROM t WHERE r > 5) <= 1 THEN p_type ELSE 'Other' END AS type
FROM part JOIN b USING (p_brand) JOIN t USING (p_type)
""")
def lump_top_levels(spark, sf_dir):
    """The five most frequent brands and the rest; six types stay six."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("type"))
    return lump_levels(lump_levels(part, "brand", 5), "type", 5)


@query("""
WITH b AS (SELECT p_brand, rank() OVER (ORDER BY count(*) DESC) AS r FROM part GROUP BY 1),
l AS (SELECT p_type, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size_class,
             CASE WHEN r <= 5 OR (SELECT count(*) FROM b WHERE r > 5) <= 1 THEN p_brand ELSE 'Other' END AS brand FROM part JOIN b USING (p_brand))
SELECT p_type, size_class, brand, count(*) AS n FROM l GROUP BY 1, 2, 3
""")
def flow_counts(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_type", F.when(F.col("p_size") > 25, F.lit("large")).otherwise(F.lit("small")).alias("size_class"),
        F.col("p_brand").alias("brand"))
    return aggregate.flow_counts(part, ["p_type", "size_class", "brand"], lump="brand", keep=5)


# --- distributions ---------------------------------------------------------------------------

@query("""
WITH v AS (SELECT 'orders' AS label, o_totalprice AS value FROM orders UNION ALL SELECT 'lines ' || l_returnflag, l_extendedprice FROM lineitem),
s AS (SELECT label, min(value) AS lo, (max(value) - min(value)) / 30 AS width FROM v GROUP BY 1),
b AS (SELECT label, lo, width, least(floor((value - lo) / width), 29)::BIGINT AS bin FROM v JOIN s USING (label))
SELECT label, bin, lo + bin * width AS bin_from, lo + (bin + 1) * width AS bin_to, count(*) AS n FROM b GROUP BY label, bin, lo, width
""")
def histogram_bins(spark, sf_dir):
    values = stack_rows(
        table(spark, sf_dir, "orders").select(F.lit("orders").alias("label"), F.col("o_totalprice").alias("value")),
        table(spark, sf_dir, "lineitem").select(
            F.concat(F.lit("lines "), "l_returnflag").alias("label"), F.col("l_extendedprice").alias("value")))
    return aggregate.histogram(values, "label", "value", 30)


def _box_sql(table_name: str, group: str, value: str) -> str:
    return f"""
    WITH q AS (SELECT {group} AS label, count(*) AS n, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median,
                      quantile_cont({value}, 0.75) AS q3 FROM {table_name} GROUP BY 1)
    SELECT label, n, q1::DECIMAL(18,4)::DOUBLE AS q1, median::DECIMAL(18,4)::DOUBLE AS median, q3::DECIMAL(18,4)::DOUBLE AS q3,
           min({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
           max({value}) FILTER ({value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
           count(*) FILTER ({value} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM q JOIN {table_name} ON {group} = label GROUP BY label, n, q.q1, q.median, q.q3"""


def to_four_digits(boxes):
    """Quartiles of amounts in cents have at most four decimals; the last bit depends on the engine."""
    return boxes.withColumns({c: F.col(c).cast("decimal(18,4)").cast("double") for c in ("q1", "median", "q3")})


@query(_box_sql("orders", "o_orderpriority", "o_totalprice"))
def box_stats(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "label")
    return to_four_digits(aggregate.box_stats(orders, "label", "o_totalprice"))


@query(_box_sql("events", "event_type", "value"))
def box_stats_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "label")
    return to_four_digits(aggregate.box_stats(events, "label", "value"))


@query("""
WITH v AS (SELECT 'capex' AS label, o_orderkey AS key, o_totalprice AS value FROM orders
           UNION ALL SELECT 'capacity ' || l_linestatus, l_orderkey, l_quantity FROM lineitem),
s AS (SELECT label, avg(value) AS m, nullif(stddev_samp(value), 0) AS d FROM v GROUP BY 1)
SELECT label, key, value, CAST(CAST((value - m) / d AS DECIMAL(18,6)) AS DOUBLE) AS value_std FROM v JOIN s USING (label)
""")
def zscore_points(spark, sf_dir):
    values = stack_rows(
        table(spark, sf_dir, "orders").select(
            F.lit("capex").alias("label"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("value")),
        table(spark, sf_dir, "lineitem").select(
            F.concat(F.lit("capacity "), "l_linestatus").alias("label"), F.col("l_orderkey").alias("key"),
            F.col("l_quantity").alias("value")))
    scored = standard_scores(values, "label", "value", "value_std")
    return scored.withColumn("value_std", F.col("value_std").cast("decimal(18,6)").cast("double"))


@query("""
SELECT p_partkey, p_name FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR) || '|' || 'inspect'), p_partkey LIMIT 10
""")
def sample_rows(spark, sf_dir):
    return seeded_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), 10, ["p_partkey"], "inspect")
