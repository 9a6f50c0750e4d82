"""Projections, predicates, conditionals and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from placeweave.functions.text import (
    first_match, geoid_prefix, glue, number_in_text, pad_left, pad_right, round_even, unite,
)
from placeweave.operators.joins import equi_join
from placeweave.operators.reshape import drop_missing, fill_booleans, recode, stack_rows
from placeweave.plans.observations import clean_county_name, recode_by_rules, recode_by_table
from placeweave.queries.registry import query, table
from placeweave.sources.readers import front, lower_names, names_containing, replace_in_names, select_as


@query("""
SELECT c_custkey AS tract_id, c_mktsegment AS market_segment, c_name AS tract_name, c_nationkey::BIGINT AS nation_key,
       'customers' AS dataset_name
FROM customer
""")
def rename_reorder_project(spark, sf_dir):
    """Lower-cased and despaced names, selection by name pattern, renames, moves and drops."""
    raw = select_as(table(spark, sf_dir, "customer"), **{
        "Tract ID": "c_custkey", "Tract NAME": "c_name", "Tract Nation Key": "c_nationkey",
        "Account Balance": "c_acctbal", "Tract Market Segment": "c_mktsegment"})
    tidy = replace_in_names(lower_names(raw))
    tracts = names_containing(tidy, "tract").withColumnsRenamed(
        {"tract_nation_key": "nation_key", "tract_market_segment": "market_segment"})
    moved = front(tracts, "tract_id", "market_segment")
    return moved.withColumn("nation_key", F.col("nation_key").cast("long")).withColumn(
        "dataset_name", F.lit("customers")).drop("account_balance")


@query("""
SELECT 'not equal' AS form, p_partkey AS key, p_name AS text FROM part
 WHERE p_name <> p_type AND p_brand <> 'Brand#1' AND p_type <> 'PROMO'
UNION ALL SELECT 'short key', p_partkey, p_name FROM part WHERE length(CAST(p_partkey AS VARCHAR)) < 3
UNION ALL SELECT 'values of one brand', NULL, p_type FROM (SELECT DISTINCT p_type FROM part WHERE p_brand = 'Brand#7')
UNION ALL SELECT 'first rows', p_partkey, p_name
  FROM (SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10)
""")
def filter_forms(spark, sf_dir):
    part = table(spark, sf_dir, "part")

    def rows(form, df, key="p_partkey", text="p_name"):
        return df.select(F.lit(form).alias("form"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    other = part.filter((F.col("p_name") != F.col("p_type")) & (F.col("p_brand") != "Brand#1") & (F.col("p_type") != "PROMO"))
    short = part.filter(F.length(F.col("p_partkey").cast("string")) < 3)
    values = part.filter(F.col("p_brand") == F.lit("Brand#7")).select("p_type").distinct()
    first = part.orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(10)
    return stack_rows(
        rows("not equal", other), rows("short key", short),
        rows("values of one brand", values.withColumn("p_partkey", F.lit(None).cast("long")), text="p_type"),
        rows("first rows", first))


@query("""
SELECT o_orderkey,
       CASE WHEN s = 'F' THEN 'finished' WHEN o_totalprice > 250000 THEN 'large' WHEN s = 'O' THEN 'open'
            ELSE 'DEFAULT_UNKNOWN' END AS status,
       s AS status_known, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS priority
FROM (SELECT *, nullif(o_orderstatus, 'P') AS s FROM orders)
""")
def first_match_case(spark, sf_dir):
    """First true case wins and a missing condition falls through; sentinels and dictionary recodes."""
    orders = table(spark, sf_dir, "orders").withColumn("status_known", F.nullif("o_orderstatus", F.lit("P")))
    status = first_match(
        [(F.col("status_known") == "F", "finished"), (F.col("o_totalprice") > 250000, "large"),
         (F.col("status_known") == "O", "open")], "DEFAULT_UNKNOWN")
    recoded = recode(orders.withColumn("priority", F.col("o_orderpriority")), "priority",
                     {"1-URGENT": "urgent", "5-LOW": "low"})
    return recoded.select("o_orderkey", status.alias("status"), "status_known", "priority")


@query("""
SELECT l_quantity, round_even(l_quantity / 2, 0) AS half, count(*) AS n FROM lineitem GROUP BY l_quantity
""")
def half_even_rounding(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("l_quantity", round_even(F.col("l_quantity") / 2).alias("half"), "n")


NAME_RULES = [
    ("Brand#1", "is", "small ring", "ring, small"),
    ("Brand#1", "has", "small", "small thing"),
    ("Brand#2", "has", "widget", "widget"),
    ("Brand#2", "is", "red widget", "never reached"),
    ("Brand#3", "has", "blue", "blue thing"),
    ("Brand#3", "has", "bolt", "bolt"),
    ("Brand#9", "is", "green gear", "gear, green"),
]


@query("""
WITH r AS (SELECT p_partkey, CASE
    WHEN p_brand = 'Brand#1' AND p_name = 'small ring' THEN 'ring, small'
    WHEN p_brand = 'Brand#1' AND contains(p_name, 'small') THEN 'small thing'
    WHEN p_brand = 'Brand#2' AND contains(p_name, 'widget') THEN 'widget'
    WHEN p_brand = 'Brand#2' AND p_name = 'red widget' THEN 'never reached'
    WHEN p_brand = 'Brand#3' AND contains(p_name, 'blue') THEN 'blue thing'
    WHEN p_brand = 'Brand#3' AND contains(p_name, 'bolt') THEN 'bolt'
    WHEN p_brand = 'Brand#9' AND p_name = 'green gear' THEN 'gear, green'
    ELSE p_name END AS name FROM part)
SELECT p_partkey, name AS by_list, name AS by_table FROM r
""")
def curated_recode(spark, sf_dir):
    """Curated recodes within a scope, as an expression and as a rules table; the first rule wins."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    rules = spark.createDataFrame(
        [(*rule, i) for i, rule in enumerate(NAME_RULES)],
        "scope string, kind string, text string, good string, priority int")
    listed = part.withColumn("by_list", recode_by_rules(F.col("p_brand"), F.col("p_name"), NAME_RULES))
    tabled = recode_by_table(listed.withColumn("by_table", F.col("p_name")), "p_brand", "by_table", rules)
    return tabled.select("p_partkey", "by_list", "by_table")


@query("""
WITH f AS (SELECT o_custkey, count(*) AS n, true AS flag FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, coalesce(flag, false) AS has_finished, n AS finished, coalesce(n, -1) AS finished_or_minus_one,
       n IS NOT NULL AS complete
FROM customer LEFT JOIN f ON c_custkey = o_custkey
""")
def drop_missing_fill(spark, sf_dir):
    """Fill missing booleans, first non-missing value, and rows that dropping would keep."""
    finished = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("finished"), F.lit(True).alias("has_finished"))
    joined = equi_join(table(spark, sf_dir, "customer").select("c_custkey"), finished, [("c_custkey", "o_custkey")], "left")
    complete = drop_missing(joined, ["finished"]).select("c_custkey", F.lit(True).alias("complete"))
    marked = equi_join(joined, complete, ["c_custkey"], "left")
    return fill_booleans(marked).withColumn(
        "finished_or_minus_one", F.coalesce("finished", F.lit(-1).cast("long")))


NBSP = "\u00a0"


@query(r"""
WITH d AS (SELECT c_custkey, CASE c_mktsegment
        WHEN 'AUTOMOBILE' THEN n_name || ' County (part)' WHEN 'BUILDING' THEN 'county  County ' || n_name
        WHEN 'FURNITURE' THEN chr(9) || n_name || ' Census  Area' WHEN 'HOUSEHOLD' THEN n_name || ' Parish'
        WHEN 'MACHINERY' THEN 'Parish ' || n_name || chr(160) ELSE NULL END AS place
     FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        regexp_replace(lower(place), '\(.*\)', ''), '\bcounty\b', ''), '\bborough\b', ''), '\bcensus\b', ''), '\barea\b', ''),
        '\bmunicipal\b', ''), '\bregion\b', ''), '\bparish$', '') AS t FROM d)
SELECT c_custkey, place, regexp_replace(regexp_replace(t, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g'), '[\s\x{00A0}]{2,}', ' ', 'g') AS cleaned
FROM s
""")
def name_clean_first_regex(spark, sf_dir):
    """Dirtied place names: each kind word is dropped once only, whitespace is trimmed and squeezed."""
    name = F.col("n_name")
    place = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.concat(name, F.lit(" County (part)")))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("county  County "), name))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("\t"), name, F.lit(" Census  Area")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(name, F.lit(" Parish")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("Parish "), name, F.lit(NBSP))))
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", place.alias("place")).withColumn("cleaned", clean_county_name("place"))


@query("""
SELECT k AS key, CASE WHEN length(k) >= 5 THEN k ELSE lpad(k, 5, '0') END AS pad_left,
       CASE WHEN length(k) >= 5 THEN k ELSE rpad(k, 5, '0') END AS pad_right, length(k)::BIGINT AS digits
FROM (SELECT CAST(o_orderkey * 20 AS VARCHAR) AS k FROM orders)
""")
def pad_never_truncate(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 20).cast("string").alias("key"))
    return keys.select("key", pad_left("key", 5).alias("pad_left"), pad_right("key", 5).alias("pad_right"),
                       F.length("key").cast("long").alias("digits"))


@query("""
SELECT g AS geoid, nullif(regexp_extract(g, '^[0-9]{9}'), '') AS prefix
FROM (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS VARCHAR)
                  WHEN c_mktsegment = 'MACHINERY' THEN 'T' || lpad(CAST(c_custkey AS VARCHAR), 11, '0')
                  ELSE lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS g FROM customer)
""")
def prefix_extract(spark, sf_dir):
    text = F.col("c_custkey").cast("string")
    geoid = (
        F.when(F.col("c_mktsegment") == "BUILDING", text)
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("T"), F.lpad(text, 11, "0")))
        .otherwise(F.lpad(text, 11, "0")))
    return table(spark, sf_dir, "customer").select(geoid.alias("geoid")).withColumn("prefix", geoid_prefix("geoid"))


@query("""
SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS from_props,
       -value AS from_signed, 1000 + CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS from_grouped
FROM events
""")
def number_from_text(spark, sf_dir):
    """First number inside text: JSON, zero-padded and signed, with a grouping comma."""
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    return table(spark, sf_dir, "events").select(
        "event_id",
        number_in_text("props").alias("from_props"),
        number_in_text(F.concat(F.lit("-0"), F.col("value").cast("string"), F.lit(" deg"))).alias("from_signed"),
        number_in_text(F.concat(F.lit("about 1,"), F.lpad(digits, 3, "0"), F.lit(" MW, 2 units"))).alias("from_grouped"))


@query("""
WITH f AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey, c_mktsegment || '__' || CAST(n AS VARCHAR) AS glued,
       c_mktsegment || ': ' || coalesce(CAST(n AS VARCHAR), 'NA') AS united
FROM customer LEFT JOIN f ON c_custkey = o_custkey
""")
def unite_missing_text(spark, sf_dir):
    """Concatenation that a missing part makes missing, next to one that writes it as NA."""
    finished = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("string").alias("n"))
    joined = equi_join(table(spark, sf_dir, "customer"), finished, [("c_custkey", "o_custkey")], "left")
    return joined.select("c_custkey", glue("c_mktsegment", "n", sep="__").alias("glued"),
                         unite("c_mktsegment", "n", sep=": ").alias("united"))
