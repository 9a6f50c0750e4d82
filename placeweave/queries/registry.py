"""The query registry and the raw tables derived from the star schema.

Roles: region → state, nation → county, customer → census tract, orders → facility observations,
lineitem → capacity observations, embeddings → points and triangles.  The raw tables carry the column
names and the faults (lost digits, dirtied names, missing cells) that the dataset builds deal with.
"""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.functions.geometry import polygon
from placeweave.functions.text import pad_left

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with the SQL that yields the same rows."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = dedent(sql).strip()
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- states and counties -------------------------------------------------------

def raw_state(spark, sf_dir) -> DataFrame:
    """STATEFP, STUSPS, NAME from region."""
    return table(spark, sf_dir, "region").select(
        F.lpad((F.col("r_regionkey") + 1).cast("string"), 2, "0").alias("STATEFP"),
        F.substring("r_name", 1, 2).alias("STUSPS"),
        F.col("r_name").alias("NAME"))


STATE_SQL = """
state AS (SELECT lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS state_fips,
                 substr(r_name, 1, 2) AS state_name_abbrev, r_name AS state_name FROM region)"""


def place_of_nation(spark, sf_dir) -> DataFrame:
    """Nation as a county: keys, names and the state it belongs to."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    state = F.lpad((F.col("r_regionkey") + 1).cast("string"), 2, "0")
    county = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", state.alias("state_fips"), county.alias("county_fips"),
        F.concat(state, county).alias("county_geoid"), F.col("n_name").alias("county_name"),
        F.substring("r_name", 1, 2).alias("state_name_abbrev"), F.col("r_name").alias("state_name"))


PLACE_SQL = """
place AS (SELECT n_nationkey, lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS state_fips,
                 lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS county_fips,
                 lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS county_geoid,
                 n_name AS county_name, substr(r_name, 1, 2) AS state_name_abbrev, r_name AS state_name
          FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# --- tracts ----------------------------------------------------------------------

def geoid_of(custkey: Column | str) -> Column:
    return F.lpad((F.col(custkey) if isinstance(custkey, str) else custkey).cast("string"), 11, "0")


def tract_dims_of_customer(spark, sf_dir) -> DataFrame:
    """census_geoid, state_fips, county_fips, census_tract of every customer."""
    customer = table(spark, sf_dir, "customer")
    place = place_of_nation(spark, sf_dir).select("n_nationkey", "state_fips", "county_fips")
    geoid = geoid_of("c_custkey")
    return customer.join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(
        geoid.alias("census_geoid"), "state_fips", "county_fips",
        F.substring(geoid, 6, 6).alias("census_tract"))


TRACT_SQL = PLACE_SQL + """,
tract AS (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS census_geoid, state_fips, county_fips,
                 substr(lpad(CAST(c_custkey AS VARCHAR), 11, '0'), 6, 6) AS census_tract
          FROM customer JOIN place ON c_nationkey = n_nationkey)"""

JOINER_SQL = """
joiner AS (SELECT g AS census_geoid, g AS census_geoid_joiner
           FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS g FROM customer)
           UNION ALL
           SELECT min(g), substr(g, 1, 9)
           FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS g FROM customer) GROUP BY substr(g, 1, 9))"""


def customer_joiner(spark, sf_dir) -> DataFrame:
    from placeweave.plans.geography import census_joiner
    return census_joiner(table(spark, sf_dir, "customer").select(geoid_of("c_custkey").alias("census_geoid")))


def tract_key_of_order() -> Column:
    """An order's tract key as published: whole, with two altered last digits, unknown, or missing."""
    geoid = geoid_of("o_custkey")
    return (
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit(None).cast("string"))
        .when(F.col("o_orderstatus") == "P", F.concat(F.substring(geoid, 1, 9), F.lit("XX")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("9"), F.substring(geoid, 2, 10)))
        .otherwise(geoid))


ORDER_KEY_SQL = """
CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN NULL
     WHEN o_orderstatus = 'P' THEN substr(lpad(CAST(o_custkey AS VARCHAR), 11, '0'), 1, 9) || 'XX'
     WHEN o_orderstatus = 'F' THEN '9' || substr(lpad(CAST(o_custkey AS VARCHAR), 11, '0'), 2, 10)
     ELSE lpad(CAST(o_custkey AS VARCHAR), 11, '0') END"""


# --- shapes -----------------------------------------------------------------------

def _coordinate(i: int, scale: float) -> Column:
    return F.get(F.col("embedding"), F.lit(i)).cast("double") * F.lit(scale)


def triangles(spark, sf_dir, scale: float = 1.0) -> DataFrame:
    """vec_id, label and a triangle at dims (0, 1) spanned by half of dims (2, 3) and (4, 5)."""
    e = [_coordinate(i, scale) for i in range(6)]
    half = F.lit(0.5)
    shape = polygon((e[0], e[1]), (e[0] + half * e[2], e[1] + half * e[3]), (e[0] + half * e[4], e[1] + half * e[5]))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("label"),
                                                    shape.alias("geometry"))


def triangle_sql(name: str, where: str = "true", scale: str = "1.0::DOUBLE", x: str = "{}", y: str = "{}") -> str:
    """CTE with the vertices of the same triangles; ``x``/``y`` wrap a coordinate in a projection."""
    def e(i):
        return f"(embedding[{i + 1}]::DOUBLE * {scale})"
    half = "0.5::DOUBLE"
    ax, ay = e(0), e(1)
    bx, by = f"({e(0)} + {half} * {e(2)})", f"({e(1)} + {half} * {e(3)})"
    cx, cy = f"({e(0)} + {half} * {e(4)})", f"({e(1)} + {half} * {e(5)})"
    return f"""
{name} AS (SELECT vec_id, label, {x.format(ax)} AS ax, {y.format(ay)} AS ay, {x.format(bx)} AS bx,
                  {y.format(by)} AS by_, {x.format(cx)} AS cx, {y.format(cy)} AS cy
           FROM embeddings WHERE {where})"""


def triangle_pairs_sql(left: str, right: str, name: str = "pairs") -> str:
    """CTEs giving (l, r) of all triangle pairs that share a point, by brute force."""
    def edges(t):
        return f"""(SELECT vec_id AS id, ax AS x0, ay AS y0, bx AS x1, by_ AS y1 FROM {t}
                    UNION ALL SELECT vec_id, bx, by_, cx, cy FROM {t}
                    UNION ALL SELECT vec_id, cx, cy, ax, ay FROM {t})"""

    ys = {"a": "ay", "b": "by_", "c": "cy", "d": "dy"}  # a bare "by" is a keyword

    def turn(a, b, c):
        return f"sign(({b}x - {a}x) * ({ys[c]} - {ys[a]}) - ({ys[b]} - {ys[a]}) * ({c}x - {a}x))"

    def on(a, b, p):
        return (f"({p}x BETWEEN least({a}x, {b}x) AND greatest({a}x, {b}x) "
                f"AND {ys[p]} BETWEEN least({ys[a]}, {ys[b]}) AND greatest({ys[a]}, {ys[b]}))")

    def inside(p, t):
        s1 = f"sign(({t}.bx - {t}.ax) * ({p}.ay - {t}.ay) - ({t}.by_ - {t}.ay) * ({p}.ax - {t}.ax))"
        s2 = f"sign(({t}.cx - {t}.bx) * ({p}.ay - {t}.by_) - ({t}.cy - {t}.by_) * ({p}.ax - {t}.bx))"
        s3 = f"sign(({t}.ax - {t}.cx) * ({p}.ay - {t}.cy) - ({t}.ay - {t}.cy) * ({p}.ax - {t}.cx))"
        return f"(({s1} >= 0 AND {s2} >= 0 AND {s3} >= 0) OR ({s1} <= 0 AND {s2} <= 0 AND {s3} <= 0))"

    return f"""
{name}_ends AS (SELECT l.id AS l, r.id AS r, l.x0 AS ax, l.y0 AS ay, l.x1 AS bx, l.y1 AS by_,
                       r.x0 AS cx, r.y0 AS cy, r.x1 AS dx, r.y1 AS dy FROM {edges(left)} l, {edges(right)} r),
{name}_turns AS (SELECT *, {turn('a', 'b', 'c')} AS o1, {turn('a', 'b', 'd')} AS o2,
                        {turn('c', 'd', 'a')} AS o3, {turn('c', 'd', 'b')} AS o4 FROM {name}_ends),
{name} AS (SELECT l, r FROM {name}_turns
           WHERE (o1 <> o2 AND o3 <> o4) OR (o1 = 0 AND {on('a', 'b', 'c')}) OR (o2 = 0 AND {on('a', 'b', 'd')})
              OR (o3 = 0 AND {on('c', 'd', 'a')}) OR (o4 = 0 AND {on('c', 'd', 'b')})
           UNION SELECT p.vec_id, t.vec_id FROM {left} p, {right} t WHERE {inside('p', 't')}
           UNION SELECT t.vec_id, p.vec_id FROM {right} p, {left} t WHERE {inside('p', 't')})"""


def padded_text(c: Column | str, width: int) -> Column:
    return pad_left((F.col(c) if isinstance(c, str) else c).cast("string"), width)
