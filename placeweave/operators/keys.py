"""Fixed-width geography keys: coverage, repair and resolution through an alias table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions.text import first_match, geoid_prefix, pad_left, rate_message
from placeweave.operators.aggregate import member_rates
from placeweave.operators.joins import equi_join, member_flag

NO_MATCH = "NO_MATCH"


def geoid_aliases(dims: DataFrame, key: str = "census_geoid", alias: str = "census_geoid_joiner") -> DataFrame:
    """Alias table: each full key names itself, each nine-digit prefix names its lowest key."""
    keys = dims.select(key)
    by_prefix = (
        keys.groupBy(geoid_prefix(key).alias(alias)).agg(F.min(key).alias(key)).select(key, alias)
    )
    return keys.withColumn(alias, F.col(key)).unionByName(by_prefix)


def _forms(joiner: DataFrame, joiner_key: str, alias: str) -> DataFrame:
    """One row per text a key can be met by: the full keys, and the prefixes with the tract their alias stands for."""
    key, short = F.col(joiner_key), geoid_prefix(joiner_key)
    full = joiner.filter(key.isNotNull()).select(F.lit("full").alias("__form"), key.alias("__text"), key.alias("__tract")).distinct()
    prefix = joiner.filter(short.isNotNull()).groupBy(short.alias("__text")).agg(F.min(F.when(F.col(alias) == short, key)).alias("__tract"))
    return full.unionByName(prefix.withColumn("__form", F.lit("prefix")))


def _looked_up(df: DataFrame, key: str, joiner: DataFrame, joiner_key: str, alias: str) -> DataFrame:
    """``df`` with the flags ``__full`` and ``__short`` and the prefix's tract ``__lowest``.

    Distinct keys ask for all their forms at once, a row a form, so no row holds a set of keys, however many digits follow the prefix.
    ``df`` itself is joined once, with what its keys were found to be.
    """
    # A name of its own, in case the joiner's columns are called like the frame's.
    asked = df.select(F.col(key).alias("__asked")).filter(F.col("__asked").isNotNull()).distinct()
    forms = F.array(F.struct(F.lit("full").alias("__form"), F.col("__asked").alias("__text")),
                    F.struct(F.lit("prefix").alias("__form"), geoid_prefix("__asked").alias("__text")))
    met = equi_join(asked.select("__asked", F.inline(forms)), _forms(joiner, joiner_key, alias), ["__form", "__text"], missing_matches=False)
    is_full = F.col("__form") == "full"
    found = met.groupBy("__asked").agg(F.max(is_full).alias("__full"), F.max(~is_full).alias("__short"),
                                       F.min(F.when(~is_full, F.col("__tract"))).alias("__lowest"))
    # Compared null-safely, what was found is exchanged anew rather than taken as it was aggregated, which
    # leaves a hot key of ``df`` open to adaptive splitting.
    joined = df.join(found, F.col(key).eqNullSafe(F.col("__asked")), "left")
    return joined.withColumns({flag: F.coalesce(flag, F.lit(False)) for flag in ("__full", "__short")})


_LOOKUP_COLUMNS = ("__asked", "__lowest", "__full", "__short")


def resolve_geoid(df: DataFrame, key: str, joiner: DataFrame, out: str = "census_geoid_joiner",
                  joiner_key: str = "census_geoid", alias: str = "census_geoid_joiner") -> DataFrame:
    """The key itself where it is known, else its nine digits where those are known, else ``NO_MATCH``.

    A missing key is ``NO_MATCH``.
    """
    found = _looked_up(df, key, joiner, joiner_key, alias)
    resolved = first_match(
        [(F.col("__full"), F.col(key)), (F.col("__short"), geoid_prefix(key))], NO_MATCH)
    return found.withColumn("__resolved", resolved).drop(*_LOOKUP_COLUMNS).withColumnRenamed("__resolved", out)


def conform_to_tract(df: DataFrame, key: str, joiner: DataFrame, out: str = "census_geoid",
                     joiner_key: str = "census_geoid", alias: str = "census_geoid_joiner") -> DataFrame:
    """Resolve ``key`` and map it to a tract in one join; rows that resolve nowhere drop out.

    Same rows as ``resolve_geoid`` followed by an inner join on the alias: a full key is its own tract,
    and the prefix row already names the tract its alias stands for.
    """
    found = _looked_up(df.filter(F.col(key).isNotNull()), key, joiner, joiner_key, alias)
    tract = F.when(F.col("__full"), F.col(key)).when(F.col("__short"), F.col("__lowest"))
    located = found.withColumn("__tract", tract).filter(F.col("__tract").isNotNull())
    return located.drop(*_LOOKUP_COLUMNS).withColumnRenamed("__tract", out)


def geoid_coverage(df: DataFrame, key: str, joiner: DataFrame, joiner_key: str = "census_geoid") -> DataFrame:
    """How many keys match as they are, and how many by their first nine digits.

    Keys are counted first, so the lookups see each distinct key once.
    """
    counted = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__prefix", geoid_prefix("__key"))
    prefixes = joiner.select(geoid_prefix(joiner_key).alias("__prefixes"))
    flagged = member_flag(counted, "__key", joiner, joiner_key, "as_is")
    flagged = member_flag(flagged, "__prefix", prefixes, "__prefixes", "abbreviated")
    sums = flagged.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("as_is"), F.col("__n"))), F.lit(0)).alias("as_is"),
        F.coalesce(F.sum(F.when(F.col("abbreviated"), F.col("__n"))), F.lit(0)).alias("abbreviated"),
    )
    long = sums.unpivot(["total"], ["as_is", "abbreviated"], "match_kind", "matched")
    what = F.when(F.col("match_kind") == "as_is", F.lit("census_geoids match as-is")).otherwise(
        F.lit("census_geoids match if abbreviated to 9 digits"))
    message = F.concat(
        rate_message(F.col("matched"), F.col("total"), "|"))
    return long.select(
        "match_kind", "matched", "total",
        (F.col("matched") / F.nullif(F.col("total"), F.lit(0))).alias("rate"),
        F.replace(message, F.lit("|"), what).alias("message"),
    )


def variant_coverage(df: DataFrame, variants: dict, known: DataFrame, known_key: str) -> DataFrame:
    """Match rate of several repairs of a key: ``variants`` maps a name to a column expression.

    One row per variant with the share, the number of matches and the number of misses.
    """
    long = df.select(*[c.alias(name) for name, c in variants.items()]).unpivot(
        [], list(variants), "variable", "value")
    return member_rates(long, "value", known, known_key, "variable")


def county_geoids(dims: DataFrame) -> DataFrame:
    """Distinct (state, county) pairs with their five-digit key."""
    pairs = dims.select("state_fips", "county_fips").distinct()
    return pairs.withColumn("county_geoid", F.concat_ws(
        "", F.coalesce("state_fips", F.lit("NA")), F.coalesce("county_fips", F.lit("NA"))))


def padded_county_join(df: DataFrame, county_key: str, dims: DataFrame) -> DataFrame:
    """Inner join on the left-padded five-digit county key, which is then dropped."""
    padded = df.withColumn(county_key, pad_left(county_key, 5))
    return equi_join(padded, county_geoids(dims), [(county_key, "county_geoid")]).drop(county_key)
