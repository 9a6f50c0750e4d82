"""Region metrics, rankings and dyads.

Definitions chosen here, since the notes only name them: a region's score is the weighted sum of its
metrics' percent ranks; a region is competitive when at least ``needed`` metrics reach the given
quantile; a dyad is a pair of places of two kinds at most a radius apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.operators.aggregate import value_ranks
from placeweave.operators.joins import equi_join
from placeweave.operators.pair_counts import pairs_within
from placeweave.operators.spatial import nearest_places, places_within
from placeweave.session import stored


def _total(metric: str) -> Column:
    """The values as they are given: a decimal column is summed exactly, any other as doubles."""
    return F.sum(metric).alias(metric)


def region_levels(dims: DataFrame, key: str, levels: Mapping[str, str]) -> DataFrame:
    """Crosswalk ``(key, level, region)`` from a dimension whose columns name the region of each level."""
    named = dims.select(key, *[F.col(column).alias(level) for level, column in levels.items()])
    return named.unpivot([key], list(levels), "level", "region")


def metric_rollup(observations: DataFrame, key: str, metrics: Sequence[str], crosswalk: DataFrame) -> DataFrame:
    """Each metric summed per region of each level of ``crosswalk(key, level, region)``.

    Observations are summed per key once, before the crosswalk multiplies or concentrates them, and all
    levels share one join and one aggregate.  Regions of a level may overlap, so their totals must not
    be added up.
    """
    per_key = observations.groupBy(key).agg(
        F.count(F.lit(1)).alias("observations"), *[_total(m) for m in metrics])
    joined = equi_join(per_key, crosswalk.select(key, "level", "region"), [key])
    return joined.groupBy("level", "region").agg(
        F.sum("observations").alias("observations"), *[F.sum(m).cast("double").alias(m) for m in metrics])


def unplaced_totals(observations: DataFrame, key: str, metrics: Sequence[str], crosswalk: DataFrame) -> DataFrame:
    """What ``metric_rollup`` leaves out: per level, the observations whose key has no region there, and their totals."""
    per_key = observations.groupBy(key).agg(F.count(F.lit(1)).alias("observations"), *[_total(m) for m in metrics])
    known = crosswalk.filter(F.col("region").isNotNull()).groupBy(key).agg(F.collect_set("level").alias("__known"))
    levels = crosswalk.agg(F.collect_set("level").alias("levels")).scalar()
    joined = equi_join(per_key, known, [key], "left").withColumn(
        "level", F.explode(F.array_except(levels, F.coalesce("__known", F.array().cast("array<string>")))))
    return joined.groupBy("level").agg(F.sum("observations").alias("observations"), *[F.sum(m).cast("double").alias(m) for m in metrics])


def _metric_values(regions: DataFrame, metrics: Sequence[str], *keep: str) -> DataFrame:
    """``keep``, level, metric and value: a row for each metric of each region."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return regions.select(*keep, "level", F.inline(values))


def region_rank(rollup: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """Percent rank of every metric within its level, their weighted sum, and the rank of that sum.

    All metrics are ranked in one pass over (level, metric, value), the score in a second one, which needs the first.
    Missing totals count as 0.
    """
    regions = stored(rollup.fillna(0, subset=list(weights)).withColumn("__row", F.monotonically_increasing_id()), "regions")
    values = _metric_values(regions, list(weights), "__row")
    ranks = value_ranks(values, ["level", "metric"], "value")
    percent = F.coalesce(F.col("below") / F.nullif(F.col("total") - 1, F.lit(0)), F.lit(0.0))
    placed = equi_join(values, ranks.withColumn("percent", percent), ["level", "metric", "value"], "left")
    wide = placed.groupBy("__row").agg(*[F.max(F.when(F.col("metric") == m, F.col("percent"))).alias(f"{m}_rank") for m in weights])
    score = sum((F.lit(float(w)) * F.col(f"{m}_rank") for m, w in weights.items()), F.lit(0.0))
    scored = stored(regions.join(wide, "__row").drop("__row").withColumn("score", score), "scores")
    places = value_ranks(scored, "level", "score").select("level", "score", (F.col("total") - F.col("below") - F.col("n") + 1).alias("place"))
    return equi_join(scored, places, ["level", "score"], "left")


def competitive_regions(rollup: DataFrame, metrics: Sequence[str], quantile: float = 0.75,
                        needed: int = 2) -> DataFrame:
    """Flag regions of which at least ``needed`` metrics reach their level's quantile.

    The limits of all metrics come from one pass: the two values next to the wanted rank, interpolated.
    """
    regions = stored(rollup, "regions")
    ranks = value_ranks(_metric_values(regions, metrics), ["level", "metric"], "value")
    place = (F.col("total") - 1) * F.lit(float(quantile))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("below") <= rank) & (rank < F.col("below") + F.col("n")), F.col("value")))
    ends = ranks.groupBy("level", "metric").agg(at(F.floor(place)).alias("low"), at(F.ceil(place)).alias("high"), F.max(place - F.floor(place)).alias("part"))
    limit = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    limits = ends.groupBy("level").agg(*[F.max(F.when(F.col("metric") == m, limit)).alias(f"__limit_{m}") for m in metrics])
    flagged = equi_join(regions, limits, ["level"], "left")
    high = sum((F.coalesce((F.col(m) >= F.col(f"__limit_{m}")).cast("int"), F.lit(0)) for m in metrics), F.lit(0))
    flagged = flagged.withColumn("high_metrics", high).withColumn("competitive", F.col("high_metrics") >= needed)
    return flagged.drop(*[f"__limit_{m}" for m in metrics])


def ratio_by_region(rollup: DataFrame, numerator: str, denominator: str, out: str = "ratio") -> DataFrame:
    """Capacity per unit of investment, or any other ratio of two totals; null where there is nothing to divide by."""
    return rollup.withColumn(out, F.try_divide(F.col(numerator), F.col(denominator)))


def of_dataset(observations: DataFrame, dataset: str) -> DataFrame:
    return observations.filter(F.col("dataset_name") == dataset)


def drill_down(regions: DataFrame, region_key: str, observations: DataFrame) -> DataFrame:
    """The observations behind the chosen regions."""
    return equi_join(observations, regions.select(region_key).distinct(), [region_key], "left_semi")


def _places(df: DataFrame, value: str | None, day: str | None) -> DataFrame:
    """Co-located rows of one kind (and day) as one place with a quantity: copies cannot multiply pairs."""
    keys = ["kind", "lon", "lat", *([day] if day else [])]
    total = [F.sum(value).cast("double").alias("value")] if value else []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("quantity"), *total)


def dyads(left: DataFrame, right: DataFrame, metres: float, value: str | None = None,
          day: str | None = None) -> DataFrame:
    """Pairs of places within ``metres``: kinds, number of observation pairs, distance, lag in days.

    Both frames hold ``kind``, ``lon`` and ``lat``.
    """
    pairs = places_within(_places(left, value, day), _places(right, value, day), metres)
    pairs = pairs.withColumn("quantity", F.col("l_quantity") * F.col("r_quantity"))
    if day:
        pairs = pairs.withColumn("lag_days", F.datediff(F.col(f"r_{day}"), F.col(f"l_{day}")))
    return pairs


def dyad_summary(pairs: DataFrame) -> DataFrame:
    """Per pair of kinds: how many dyads, at what smallest and mean distance."""
    weight = F.col("quantity")
    return pairs.groupBy("l_kind", "r_kind").agg(
        F.sum(weight).alias("dyads"),
        F.min("distance").alias("nearest"),
        (F.sum(weight * F.col("distance")) / F.sum(weight)).alias("mean_distance"),
    )


def dyad_counts(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """The ``dyads`` of ``dyad_summary`` where only their number is asked for: crowds are counted by cells instead of pair by pair."""
    return pairs_within(_places(left, None, None), _places(right, None, None), metres)


def remainder_nearby(projects: DataFrame, chosen: Column, k: int, metres: float, value: str | None = None) -> DataFrame:
    """Filter kinds, then look at the remainder nearby: the ``k`` nearest remaining places around each place of the ``chosen`` kinds.

    ``chosen`` is a condition on ``projects``, which hold ``kind``, ``lon`` and ``lat``; where it is missing the row remains. Co-located
    rows of one kind are one place with a ``quantity``. Chosen places come back with ``l_``, the remainder with ``r_``.
    """
    picked = F.coalesce(chosen, F.lit(False))
    pairs = nearest_places(_places(projects.filter(~picked), value, None), _places(projects.filter(picked), value, None), k, metres, ties=["kind"])
    sides = {f"{a}_": f"{b}_" for a, b in ("lr", "rl")}
    return pairs.select(*[F.col(c).alias(sides.get(c[:2], c[:2]) + c[2:]) for c in pairs.columns])


def label_overlaps(rollup: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``rollup`` with ``overlapping``: whether its level has regions that share a key, so that its totals must not be added up."""
    shared = crosswalk.filter(F.col("region").isNotNull()).groupBy("level", *[c for c in crosswalk.columns if c not in ("level", "region")]).agg(
        (F.min("region") < F.max("region")).alias("shared"))
    levels = shared.groupBy("level").agg(F.max("shared").alias("overlapping"))  # one row a level
    return equi_join(rollup, levels, ["level"], "left").withColumn("overlapping", F.coalesce("overlapping", F.lit(False)))
