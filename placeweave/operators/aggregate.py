"""Counts, rates, profiles and the summaries behind histograms, box plots and flow charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from placeweave.functions.text import missing
from placeweave.operators.joins import equi_join, member_flag
from placeweave.operators.rank import lump_levels
from placeweave.session import counted_side, pinned, stored


def row_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys occurring more than once, with their count."""
    return row_counts(df, *keys).filter(F.col("n") > 1)


def share(counts: DataFrame, n: str = "n", out: str = "prop", digits: int | None = None) -> DataFrame:
    """Each count as a share of the grand total, optionally rounded half to even."""
    total = counts.agg(F.sum(n).alias("total")).scalar()
    ratio = F.col(n) / total
    return counts.withColumn(out, F.bround(ratio, digits) if digits is not None else ratio)


def counts_of_counts(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, twice, …, with shares."""
    per_key = row_counts(df.filter(F.col(key).isNotNull()), key).withColumnRenamed("n", "occurrences")
    return share(row_counts(per_key, "occurrences"))


def flag_rates(df: DataFrame, flag: str, *keys: str, weight: str | None = None) -> DataFrame:
    """Share, number of hits and number of misses of a boolean, per key or overall.

    ``weight`` names the number of rows a pre-counted row stands for.
    """
    rows = F.col(weight) if weight else F.lit(1)
    hits = F.sum(F.when(F.col(flag), rows).otherwise(0))
    return df.groupBy(*keys).agg(
        (hits / F.sum(rows)).alias("prop"),
        hits.alias("num_matches"),
        F.sum(F.when(F.col(flag), 0).otherwise(rows)).alias("num_bad"),
    )


def member_rates(df: DataFrame, column: str, values: DataFrame, values_column: str, *keys: str) -> DataFrame:
    """Rate of ``column in values`` per key; rows are counted per value before the lookup."""
    counted = row_counts(df, *keys, column)
    return flag_rates(member_flag(counted, column, values, values_column, "__hit"), "__hit", *keys, weight="n")


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the column is a floating one."""
    return missing(F.col(f"`{column}`"), isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)))


def missing_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its share of missing values."""
    columns = list(columns) if columns else df.columns
    wide = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], columns, "variable", "missing_rate")


def row_ratio(result: DataFrame, source: DataFrame) -> DataFrame:
    """Rows of ``result`` per row of ``source``."""
    n = F.count(F.lit(1))
    tagged = result.agg(n.alias("result_rows")).select(
        "result_rows", source.agg(n.alias("n")).scalar().alias("source_rows"))
    return tagged.withColumn(
        "ratio", F.col("result_rows") / F.nullif(F.col("source_rows"), F.lit(0)))


def flattened_text(df: DataFrame, keys: Sequence[str], value: str, order: str, sep: str = ": ",
                   partitions: int | None = None) -> DataFrame:
    """The distinct values of each key joined in ``order`` (equal places by value); missing values are skipped.

    Entries are range-sorted by key and place first, so a key with any share of the rows is spread over ranges. Each range writes
    its piece of the key's text, and only the few pieces of a key meet.
    """
    named = [F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]
    names = [f"__key_{i}" for i in range(len(keys))]
    entries = df.filter(F.col(value).isNotNull()).select(*named, F.col(order).alias("__o"), F.col(value).alias("__v")).distinct()
    ranged = entries.repartitionByRange(*([partitions] if partitions else []), *names, "__o", "__v")
    placed = ranged.withColumn("__part", F.spark_partition_id())
    inside = F.array_sort(F.collect_list(F.struct("__o", "__v")))
    pieces = placed.groupBy(*names, "__part").agg(F.array_join(F.transform(inside, lambda e: e["__v"]), sep).alias("__text"))
    # Ranges ascend, so pieces in the order of their ranges are the whole text.
    whole = F.array_sort(F.collect_list(F.struct("__part", "__text")))
    texts = pieces.groupBy(*names).agg(F.array_join(F.transform(whole, lambda p: p["__text"]), sep).alias("info"))
    return texts.withColumnsRenamed(dict(zip(names, keys, strict=True)))


def flattened_flags(df: DataFrame, labels: Sequence[Column], out: str = "info", sep: str = ": ") -> DataFrame:
    """Row-wise counterpart for labels that sit side by side: no reshape, no shuffle.

    Rows without any label drop out, as they do when labels are gathered and missing ones dropped.
    """
    held = reduce(lambda a, b: a | b, [c.isNotNull() for c in labels])
    return df.filter(held).withColumn(out, F.concat_ws(sep, *labels))


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, missing, distinct, smallest, largest, mean, deviation and quartiles.

    One pass with partial aggregation; distinct counts and quartiles are sketched.  Where ``exact`` ones
    are asked for, they come from aggregates over (column, value) pairs, which no hot value overloads.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    unknown = F.lit(None).cast("double")
    stats = []
    for c in df.columns:
        column = F.col(f"`{c}`")
        number = column.cast("double") if c in numeric else unknown
        quartiles = (
            F.percentile_approx(number, [0.25, 0.5, 0.75], 10_000) if c in numeric and not exact
            else F.array(unknown, unknown, unknown))
        stats.append(F.struct(
            F.lit(c).alias("variable"),
            F.count(F.lit(1)).alias("n_rows"),
            F.sum(is_missing(df, c).cast("long")).alias("n_missing"),
            (F.lit(None).cast("long") if exact else F.approx_count_distinct(column)).alias("n_distinct"),
            F.min(column).cast("string").alias("lowest"),
            F.max(column).cast("string").alias("highest"),
            F.avg(number).alias("mean"),
            F.stddev_samp(number).alias("deviation"),
            *[F.get(quartiles, F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))],
        ))
    table = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    if not exact:
        return table
    texts = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    pairs = texts.unpivot([], df.columns, "variable", "value").filter(F.col("value").isNotNull())
    distinct = row_counts(pairs.distinct(), "variable").withColumnRenamed("n", "__distinct")
    table = equi_join(table, distinct, ["variable"], "left").withColumn(
        "n_distinct", F.coalesce("__distinct", F.lit(0))).drop("__distinct")
    if not numeric:
        return table
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in numeric]).unpivot([], numeric, "variable", "value")
    quartiles = exact_quantiles(numbers, "variable", "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}).drop("n")
    return equi_join(table.drop("q1", "median", "q3"), quartiles, ["variable"], "left")


def histogram(df: DataFrame, label: str, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each label; empty bins are not listed."""
    values = df.filter(F.col(value).isNotNull()).select(label, value)
    spans = values.groupBy(label).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    spans = spans.withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    placed = equi_join(values, counted_side(spans), [label])
    place = F.floor((F.col(value) - F.col("lo")) / F.nullif(F.col("width"), F.lit(0.0)))
    placed = placed.withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("long"))
    return placed.groupBy(label, "bin", "lo", "width").agg(F.count(F.lit(1)).alias("n")).select(
        label, "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_from"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
        "n",
    )


ACCURACY = 10_000


def _condensed(df: DataFrame, group: str, value: str, quantiles: Sequence[float], accuracy: int, slack: float,
               fences: bool) -> DataFrame:
    """The values of each group that may be wanted, one row a distinct value, and a row for all those of every gap between them.

    A sketch gives a span of values around every quantile, and around the whisker ends if ``fences``.  Rows hold ``least`` and
    ``value`` (smallest and largest of the row), ``n`` and ``exact`` (false: a gap).  Groups of at most ``accuracy`` rows are all exact.
    """
    held = df.filter(F.col(value).isNotNull()).select(group, value)
    cuts = sorted({end for q in quantiles for end in (max(0.0, q - slack), min(1.0, q + slack))})
    sketch = held.groupBy(group).agg(
        F.percentile_approx(F.col(value).cast("double"), cuts, accuracy).alias("__cuts"), F.count(F.lit(1)).alias("__rows"))

    def cut(q: float) -> Column:
        return F.get("__cuts", F.lit(cuts.index(min(1.0, max(0.0, q)))))

    spans = [(cut(q - slack), cut(q + slack)) for q in quantiles]
    if fences:
        (l1, h1), (l3, h3) = ((cut(q - slack), cut(q + slack)) for q in (0.25, 0.75))
        spans += [(2.5 * l1 - 1.5 * h3, 2.5 * h1 - 1.5 * l3), (2.5 * l3 - 1.5 * h1, 2.5 * h3 - 1.5 * l1)]
    small = F.col("__rows") <= (0 if slack < 1 else 2**62) + accuracy
    ends = sketch.select(group, *[column for i, (low, high) in enumerate(spans) for column in (
        F.when(small, F.lit(float("-inf"))).otherwise(low).alias(f"__low_{i}"),
        F.when(small, F.lit(float("nan"))).otherwise(high).alias(f"__high_{i}"))])  # NaN is the largest value
    joined = equi_join(held, counted_side(ends), [group])
    number = F.col(value).cast("double")
    exact = reduce(lambda a, b: a | b, [number.between(F.col(f"__low_{i}"), F.col(f"__high_{i}")) for i in range(len(spans))])
    gap = reduce(lambda a, b: a + b, [F.when(F.col(f"__high_{i}") < number, 1).otherwise(0) for i in range(len(spans))])
    rows = joined.select(group, value, exact.alias("exact"), F.when(~exact, gap).alias("__gap"))
    return rows.groupBy(group, "exact", "__gap", F.when(F.col("exact"), F.col(value)).alias("__value")).agg(
        F.min(value).alias("least"), F.max(value).alias(value), F.count(F.lit(1)).alias("n")).drop("__gap", "__value")


def _refined(df: DataFrame, group: str, value: str, quantiles: Sequence[float], accuracy: int, fences: bool, summarise) -> DataFrame:
    """``summarise`` of the ranked condensed values, with spans widened until no group says ``__missed``.

    Counts decide, not the sketch: a wanted value that fell into a gap is noticed.  The widest spans hold all values.
    """
    slack = 2 / accuracy
    while True:
        condensed = _condensed(df, group, value, quantiles, accuracy, slack, fences)
        result = pinned(summarise(_running(condensed, [group], value, "least", "exact")))
        if slack >= 1 or result.filter("__missed").isEmpty():
            return result.drop("__missed")
        slack *= 8


def value_ranks(df: DataFrame, group: str | Sequence[str], value: str, partitions: int | None = None) -> DataFrame:
    """Per group (one or several columns) and distinct value: its count ``n``, the rows below it ``below`` and the group size ``total``.

    Equal values are counted before they move. The counts are range-sorted over all groups and written once, and a value's rank is the
    rows of its group in earlier ranges, one small sum a range and group, plus a running count inside its own range: however
    many rows a group holds, no task sees more than a range.
    """
    groups = [group] if isinstance(group, str) else list(group)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"))
    return _running(counted, groups, value, partitions=partitions)


def _running(counted: DataFrame, groups: Sequence[str], value: str, *others: str, partitions: int | None = None) -> DataFrame:
    """Distinct values of groups with their counts ``n``, with ``below`` and ``total`` added."""
    ranged = counted.repartitionByRange(*([partitions] if partitions else []), *groups, value)
    placed = stored(ranged.withColumn("__part", F.spark_partition_id()), "value-ranges")
    sums = placed.groupBy(*groups, "__part").agg(F.sum("n").alias("__size"))
    lower = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*groups, "__part", F.coalesce(F.sum("__size").over(lower), F.lit(0)).alias("__offset"),
                          F.sum("__size").over(Window.partitionBy(*groups)).alias("total"))
    inside = Window.partitionBy("__part", *groups).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("__before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = equi_join(running, offsets, ["__part", *groups])
    return joined.select(*groups, value, *others, "n", (F.col("__before") + F.col("__offset")).alias("below"), "total")


def _picked(ranked: DataFrame, group: str, value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Interpolated quantiles of the ranked values, ``n``, and ``__missed``: whether one of them lies in a gap."""
    places = {name: (F.col("total") - 1) * F.lit(float(q)) for name, q in quantiles.items()}

    def holds(rank: Column) -> Column:
        return (F.col("below") <= rank) & (rank < F.col("below") + F.col("n"))

    wanted = [(f"__{end.__name__}_{name}", holds(end(place))) for name, place in places.items() for end in (F.floor, F.ceil)]
    picked = ranked.groupBy(group).agg(
        F.max("total").alias("total"),
        F.max(~F.col("exact") & reduce(lambda a, b: a | b, [held for _, held in wanted])).alias("__missed"),
        *[F.max(F.when(held, F.col(value))).alias(name) for name, held in wanted])
    return picked.select(group, F.col("total").alias("n"), "__missed", *[
        (F.col(f"__floor_{name}") + (F.col(f"__ceil_{name}") - F.col(f"__floor_{name}")) * (place - F.floor(place))).alias(name)
        for name, place in places.items()])


def exact_quantiles(df: DataFrame, group: str, value: str, quantiles: Mapping[str, float], accuracy: int = ACCURACY) -> DataFrame:
    """Exact, linearly interpolated quantiles per group, in two passes over the values.

    A sketch of relative error ``1 / accuracy`` tells between which values each quantile lies.  The second pass counts the values there one
    by one and all others in bulk, so only a sliver of a large group is moved and sorted, in ranges, whatever its size.
    """
    return _refined(df, group, value, list(quantiles.values()), accuracy, False,
                    lambda ranked: _picked(ranked, group, value, quantiles))


def box_stats(df: DataFrame, group: str, value: str, accuracy: int = ACCURACY) -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 interquartile ranges) and number of outliers, in the same two passes."""
    def summarise(ranked: DataFrame) -> DataFrame:
        quartiles = _picked(ranked, group, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}).withColumnRenamed("n", "__rows")
        reach = 1.5 * (F.col("q3") - F.col("q1"))
        low, high = F.col("q1") - reach, F.col("q3") + reach
        # A gap lies within the whiskers' reach or outside as a whole, or the sketch was wrong.
        first, last = F.col("least").between(low, high), F.col(value).between(low, high)
        outside = (F.col(value) < low) | (F.col("least") > high)
        within = first & last
        fenced = equi_join(ranked, quartiles, [group])
        return fenced.groupBy(group, F.col("__rows").alias("n"), "q1", "median", "q3").agg(
            F.min(F.when(within, F.col("least"))).alias("whisker_low"),
            F.max(F.when(within, F.col(value))).alias("whisker_high"),
            F.sum(F.when(within, 0).otherwise(F.col("n"))).alias("outliers"),
            F.max(F.col("__missed") | (~F.col("exact") & ~within & ~outside)).alias("__missed"))

    return _refined(df, group, value, [0.25, 0.5, 0.75], accuracy, True, summarise)


def flow_counts(df: DataFrame, axes: Sequence[str], lump: str, keep: int = 5) -> DataFrame:
    """Counts by all axes, after the ``lump`` axis has been cut to its most frequent levels."""
    thinned = row_counts(df, *axes).withColumnRenamed("n", "copies")
    lumped = lump_levels(thinned, lump, keep, weight="copies")
    return lumped.groupBy(*axes).agg(F.sum("copies").alias("n"))
