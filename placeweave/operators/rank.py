"""Per-group extremes, frequency ranks, standard scores and row ids.

A group may hold a large share of the table, so nothing here sorts a whole group in one task:
extremes and moments are partial aggregates joined back, frequency ranks work on level counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeweave.operators.joins import equi_join
from placeweave.session import counted_side, pinned, scratch_folder, stored


def highest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows holding the largest ``order`` of their key, ties kept; an all-missing group is kept whole.

    A rank window would bring every tied row of a hot key to one task.  The extreme is a partial
    aggregate instead, and the semi-join back leaves hot keys splittable.
    """
    return _extreme_per_key(df, keys, order, F.max(order))


def lowest_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """As ``highest_per_key`` for the smallest value."""
    return _extreme_per_key(df, keys, order, F.min(order))


def _extreme_per_key(df: DataFrame, keys: Sequence[str], order: str, extreme: Column) -> DataFrame:
    best = df.groupBy(*keys).agg(extreme.alias("__best"))
    return equi_join(df, best, [*keys, (order, "__best")], "left_semi")


def standard_scores(df: DataFrame, group: str, value: str, score: str) -> DataFrame:
    """(value − group mean) / group sample deviation; null for one-row or constant groups."""
    moments = df.groupBy(group).agg(
        F.avg(value).alias("__mean"), F.stddev_samp(value).alias("__deviation"))
    joined = equi_join(df, counted_side(moments), [group], "left")
    deviation = F.nullif(F.col("__deviation"), F.lit(0.0))
    return joined.withColumn(score, (F.col(value) - F.col("__mean")) / deviation).drop("__mean", "__deviation")


def level_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows per level, or the sum of ``weight`` where rows stand for several."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(n.alias("n"))


def frequency_order(df: DataFrame, column: str, position: str = "position") -> DataFrame:
    """Levels with their count and place by falling count (1-based), ties by name; missing is no level."""
    counts = level_counts(df, column)
    return ordered_row_id(counts, [F.col("n").desc(), F.col(column).asc()], position)


def lump_levels(df: DataFrame, column: str, keep: int, other: str = "Other",
                weight: str | None = None) -> DataFrame:
    """Keep the ``keep`` most frequent levels and write the rest as ``other``.

    Ties at the last place are all kept, and nothing is lumped where at most one level would be:
    a lone rare level keeps its name.  Missing values stay missing.
    """
    counts = pinned(level_counts(df, column, weight))
    cutoff = counts.orderBy(F.col("n").desc()).limit(keep).agg(F.min("n").alias("cutoff"))
    spared = counts.agg(
        (F.count(F.when(F.col("n") < cutoff.scalar(), 1)) <= 1).alias("spared"))
    kept = counts.filter((F.col("n") >= cutoff.scalar()) | spared.scalar())
    kept = kept.select(F.col(column).alias("__level"), F.lit(True).alias("__kept"))
    joined = df.join(counted_side(kept), F.col(column) == F.col("__level"), "left")
    lumped = F.when(F.col("__kept") | F.col(column).isNull(), F.col(column)).otherwise(F.lit(other))
    return joined.withColumn(column, lumped).drop("__level", "__kept")


def file_order(file: Column) -> list[Column]:
    """Files in the order of the numbers in their names (part-99999 before part-100000), then by name."""
    padded = F.regexp_replace(F.regexp_replace(file, "([0-9]+)", "00000000000000000000$1"), "[0-9]*([0-9]{20})(?![0-9])", "$1")
    return [padded, file]


def scan_row_id(df: DataFrame, row_id: str = "rowid", first: int = 1) -> DataFrame:
    """Dense row number in file order, for a frame read directly from Parquet.

    The reader knows each row's place in its file; only the per-file row counts are accumulated and
    broadcast, so no row is shuffled or passes through Python. The counts are one row per file of
    a listing the driver holds anyway.
    """
    located = df.select(
        "*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    sizes = located.groupBy("__file").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(*file_order(F.col("__file"))).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return (
        equi_join(located, F.broadcast(offsets), ["__file"], missing_matches=False)
        .withColumn(row_id, F.col("__offset") + F.col("__index") + first)
        .drop("__file", "__index", "__offset")
    )


def ordered_row_id(df: DataFrame, order: Sequence[Column], row_id: str = "rowid", first: int = 1) -> DataFrame:
    """Dense row number by a total order, without one global sort task.

    The frame is range-sorted and written once, each row with its partition's number and its place in it.
    The number is then the rows of earlier partitions, one small sum a partition, plus the place.
    """
    path = scratch_folder(df.sparkSession, "ordered")
    running = F.monotonically_increasing_id()  # the partition above, the place in it in the low 33 bits
    placed = df.orderBy(*order).withColumn("__running", running)
    placed.write.parquet(path)
    written = df.sparkSession.read.schema(placed.schema).parquet(path).withColumn("__part", F.shiftright("__running", 33))
    return _numbered(written, F.col("__running").bitwiseAND((1 << 33) - 1), row_id, first).drop("__running")


def _numbered(written: DataFrame, place: Column, row_id: str, first: int) -> DataFrame:
    """``first`` plus the rows of earlier ``__part`` numbers plus the row's ``place`` in its own."""
    sizes = written.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    return (
        equi_join(written, F.broadcast(offsets), ["__part"], missing_matches=False)  # one row a partition
        .withColumn(row_id, F.col("__offset") + place + first)
        .drop("__part", "__offset")
    )


def text_row_id(df: DataFrame, row_id: str = "rowid", first: int = 1) -> DataFrame:
    """``scan_row_id`` for a frame read directly from text files, whose reader gives no row positions.

    A block is read in order by one task, so a row's place in its block is its running id less the block's smallest one, and the rows of
    earlier files and blocks come on top: one sum a block. The rows are written once and neither sorted nor shuffled.
    """
    located = stored(df.select(
        "*", F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__running")), "text-rows")
    sizes = located.groupBy("__file", "__block").agg(
        F.first("__path").alias("__path"), F.min("__running").alias("__begin"), F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(*file_order(F.col("__path")), "__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted_side(sizes.select("__file", "__block", "__begin", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")))
    return (
        equi_join(located.drop("__path"), offsets, ["__file", "__block"], missing_matches=False)
        .withColumn(row_id, F.col("__offset") + F.col("__running") - F.col("__begin") + first)
        .drop("__file", "__block", "__running", "__begin", "__offset")
    )


def seeded_sample(df: DataFrame, n: int, key: Sequence[str], seed: str) -> DataFrame:
    """``n`` rows in an order drawn from ``seed``: the same rows on every run."""
    draw = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(seed)))
    return df.orderBy(draw, *key).limit(n)
