"""Lines of text files and the records they make up, where quoted cells may hold line breaks.

Files are read block by block in parallel.  A line's place in its file is the lines of earlier blocks plus
its place in its own; whether it begins inside quotes follows from how many lines with an odd number of
quotes come before it.  Such lines are few: only they are numbered, in pairs that open and close a record,
and only the lines between the two of a pair are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placeweave.operators.joins import equi_join
from placeweave.operators.rank import file_order
from placeweave.session import counted_side, stored

SPAN_CELL = 64  # lines; a record of several lines is looked up by the cells it covers
NUMBER_CELL = 4096  # lines; records are numbered inside a cell, cells by their counts
BREAK = "\n"


def text_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """``file``, ``block``, ``line`` (place in the file, from 0), ``total`` (lines of the file) and ``value`` of every line.

    The lines are written once, so that blocks are cut the same way for every later use.  ``encoding`` must
    write line breaks and quotes as ASCII does.
    """
    value = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    located = stored(spark.read.text(path, lineSep=BREAK).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("running"), value.alias("value")), "lines")
    sizes = located.groupBy("file", "block").agg(F.min("running").alias("begin"), F.count(F.lit(1)).alias("lines"))
    of_file = Window.partitionBy("file")
    offsets = counted_side(sizes.select(  # one row a block
        "file", "block", "begin", F.sum("lines").over(of_file).alias("total"),
        F.coalesce(F.sum("lines").over(_before(of_file, "block")), F.lit(0)).alias("offset")))
    placed = equi_join(located, offsets, ["file", "block"], missing_matches=False)
    return placed.select("file", "block", (F.col("offset") + F.col("running") - F.col("begin")).alias("line"), "total", "value")


def _before(window, *order):
    return window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _spans(lines: DataFrame, after: int) -> DataFrame:
    """``file``, ``first`` and ``last`` line of every record of several lines; a quote that is never closed stops the job."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    odd = stored(lines.filter((F.col("line") > after) & (quotes % 2 == 1)).select("file", "block", "line"), "quotes")
    of_file = Window.partitionBy("file")
    earlier = odd.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(_before(of_file, "block")), F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("file", "block").orderBy("line")) - 1
    numbered = equi_join(odd.withColumn("place", place), earlier, ["file", "block"], missing_matches=False)
    pairs = numbered.groupBy("file", F.floor((F.col("earlier") + F.col("place")) / 2).alias("pair")).agg(
        F.min("line").alias("first"), F.max("line").alias("last"), F.count(F.lit(1)).alias("ends"))
    unclosed = F.raise_error(F.concat("file", F.lit(": a quote opened in line "), F.col("first") + 1, F.lit(" is never closed"))).cast("boolean")
    return pairs.filter(F.when(F.col("ends") < 2, unclosed).otherwise(F.lit(True))).select("file", "first", "last")


def whole_records(lines: DataFrame, after: int = -1) -> DataFrame:
    """``file``, ``line`` (where it begins) and ``value`` of every record below line ``after``; empty lines are none.

    A quote counts wherever it stands: cells with quotes of their own must be quoted.  Breaks inside quotes
    come back as they were written.
    """
    cell = lambda line: F.floor(F.col(line) / SPAN_CELL)
    spans = counted_side(_spans(lines, after).select(
        F.col("file").alias("in_file"), "first", "last", F.explode(F.sequence(cell("first"), cell("last"))).alias("cell")))
    body = lines.filter(F.col("line") > after)
    marked = body.join(
        spans, (F.col("file") == F.col("in_file")) & (cell("line") == F.col("cell")) & F.col("line").between(F.col("first"), F.col("last")), "left")
    single = marked.filter(F.col("first").isNull()).select("file", "line", "value")
    parts = F.array_sort(F.collect_list(F.struct("line", "value")))
    several = marked.filter(F.col("first").isNotNull()).groupBy("file", "first").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), BREAK).alias("value")).withColumnRenamed("first", "line")
    return single.unionByName(several).withColumn("value", without_return(F.col("value"))).filter(F.length("value") > 0)


def without_return(value):
    """A line without the carriage return of a two-character line break."""
    return F.when(F.endswith(value, F.lit("\r")), F.left(value, F.length(value) - 1)).otherwise(value)


def numbered_records(records: DataFrame, row_id: str, first: int = 1) -> DataFrame:
    """``records`` with dense numbers: files in the order of the numbers in their names, records as they stand in them.

    Counts a cell of lines are added up within each file, files by their totals; rows are sorted inside a cell only.
    """
    kept = stored(records.withColumn("cell", F.floor(F.col("line") / NUMBER_CELL)), "records")
    counts = kept.groupBy("file", "cell").agg(F.count(F.lit(1)).alias("n"))
    files = counts.groupBy("file").agg(F.sum("n").alias("n")).select(  # one row a file, as in the listing the driver holds
        "file", F.coalesce(F.sum("n").over(_before(Window, *file_order(F.col("file")))), F.lit(0)).alias("files_before"))
    before = equi_join(counts, files, ["file"], missing_matches=False).select(
        "file", "cell", (F.col("files_before") + F.coalesce(F.sum("n").over(_before(Window.partitionBy("file"), "cell")), F.lit(0))).alias("before"))
    place = F.row_number().over(Window.partitionBy("file", "cell").orderBy("line")) - 1
    placed = equi_join(kept.withColumn("place", place), before, ["file", "cell"], missing_matches=False)
    return placed.withColumn(row_id, F.col("before") + F.col("place") + first).drop("cell", "place", "before")
