"""Scans.  Text columns are read as strings first and typed with ``try_cast``: inferring
types would turn fixed-width keys into numbers and lose their leading zeros."""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placeweave.functions.geometry import from_geojson, from_wkt
from placeweave.operators.rank import text_row_id
from placeweave.sources.records import numbered_records, text_lines, whole_records, without_return

MISSING_TEXT = "NA"
CSV_OPTIONS = {"nullValue": MISSING_TEXT, "escape": '"'}


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Type the named columns; text that does not parse becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def read_text_table(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    multiline: bool = False,
    encoding: str = "UTF-8",
    row_id: str | None = None,
    first: int = 1,
) -> DataFrame:
    """Delimited text with a header; every column is text unless ``types`` says otherwise.

    ``columns`` picks columns by header name, in any case and order.  Files of one path must share
    their header, which is checked.  ``multiline`` allows quoted line breaks: files are still read block by block
    (see ``sources.records``).  ``row_id`` adds a dense number in file order, from ``first``.
    """
    if multiline:
        return read_text_after_preamble(spark, path, columns, 0, types, True, encoding, row_id, first)
    df = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False, encoding=encoding, **CSV_OPTIONS)
    if row_id:
        df = text_row_id(df, row_id, first)
    return cast_columns(_picked(df, columns, row_id), types or {})


def _picked(df: DataFrame, columns: Sequence[str] | None, row_id: str | None = None) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(c) for c in [*columns, *([row_id] if row_id else [])]]) if columns else df


def _header_names(heading: str) -> list[str]:
    """Column names of a header line: nameless and repeated ones get their place, as Spark's own reader names them."""
    names = next(csv.reader([heading]))
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def read_text_after_preamble(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    skip: int = 0,
    types: Mapping[str, str] | None = None,
    multiline: bool = False,
    encoding: str = "UTF-8",
    row_id: str | None = None,
    first: int = 1,
) -> DataFrame:
    """Delimited text whose files each start with ``skip`` banner lines and then a header.

    A task reads the lines of a file block in order, so a line's place in a file's first block is its running
    id less the smallest of that block; the smallest ids are one row a file.  All of it stays on the JVM.
    Files whose header differs from the first file's, or that end before it, stop the job.
    With ``multiline`` or ``row_id`` the lines are written once and placed in all blocks; ``multiline`` then joins lines
    whose quotes span breaks, and a quote that is never closed stops the job.  Banner and header lines hold no breaks.
    """
    if encoding.upper() != "UTF-8" and not multiline:
        raise ValueError("encodings other than UTF-8 are read with multiline=True")
    text = spark.read.text(path)
    first_file = text.inputFiles()[0]
    top = [r["value"] for r in _top_lines(spark, first_file, skip + 1, encoding)]
    if len(top) <= skip:
        raise ValueError(f"{first_file}: no header after {skip} lines")
    heading = top[-1]
    names = _header_names(heading)
    if multiline or row_id:
        lines = text_lines(spark, path, encoding).filter(_conforming(
            (F.col("line") == skip) & (without_return(F.col("value")) != heading), (F.col("line") == 0) & (F.col("total") <= skip)))
        records = whole_records(lines, skip) if multiline else lines.filter(
            F.col("line") > skip).withColumn("value", without_return(F.col("value"))).filter(F.length("value") > 0)
        body = numbered_records(records, row_id, first) if row_id else records
    else:
        lines = text.select(
            "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("running"))
        begins = lines.filter(F.col("block") == 0).groupBy("file").agg(F.min("running").alias("first"), F.count(F.lit(1)).alias("begun"))
        placed = lines.join(F.broadcast(begins), "file").withColumn(  # one row a file
            "place", F.when(F.col("block") == 0, F.col("running") - F.col("first")))
        conforming = placed.filter(_conforming(
            (F.col("place") == skip) & (F.col("value") != heading), (F.col("place") == 0) & (F.col("begun") <= skip)))
        body = conforming.filter(F.coalesce(F.col("place") > skip, F.lit(True)) & (F.length("value") > 0))
    kept = [row_id] if row_id else []
    parsed = body.select(*kept, F.from_csv("value", string_schema(names).toDDL(), CSV_OPTIONS).alias("row")).select("row.*", *kept)
    return cast_columns(_picked(parsed, columns, row_id), types or {})


def _top_lines(spark: SparkSession, file: str, lines: int, encoding: str = "UTF-8") -> list:
    """The first ``lines`` lines of one file."""
    value = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.text(file, lineSep="\n").select(without_return(value).alias("value")).head(lines)


def _conforming(differs: Column, short: Column) -> Column:
    """A filter that stops the job at a file whose header is another one or missing."""
    faulty = F.raise_error(F.concat("file", F.lit(": no header like the first file's"))).cast("boolean")
    return F.when(F.coalesce(differs | short, F.lit(False)), faulty).otherwise(F.lit(True))


def unbalanced_quotes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Number of lines with an odd count of quotes, i.e. of quoted line breaks."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.text(path).agg(
        F.coalesce(F.sum((quotes % 2 == 1).cast("long")), F.lit(0)).alias("lines"))


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def read_vintages(
    spark: SparkSession,
    root: str,
    vintage_pattern: str,
    file_glob: str = "*.parquet",
    file_format: str = "parquet",
    schema: T.StructType | None = None,
    vintage_column: str = "year",
) -> DataFrame:
    """Every matching file below ``root`` in one scan, each row tagged with the vintage in its path.

    ``vintage_pattern`` is a regular expression with one group that captures the vintage.  Text files
    need a common header, which names the columns; vintages laid out differently are read one by one
    and stacked by name.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", file_glob)
    if schema is not None:
        reader = reader.schema(schema)
    if file_format == "csv":
        reader = reader.options(header="true", **({} if schema else {"enforceSchema": "false"}), **CSV_OPTIONS)
    df = reader.format(file_format).load(root)
    vintage = F.regexp_extract(F.col("_metadata.file_path"), vintage_pattern, 1).try_cast("int")
    return df.withColumn(vintage_column, vintage)


def read_wkt_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None, wkt_column: str, srid: int = 4269,
    encoding: str = "UTF-8",
) -> DataFrame:
    """A boundary table whose shapes are WKT text."""
    df = read_text_table(spark, path, columns, encoding=encoding)
    return (
        df.withColumn("geometry", from_wkt(wkt_column))
        .withColumn("srid", F.lit(srid))
        .drop(wkt_column)
    )


def read_geojson_features(
    spark: SparkSession, path: str, properties: Sequence[str], srid: int = 4269
) -> DataFrame:
    """Line-delimited GeoJSON features: the named properties as text plus the geometry."""
    features = spark.read.text(path)
    value = F.col("value")
    return features.select(
        *[F.get_json_object(value, f"$.properties.{p}").alias(p) for p in properties],
        from_geojson(F.get_json_object(value, "$.geometry")).alias("geometry"),
        F.lit(srid).alias("srid"),
    )


def distinct_dims(df: DataFrame, view: str, aliases: Mapping[str, str], order_by: Sequence[str]) -> DataFrame:
    """``SELECT DISTINCT column AS alias, … ORDER BY …`` over a registered view."""
    df.createOrReplaceTempView(view)
    columns = ", ".join(f"`{c}` AS `{a}`" for c, a in aliases.items())
    order = ", ".join(f"`{c}` ASC NULLS LAST" for c in order_by)
    return df.sparkSession.sql(f"SELECT DISTINCT {columns} FROM `{view}` ORDER BY {order}")


# --- column names -----------------------------------------------------------

def lower_names(df: DataFrame) -> DataFrame:
    names = [c.lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide once lower-cased: {df.columns}")
    return df.toDF(*names)


def replace_in_names(df: DataFrame, pattern: str = r"\s", replacement: str = "_") -> DataFrame:
    return df.toDF(*[re.sub(pattern, replacement, c) for c in df.columns])


def names_containing(df: DataFrame, text: str) -> DataFrame:
    return df.select([f"`{c}`" for c in df.columns if text in c])


def front(df: DataFrame, *columns: str) -> DataFrame:
    """Move the named columns to the front."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*[f"`{c}`" for c in (*columns, *rest)])


def select_as(df: DataFrame, **new_from_old: str) -> DataFrame:
    """``select_as(df, new="old")``: project, rename and reorder in one step."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in new_from_old.items()])
