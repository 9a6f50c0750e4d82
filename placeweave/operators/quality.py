"""Checks.  Each returns one row ``(check, subject, passed, value)``; ``require`` raises on a failure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.operators.aggregate import is_missing, repeated_keys
from placeweave.operators.joins import absent_from, member_flag
from placeweave.operators.reshape import stack_rows


def _row(df: DataFrame, check: str, subject: str, passed: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(subject).alias("subject"),
        passed.alias("passed"), value.cast("double").alias("value"))


def unique_key(df: DataFrame, keys: Sequence[str], subject: str) -> DataFrame:
    """No key occurs twice; the value is the number of repeated keys."""
    n = repeated_keys(df, *keys).agg(F.count(F.lit(1)).alias("n"))
    return _row(n, "unique_key", subject, F.col("n") == 0, F.col("n"))


def no_duplicate_rows(df: DataFrame, subject: str) -> DataFrame:
    """The value is the number of surplus rows."""
    surplus = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return _row(surplus, "no_duplicate_rows", subject, F.col("n") == 0, F.col("n"))


def same_row_count(a: DataFrame, b: DataFrame, subject: str) -> DataFrame:
    """Both frames have as many rows; the value is the difference."""
    rows = a.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") - b.agg(F.count(F.lit(1)).alias("n")).scalar()).alias("d"))
    return _row(rows, "same_row_count", subject, F.col("d") == 0, F.col("d"))


def no_fan_out(joined: DataFrame, left: DataFrame, right: DataFrame, keys: Sequence[str], subject: str) -> DataFrame:
    """The right key is unique and the join kept the left row count."""
    return stack_rows(
        unique_key(right, keys, f"{subject}: right key"), same_row_count(joined, left, f"{subject}: rows"))


def surviving_share(result: DataFrame, source: DataFrame, subject: str, at_least: float = 1.0) -> DataFrame:
    """Share of the source rows that an inner join kept."""
    kept = result.agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("n") / F.nullif(source.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(0))).alias("share"))
    return _row(kept, "surviving_share", subject, F.col("share") >= at_least, F.col("share"))


def key_coverage(df: DataFrame, key: str, known: DataFrame, known_key: str, subject: str,
                 at_least: float = 1.0) -> DataFrame:
    """Share of rows whose key is known."""
    counted = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    flagged = member_flag(counted, "__key", known, known_key, "__hit")
    rate = flagged.agg(
        (F.sum(F.when(F.col("__hit"), F.col("__n")).otherwise(0)) / F.sum("__n")).alias("rate"))
    return _row(rate, "key_coverage", subject, F.col("rate") >= at_least, F.col("rate"))


def missing_share(df: DataFrame, column: str, subject: str, at_most: float = 0.0) -> DataFrame:
    rate = df.agg(F.avg(is_missing(df, column).cast("double")).alias("rate"))
    return _row(rate, "missing_share", subject, F.col("rate") <= at_most, F.col("rate"))


def count_of(df: DataFrame, check: str, subject: str, expected: int = 0) -> DataFrame:
    """Number of rows of a listing, such as renamed entities, against an expected number."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return _row(n, check, subject, F.col("n") == expected, F.col("n"))


def unmatched(regions: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """Regions without a single row in the crosswalk."""
    return absent_from(regions, crosswalk, [key])


def require(report: DataFrame) -> DataFrame:
    """The report, raising at run time on the first failed check."""
    message = F.concat_ws(" ", F.lit("check failed:"), "check", "subject", F.col("value").cast("string"))
    return report.withColumn(
        "passed", F.when(F.col("passed"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
