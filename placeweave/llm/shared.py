"""What several operators of this subpackage share: reading tables, cutting lineage, text hashes."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from textwrap import dedent

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.session import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its name, with the SQL that yields the same rows (if SQL can)."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = dedent(sql).strip()
        return function
    return register


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts the lineage, so a lost executor costs one task and never the whole chain, and gives every
    later use the same rows. Unlike ``checkpoint()`` the table is columnar: later reads prune it.
    """
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def slices(batches: Iterator[pd.DataFrame], rows: int = 256) -> Iterator[pd.DataFrame]:
    """Arrow batches in smaller frames, so that what a task makes of them stays small whatever the batch size."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.iloc[start:start + rows]
