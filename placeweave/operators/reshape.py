"""Unions, wide/long reshaping and missing-value handling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stack_rows(*frames: DataFrame, fill: bool = False) -> DataFrame:
    """Bind rows by column name; ``fill`` adds columns a frame lacks as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill), frames)


def wide_to_long(df: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None,
                 variable: str = "variable", value: str = "value") -> DataFrame:
    """One row per key and value column; missing values stay."""
    columns = list(values) if values is not None else [c for c in df.columns if c not in keys]
    return df.unpivot(list(keys), columns, variable, value)


def long_to_flags(df: DataFrame, key: str, variable: str, levels: Sequence) -> DataFrame:
    """One boolean column per level: does the key occur with that level?  Absent cells are false.

    A (key, level) pair occurring twice is an error, as it is when spreading to cells.
    """
    def cell(level):
        n = F.count(F.when(F.col(variable) == F.lit(level), 1))
        twice = F.raise_error(F.concat(
            F.lit(f"duplicate cell {level} for key "), F.col(key).cast("string"))).cast("boolean")
        return F.when(n > 1, twice).otherwise(n == 1).alias(str(level))

    return df.groupBy(key).agg(*[cell(level) for level in levels])


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns (all by default)."""
    return df.na.drop(subset=list(columns) if columns else None)


def fill_booleans(df: DataFrame, value: bool = False) -> DataFrame:
    """Fill missing values of every boolean column."""
    booleans = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.fillna(value, subset=booleans) if booleans else df


def recode(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace values found in ``mapping``; others stay as they are."""
    return df.replace(dict(mapping), subset=[column])


def map_columns(df: DataFrame, columns: Sequence[str], function) -> DataFrame:
    """Apply one column function to each named column."""
    return df.withColumns({c: function(F.col(c)) for c in columns})
