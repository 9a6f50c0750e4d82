"""Writers.  Each writes a folder of part files; sorting belongs here, not into the builds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions.geometry import to_wkt


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_text_table(df: DataFrame, path: str) -> None:
    """Delimited text with a header; missing values are written as ``NA``."""
    df.write.mode("overwrite").csv(path, header=True, nullValue="NA", emptyValue='""', escape='"')


def wkt_table(df: DataFrame, key: str, geometry: str = "geometry", digits: int | None = None) -> DataFrame:
    """Key and WKT text side by side, ready for a text sink."""
    return df.select(key, to_wkt(geometry, digits).alias(f"{geometry}_wkt"))


def write_features(df: DataFrame, path: str, key: str, geometry: str = "geometry") -> None:
    """Shapes as a Parquet struct below ``shapes`` and as WKT text below ``wkt``."""
    write_parquet(df, f"{path}/shapes")
    write_text_table(wkt_table(df, key, geometry), f"{path}/wkt")


def sorted_for_sink(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending, missing last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])
