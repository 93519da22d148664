"""Checks that report and do not stop a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_keys(
    df: DataFrame, keys: Sequence[str] = (), day: str = "local_date"
) -> DataFrame:
    """The days that have more than one row, with their row count."""
    return df.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def duplicate_count(
    df: DataFrame, keys: Sequence[str] = (), day: str = "local_date"
) -> DataFrame:
    """One row: how many days have more than one row."""
    return duplicate_keys(df, keys, day).agg(F.count(F.lit(1)).alias("duplicate_days"))


def undated(df: DataFrame, day: str = "local_date") -> DataFrame:
    """One row: how many records have no date and so reach no daily table."""
    return df.agg(F.count_if(F.col(day).isNull()).alias("undated_rows"))


def undated_by_table(raw: Mapping[str, DataFrame], day: str = "local_date") -> DataFrame:
    """The same count for each raw table that has a date."""
    counts = [
        undated(df, day).select(F.lit(table).alias("source_table"), "undated_rows")
        for table, df in raw.items()
        if day in df.columns
    ]
    return reduce(DataFrame.unionByName, counts)


def keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many records lack a key and so reach no series."""
    lacks = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys), F.lit(False))
    return df.agg(F.count_if(lacks).alias("keyless_rows"))


def keyless_by_table(raw: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """The same count for each raw table."""
    counts = [
        keyless(df, keys).select(F.lit(table).alias("source_table"), "keyless_rows") for table, df in raw.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def file_order(stored: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """One row: the rows of a stored table, and how many of its files begin before the one before
    them ends. Sees one row per file; files may share the value that they meet at."""
    place = F.struct(*sort_by)
    files = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n")
    )
    before = F.lag("last").over(Window.orderBy("first", "last"))
    return files.select("n", (before > F.col("first")).alias("overlaps")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if("overlaps").alias("overlapping_files")
    )
