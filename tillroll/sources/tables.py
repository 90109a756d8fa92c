"""Reading stored layers: Parquet directories, catalog tables and JDBC marts."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A Parquet directory; ``key=value`` sub-folders become partition columns.

    Selecting ``columns`` here (or later) prunes the scan to those columns;
    filters on partition columns prune whole folders. With ``schema`` a folder
    without any file (an empty partitioned write) reads as an empty frame.
    """
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table such as ``default.orders_partitioned``."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    columns: Sequence[str] | None = None,
    num_partitions: int | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
) -> DataFrame:
    """A table over JDBC. Credentials come from the caller, never from code.

    Marts are small, so one connection is the default; for a large table give
    a numeric ``partition_column`` with bounds to read in parallel ranges.
    Filters and column selections on the result are pushed into the SQL that
    Spark sends to the database.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column is not None:
        if None in (num_partitions, lower_bound, upper_bound):
            raise ValueError("partition_column needs num_partitions, lower_bound and upper_bound")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("numPartitions", num_partitions)
            .option("lowerBound", lower_bound)
            .option("upperBound", upper_bound)
        )
    df = reader.load()
    return df.select(*columns) if columns else df
