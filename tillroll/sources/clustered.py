"""Tables clustered by several columns, and point reads that open few files.

Rows are range-partitioned and sorted by an interleaved key: the first
character of every column, then the second of every column, and so on. Rows
near each other in any of the columns are near each other in the files, so the
least and greatest value of each column in each file rule most files out,
whichever column a read asks for. These bounds are stored beside the data, so
that a read opens only the files that may have the value.
"""

from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A folder that readers of the data skip.
BOUNDS_FOLDER = "_bounds"
KEY_WIDTH = 8


def interleaved_key(columns: Sequence[str], width: int = KEY_WIDTH) -> Column:
    """Characters of all columns in turn; shorter texts are filled up with
    blanks, null is empty. Each column's order is kept within the others'."""
    padded = [F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("")), width, " ") for c in columns]
    return F.concat(*[F.substring(p, i, 1) for i in range(1, width + 1) for p in padded])


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], files: int | None = None) -> None:
    """Write ``df`` clustered by ``columns``, in ``files`` files (or as many as
    the session's shuffle settings make of it).

    A value with a large share of all rows is spread by the other columns;
    only rows equal in all of them stay together.
    """
    key = interleaved_key(columns)
    tagged = df.withColumn("_key", key)
    dealt = tagged.repartitionByRange(files, "_key", *columns) if files else tagged.repartitionByRange("_key", *columns)
    dealt.sortWithinPartitions("_key", *columns).drop("_key").write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns]
    bounds = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(*ends, *nulls)
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BOUNDS_FOLDER}")


def files_with(spark: SparkSession, path: str, **equals: Any) -> list[str]:
    """Files that may hold rows with these values (their paths go to the reader)."""
    bounds = spark.read.parquet(f"{path}/{BOUNDS_FOLDER}")
    for c, value in equals.items():
        if value is None:
            bounds = bounds.filter(F.col(f"nulls_{c}") > 0)
        else:
            bounds = bounds.filter((F.col(f"least_{c}") <= F.lit(value)) & (F.col(f"most_{c}") >= F.lit(value)))
    return [f"{path}/{r[0]}" for r in bounds.select("file").collect()]


def read_where(spark: SparkSession, path: str, **equals: Any) -> DataFrame:
    """All rows whose columns have the given values (None: null)."""
    schema = spark.read.parquet(path).schema
    files = files_with(spark, path, **equals)
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    for c, value in equals.items():
        rows = rows.filter(F.col(c).isNull() if value is None else F.col(c) == F.lit(value))
    return rows
