"""Writers for each layer.

Partitioned writes use a rebalance on the partition columns rather than a
fixed round-robin repartition: rows of one day land together (few files per
folder), and adaptive execution splits a day that is much larger than the
others into several tasks instead of writing it from one.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

# Fixed value: the original flow's output file count for unpartitioned ingest
# writes (available through ``num_partitions``; not a default, since a fixed
# count cannot follow the data size).
INGEST_PARTITIONS = 8


def rebalance(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cluster rows by ``cols`` with skew splitting left to adaptive execution."""
    return df.hint("rebalance", *cols)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    num_partitions: int | None = None,
    mode: str = "overwrite",
    replace_partitions_only: bool = False,
) -> None:
    """Parquet, optionally partitioned into ``col=value`` folders.

    ``num_partitions`` spreads an unpartitioned write round-robin over that
    many files; without it each task writes its own partition as is. A
    partitioned write is rebalanced on its partition columns.

    ``replace_partitions_only`` overwrites just the partitions present in
    ``df`` (dynamic partition overwrite), so re-landing a few days leaves
    every other day untouched.
    """
    if partition_by:
        df = rebalance(df, partition_by)
    elif num_partitions:
        df = df.repartition(num_partitions)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if replace_partitions_only:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    replace_partitions_only: bool = False,
) -> None:
    """A managed catalog table (Parquet files), optionally partitioned.

    A plain overwrite replaces the whole table, as the silver job's full
    reload expects. With ``replace_partitions_only`` a partitioned table keeps
    every partition that ``df`` does not contain: the first such write creates
    the table with dynamic partition overwrite as a table option, and later
    ones insert-overwrite into it. A table created without that option is
    refused rather than silently replaced as a whole.
    """
    if partition_by:
        df = rebalance(df, partition_by)
    spark = df.sparkSession
    if replace_partitions_only:
        if not partition_by:
            raise ValueError("replace_partitions_only needs partition_by")
        if spark.catalog.tableExists(name):
            if not _overwrites_partitions_only(spark, name):
                raise ValueError(f"{name} was not created with replace_partitions_only; overwrite it whole first")
            df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
            return
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if replace_partitions_only:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.saveAsTable(name)


def _overwrites_partitions_only(spark, name: str) -> bool:
    """Whether the table stores dynamic partition overwrite as an option."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return any(
        r.col_name == "Storage Properties" and "partitionOverwriteMode=dynamic" in (r.data_type or "") for r in rows
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "overwrite",
    batch_size: int = 10_000,
    truncate: bool = False,
    max_connections: int | None = None,
) -> None:
    """Replace (or append to) a database table; one connection per task.

    ``truncate`` keeps an existing table (its grants, indexes and column
    types) and only empties it before an overwrite, instead of dropping and
    recreating it. ``max_connections`` caps the number of tasks writing at
    once (Spark coalesces the frame to that many partitions).
    """
    props = {"batchsize": str(batch_size), **(properties or {})}
    if truncate:
        props["truncate"] = "true"
    if max_connections:
        props["numPartitions"] = str(max_connections)
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", encoding: str = "UTF-8") -> None:
    """Header CSV (no index column); one file per task.

    Quotes are doubled, as ``read_csv`` expects. Text is written as it is: Spark's CSV writer would otherwise strip
    leading and trailing spaces, and padded codes are data here.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .csv(path)
    )
