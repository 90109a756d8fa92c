"""Silver job: validate and clean the bronze datasets, write valid tables and
quarantine tables.

Each dataset's valid and invalid sides are two filters of one scan plan;
writing both reads the (columnar) bronze input twice rather than caching a
whole dataset in executor memory. Orders are written into date folders,
rebalanced so that one busy day is split over several tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tillroll.operators.validation import SplitWrite
from tillroll.plans.layers import RetailLayers
from tillroll.schemas import DATE_PARTS, ORDERS_BRONZE
from tillroll.session import run_actions
from tillroll.sources.sinks import write_table
from tillroll.sources.tables import read_parquet


@dataclass(frozen=True)
class SilverTables:
    products: str = "default.products_partitioned"
    products_invalid: str = "default.products_invalid"
    orders: str = "default.orders_partitioned"
    orders_invalid: str = "default.orders_invalid"
    lines: str = "default.orders_line_partitioned"
    lines_invalid: str = "default.orders_line_invalid"


def _bronze_orders(spark: SparkSession, path: str):
    """Landed orders; a landing without any row has folders but no file."""
    try:
        return read_parquet(spark, path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return read_parquet(spark, path, schema=ORDERS_BRONZE)


def layers_from_bronze(spark: SparkSession, products_path: str, orders_path: str, lines_path: str) -> RetailLayers:
    """Lazy layers over landed Parquet (orders carry their date folders)."""
    return RetailLayers(
        products_raw=read_parquet(spark, products_path),
        orders_raw=_bronze_orders(spark, orders_path),
        lines_raw=read_parquet(spark, lines_path),
        orders_have_date_parts=True,
    )


def write_silver_counted(
    layers: RetailLayers, staging: str, tables: SilverTables = SilverTables(), max_parallel: int = 3
) -> dict[str, SplitWrite]:
    """``write_silver`` over splits that are written once under ``staging``,
    with the number of rows that failed each rule counted by those writes."""
    written, splits = layers.written(staging)
    write_silver(written, tables, max_parallel)
    return splits


def write_silver(layers: RetailLayers, tables: SilverTables = SilverTables(), max_parallel: int = 3) -> SilverTables:
    """Write the six silver tables as concurrent jobs.

    The frames are built on the calling thread first (the layers cache them),
    and only the writes run in the pool.
    """
    targets = [
        (layers.products, tables.products, None),
        (layers.products_invalid, tables.products_invalid, None),
        (layers.orders, tables.orders, DATE_PARTS),
        (layers.orders_invalid, tables.orders_invalid, None),
        (layers.lines, tables.lines, None),
        (layers.lines_invalid, tables.lines_invalid, None),
    ]
    run_actions(
        [lambda df=df, name=name, parts=parts: write_table(df, name, partition_by=parts) for df, name, parts in targets],
        max_parallel,
    )
    return tables
