"""Gold job: join the silver tables once and build the four marts.

Strategies (``strategy=``):

* ``"one_pass"`` (default) - the lines, joined to their orders, go through a
  single ``GROUPING SETS`` aggregation per stock code; its partial rows meet
  the products and are added up to all four marts' measures. Only that small
  result (one row per country, product and day) is written to the shared
  scratch folder (``spark.checkpoint.dir``) and cut into the marts. The
  line-level join runs once, and no line is written or shuffled by stock code.
* ``"reuse_sales"`` - the mart columns of the joined lines are written once
  as Parquet and the four marts aggregate that (column-pruned) copy.
* ``"recompute"`` - each mart re-runs both joins (the original job's plan;
  kept for comparison in the benchmark).

Writing to the checkpoint folder cuts the lineage, so a lost executor only
re-runs tasks of the current stage. Marts are written unsorted, since a
stored table keeps no row order; readers sort.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import marts
from tillroll.plans.layers import RetailLayers
from tillroll.plans.silver import SilverTables
from tillroll.session import materialize, run_actions
from tillroll.sources.sinks import write_jdbc, write_table
from tillroll.sources.tables import read_table

MartWriter = Callable[[str, DataFrame], None]


def layers_from_silver(spark: SparkSession, tables: SilverTables = SilverTables()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(lines, orders, products)`` as stored by the silver job."""
    return read_table(spark, tables.lines), read_table(spark, tables.orders), read_table(spark, tables.products)


STRATEGIES = ("one_pass", "reuse_sales", "recompute")


def build_marts(
    lines: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    strategy: str = "one_pass",
) -> dict[str, DataFrame]:
    """The four marts from the silver lines, orders and product master."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if strategy == "one_pass":
        measures = materialize(marts.mart_measures(lines, orders, products), "mart-measures")
        return marts.marts_from_measures(measures)
    sales = marts.sales_lines(lines, orders, products).select(*marts.MART_INPUT_COLUMNS)
    if strategy == "reuse_sales":
        sales = materialize(sales, "sales")
    return marts.all_marts(sales)


def build_marts_from_layers(layers: RetailLayers, strategy: str = "one_pass") -> dict[str, DataFrame]:
    return build_marts(layers.lines, layers.orders, layers.products, strategy=strategy)


def table_writer(database: str = "default") -> MartWriter:
    return lambda name, df: write_table(df, f"{database}.{name}")


def jdbc_writer(url: str, properties: dict[str, str], truncate: bool = False) -> MartWriter:
    return lambda name, df: write_jdbc(df, url, name, properties, truncate=truncate)


def write_gold(built: dict[str, DataFrame], writer: MartWriter, max_parallel: int = 4) -> list[str]:
    """Write the marts as concurrent jobs (they read the same small measures).

    Stored rows have no order; readers sort (``serving.sorted_mart``).
    """
    run_actions([lambda n=name, df=df: writer(n, df) for name, df in built.items()], max_parallel)
    return list(built)
