"""What the inner joins of the sales lines keep and lose.

Every valid line has one outcome:

* ``without_order`` - its invoice has no valid order (whatever its product);
* ``without_product`` - it has an order, but its code has no product;
* ``fanned_out`` - it is sold, on several order rows of one invoice, and
  stands in the sales as often;
* ``sold`` - it stands in the sales once.

The outcomes' lines add up to the valid lines, and their ``sales_rows`` to the
rows of ``marts.sales_lines``.

Lines are shuffled once, by invoice. The join key is put into a struct: the
order counts, which an aggregation has just dealt out by invoice, are then
shuffled for the join as well, and adaptive execution can split an invoice with
a large share of all lines. The report meets the products only after adding
lines up by code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTCOMES = ("sold", "fanned_out", "without_order", "without_product")


def _with_order_rows(lines: DataFrame, orders: DataFrame) -> DataFrame:
    copies = orders.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("order_rows"))
    copies = copies.select(F.struct(F.col("InvoiceNo").alias("k")).alias("_key"), "order_rows")
    keyed = lines.withColumn("_key", F.struct(F.col("InvoiceNo").alias("k")))
    return keyed.join(copies, "_key", "left").drop("_key").withColumn("order_rows", F.coalesce("order_rows", F.lit(0)).cast("bigint"))


def _outcome() -> Column:
    return (
        F.when(F.col("order_rows") == 0, F.lit("without_order"))
        .when(F.col("_known").isNull(), F.lit("without_product"))
        .when(F.col("order_rows") > 1, F.lit("fanned_out"))
        .otherwise(F.lit("sold"))
    )


def _known_codes(products: DataFrame) -> DataFrame:
    return products.select("StockCode").distinct().withColumn("_known", F.lit(True))


def line_outcomes(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Every line with its ``outcome`` and ``order_rows`` (how many valid order
    rows its invoice has)."""
    found = _with_order_rows(lines, orders).join(_known_codes(products), "StockCode", "left")
    return found.withColumn("outcome", _outcome()).drop("_known").select(*lines.columns, "order_rows", "outcome")


def lost_lines(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The lines that the sales lose, with the reason as ``outcome``."""
    return line_outcomes(lines, orders, products).filter(F.col("outcome").startswith("without")).drop("order_rows")


def loss_report(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Per outcome its lines, their quantity and the sales rows they make."""
    by_code = (
        _with_order_rows(lines, orders)
        .groupBy("StockCode", F.least("order_rows", F.lit(2)).alias("order_rows"))
        .agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("Quantity").alias("quantity"),
            F.sum("order_rows").alias("sales_rows"),
        )
    )
    outcome = _outcome().alias("outcome")
    kept = F.when(F.col("_known").isNull(), F.lit(0)).otherwise(F.col("sales_rows"))
    return (
        by_code.join(_known_codes(products), "StockCode", "left")
        .groupBy(outcome)
        .agg(
            F.sum("n_lines").alias("n_lines"),
            F.sum("quantity").cast("bigint").alias("quantity"),
            F.sum(kept).cast("bigint").alias("sales_rows"),
        )
    )
