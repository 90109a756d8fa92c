"""Gold layer: the joined sales lines and the four marts built from them.

Join plan. ``lines`` is the fact table and is the only frame whose size is
in the order of the input; ``orders`` is large as well, ``products`` is one
row per stock code. The line/order join is a shuffle join on ``InvoiceNo``;
with adaptive execution on, a hot invoice is split across tasks by the
skew-join rule instead of landing on one task. ``mart_measures`` meets the
products only after adding lines up per stock code; ``sales_lines``, which
returns the lines themselves, joins them line by line. A product join is broadcast
only under a size bound: with the session settings of ``tillroll.session``
(static auto-broadcast off) adaptive execution converts the shuffle join once
the product master's measured size is under its threshold.

Semantics kept on purpose:

* ``number_of_orders`` / ``number_of_sales`` / ``number_of_returns`` count
  joined *lines*, not distinct invoices.
* An invoice that appears on several valid order rows multiplies its lines
  (inner join fan-out); nothing is deduplicated behind the caller's back.
* Line ``StockCode`` is not trimmed, so a padded line code matches no product.
* A negative line on a non-cancelled invoice counts in the sales marts (and
  nets off) and in the returns mart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import DATE_PARTS

# Columns of the sales frame that the four marts read.
MART_INPUT_COLUMNS = [
    "StockCode",
    "Description",
    "Quantity",
    "Amount",
    "Country",
    "IsCancel",
    *DATE_PARTS,
]


def sales_lines(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Valid lines joined to cleaned orders and the product master, plus ``Amount``.

    ``Amount = Quantity * UnitPrice`` where ``UnitPrice`` is the product's mean
    price, not a price recorded on the line.
    """
    joined = lines.join(orders, "InvoiceNo")
    return joined.join(products, "StockCode").withColumn("Amount", F.col("Quantity") * F.col("UnitPrice"))


def _not_cancelled() -> Column:
    return ~F.col("IsCancel")


def _is_return() -> Column:
    return (F.col("Quantity") < 0) | F.col("IsCancel")


def _line_count(alias: str) -> Column:
    # Every joined line has a non-NULL InvoiceNo (inner join key), so this is
    # the count of joined lines; counting a literal lets the materialised
    # sales frame omit the invoice column.
    return F.count(F.lit(1)).alias(alias)


def sales_per_country(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(_not_cancelled())
        .groupBy("Country")
        .agg(
            F.sum("Amount").alias("total_sales"),
            _line_count("number_of_orders"),
            F.sum("Quantity").alias("total_quantity"),
        )
    )


def top_products(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(_not_cancelled())
        .groupBy("StockCode", "Description")
        .agg(
            F.sum("Amount").alias("total_revenue"),
            F.sum("Quantity").alias("total_quantity_sold"),
            _line_count("number_of_sales"),
        )
    )


def return_products(sales: DataFrame) -> DataFrame:
    """Lines that are cancelled or have a negative quantity, per product."""
    return (
        sales.filter(_is_return())
        .groupBy("StockCode", "Description")
        .agg(
            F.sum("Quantity").alias("total_returned"),
            _line_count("number_of_returns"),
            F.sum("Amount").alias("total_loss"),
        )
    )


def sales_by_period(sales: DataFrame) -> DataFrame:
    return (
        sales.filter(_not_cancelled())
        .groupBy(*DATE_PARTS)
        .agg(
            F.sum("Amount").alias("total_sales"),
            _line_count("number_of_orders"),
            F.sum("Quantity").alias("total_quantity"),
        )
    )


MART_BUILDERS = {
    "sales_per_country": sales_per_country,
    "top_products": top_products,
    "return_products": return_products,
    "sales_by_period": sales_by_period,
}


def all_marts(sales: DataFrame) -> dict[str, DataFrame]:
    """The four marts over one sales frame (lazy; callers decide on reuse)."""
    return {name: build(sales) for name, build in MART_BUILDERS.items()}


# ---------------------------------------------------------------------------
# All four marts in one aggregation.
#
# A line's amount depends only on its quantity and its code's price. Lines are
# therefore first added up by country, day and stock code (``daily_sums``: at
# most one row a line, folded map-side), and only these rows meet the products
# and are cut into the marts' three groupings by ``GROUPING SETS``: no line is
# expanded or shuffled by stock code, and quantities stay exact integers until
# they are multiplied by the price. Sales and return measures are conditional
# aggregates side by side; a group belongs to a mart only if that mart's
# filter kept at least one of its lines. The sums of other days can be added
# to them later (``tillroll.plans.incremental``).

SUM_KEYS = ["Country", *DATE_PARTS, "StockCode"]
_SET_KEYS = {"country": ["Country"], "product": ["StockCode", "Description"], "day": list(DATE_PARTS)}
_ALL_KEYS = [*SUM_KEYS, "Description"]


def _grouping_id(set_name: str) -> int:
    """``grouping_id()`` of a set: bit i is 1 when key i is not grouped."""
    gid = 0
    for key in _ALL_KEYS:
        gid = (gid << 1) | (0 if key in _SET_KEYS[set_name] else 1)
    return gid


def daily_sums(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Sold and returned lines and quantities per country, day and stock code."""
    sold = _not_cancelled()
    returned = _is_return()
    return (
        lines.join(orders, "InvoiceNo")
        .groupBy(*SUM_KEYS)
        .agg(
            F.count(F.when(sold, F.lit(1))).alias("sold_lines"),
            F.sum(F.when(sold, F.col("Quantity"))).alias("sold_quantity"),
            F.count(F.when(returned, F.lit(1))).alias("returned_lines"),
            F.sum(F.when(returned, F.col("Quantity"))).alias("returned_quantity"),
        )
    )


def measures_from_sums(sums: DataFrame, products: DataFrame) -> DataFrame:
    """One row per country, per product and per day with sales and return
    measures; ``gid`` tells which grouping a row belongs to. Amounts have the
    price's type: exact for the decimal prices of an exact product master."""
    price = F.col("UnitPrice")
    return (
        sums.join(products, "StockCode")
        .groupingSets([list(keys) for keys in _SET_KEYS.values()], *_ALL_KEYS)
        .agg(
            F.grouping_id().alias("gid"),
            F.sum(F.col("sold_quantity") * price).alias("sold_amount"),
            F.sum("sold_lines").alias("sold_lines"),
            F.sum("sold_quantity").alias("sold_quantity"),
            F.sum(F.col("returned_quantity") * price).alias("returned_amount"),
            F.sum("returned_lines").alias("returned_lines"),
            F.sum("returned_quantity").alias("returned_quantity"),
        )
    )


def mart_measures(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The measures of all four marts from the lines, orders and products."""
    return measures_from_sums(daily_sums(lines, orders), products)


def marts_from_measures(measures: DataFrame) -> dict[str, DataFrame]:
    """Cut the combined measures into the four marts (same columns and types
    as the per-mart builders)."""

    def grouping(set_name: str) -> DataFrame:
        return measures.filter(F.col("gid") == F.lit(_grouping_id(set_name)))

    sold = F.col("sold_lines") > 0
    return {
        "sales_per_country": grouping("country").filter(sold).select(
            "Country",
            F.col("sold_amount").alias("total_sales"),
            F.col("sold_lines").alias("number_of_orders"),
            F.col("sold_quantity").alias("total_quantity"),
        ),
        "top_products": grouping("product").filter(sold).select(
            "StockCode",
            "Description",
            F.col("sold_amount").alias("total_revenue"),
            F.col("sold_quantity").alias("total_quantity_sold"),
            F.col("sold_lines").alias("number_of_sales"),
        ),
        "return_products": grouping("product").filter(F.col("returned_lines") > 0).select(
            "StockCode",
            "Description",
            F.col("returned_quantity").alias("total_returned"),
            F.col("returned_lines").alias("number_of_returns"),
            F.col("returned_amount").alias("total_loss"),
        ),
        "sales_by_period": grouping("day").filter(sold).select(
            *DATE_PARTS,
            F.col("sold_amount").alias("total_sales"),
            F.col("sold_lines").alias("number_of_orders"),
            F.col("sold_quantity").alias("total_quantity"),
        ),
    }


def mart_counts(measures: DataFrame) -> DataFrame:
    """One row: how many rows each mart has, from the combined measures alone."""

    def rows(set_name: str, lines: str) -> Column:
        return F.count_if((F.col("gid") == F.lit(_grouping_id(set_name))) & (F.col(lines) > 0))

    return measures.agg(
        rows("country", "sold_lines").alias("sales_per_country"),
        rows("product", "sold_lines").alias("top_products"),
        rows("product", "returned_lines").alias("return_products"),
        rows("day", "sold_lines").alias("sales_by_period"),
    )
