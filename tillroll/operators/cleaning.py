"""Silver-layer cleaning of products and orders (lines pass through as is)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.dates import parse_invoice_date
from tillroll.functions.text import trim_columns
from tillroll.schemas import DATE_PARTS

# The extract's "no country" marker and the silver replacement.
UNSPECIFIED_COUNTRY = "Unspecified"
UNKNOWN_COUNTRY = "Unknown"
# Fixed value: CustomerID used when the extract has none.
NO_CUSTOMER = -1
# Fixed value: invoice numbers of cancellations start with this letter.
CANCEL_PREFIX = "C"


def trim_products(products: DataFrame) -> DataFrame:
    """Trim ``Description`` and ``StockCode`` (spaces only)."""
    return trim_columns(products, "Description", "StockCode")


# Decimals of a price and of a mean price in exact money.
PRICE_DECIMALS = 4
MEAN_DECIMALS = 6


def exact_mean_price(price_sum: Column, count: Column) -> Column:
    """The mean of ``count`` positive prices whose sum is given in units of the
    last price decimal: rounded half up once, to ``MEAN_DECIMALS``, by integer
    division, as a decimal."""
    scaled = price_sum * F.lit(10 ** (MEAN_DECIMALS - PRICE_DECIMALS))
    units = F.call_function("div", F.lit(2) * scaled + count, F.lit(2) * count)
    return (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-MEAN_DECIMALS))).cast(f"decimal(18,{MEAN_DECIMALS})")


def exact_product_master(valid_products: DataFrame) -> DataFrame:
    """``product_master`` with decimal prices that do not depend on row order.

    Every price is rounded half up to ``PRICE_DECIMALS`` decimals and added up
    as an integer; the mean is rounded half up to ``MEAN_DECIMALS``. Amounts and
    sums of amounts are then exact decimals, so that two runs give the same
    bytes and near-ties never swap places; cents are rounded where they are
    shown.
    """
    units = (F.col("UnitPrice").cast(f"decimal(18,{PRICE_DECIMALS})") * F.lit(10**PRICE_DECIMALS)).cast("bigint")
    pairs = valid_products.groupBy("StockCode", "Description").agg(
        F.sum(units).alias("_price_sum"), F.count("UnitPrice").alias("_price_n")
    )
    return pairs.groupBy("StockCode").agg(
        F.min("Description").alias("Description"),
        exact_mean_price(F.sum("_price_sum"), F.sum("_price_n")).alias("UnitPrice"),
    )


def product_master(valid_products: DataFrame) -> DataFrame:
    """One row per ``StockCode``: a description and the mean price.

    The mean is over the distinct valid (code, description, price) rows of the
    extract ("average-price costing"). ``min`` picks the description so the
    result does not depend on row order.

    Two levels: a hash aggregate per (code, description) pair keeps price sum
    and count (fixed-width buffers, combined map-side, so a code with a very
    large number of rows costs one partial row per task); the string ``min``,
    which needs a sort-based aggregate, then runs over the distinct pairs only.
    """
    pairs = valid_products.groupBy("StockCode", "Description").agg(
        F.sum("UnitPrice").alias("_price_sum"),
        F.count("UnitPrice").alias("_price_n"),
    )
    return pairs.groupBy("StockCode").agg(
        F.min("Description").alias("Description"),
        (F.sum("_price_sum") / F.sum("_price_n")).alias("UnitPrice"),
    )


def parse_order_dates(orders: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Replace the ``InvoiceDate`` text by a timestamp (NULL when unparseable).

    With ``keep_raw`` the original text is kept as ``InvoiceDateText``, so a
    quarantined order still shows the date that failed to parse.
    """
    if keep_raw:
        orders = orders.withColumn("InvoiceDateText", F.col("InvoiceDate"))
    return orders.withColumn("InvoiceDate", parse_invoice_date("InvoiceDate"))


def customer_or_default(col: str = "CustomerID") -> Column:
    """Integer customer id; missing, NaN or out-of-range ids become -1."""
    return F.coalesce(F.col(col).try_cast("int"), F.lit(NO_CUSTOMER))


def normalised_country(col: str = "Country") -> Column:
    c = F.col(col)
    return F.when(c.isNull() | (c == UNSPECIFIED_COUNTRY), F.lit(UNKNOWN_COUNTRY)).otherwise(c)


def cancel_flag(col: str = "InvoiceNo") -> Column:
    """True for invoice numbers starting with ``C``; never NULL."""
    return F.coalesce(F.col(col).startswith(CANCEL_PREFIX), F.lit(False))


def clean_orders(valid_orders: DataFrame) -> DataFrame:
    """Typed customer id, normalised country and the cancellation flag.

    ``year``/``month``/``day`` are the ingest-time partition values, carried
    through unchanged.
    """
    return valid_orders.select(
        "InvoiceNo",
        "InvoiceDate",
        customer_or_default().alias("CustomerID"),
        normalised_country().alias("Country"),
        cancel_flag().alias("IsCancel"),
        *DATE_PARTS,
    )
