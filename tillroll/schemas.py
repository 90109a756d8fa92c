"""Declared schemas of the extracts and of each layer.

The extracts were inferred from CSV headers in the original flow; declaring
them avoids two inference traps: a single blank price turns the whole
``UnitPrice`` column into strings, and an all-numeric invoice file infers
``InvoiceNo`` as an integer that no longer joins the cancelled ``C...`` codes.
"""

from pyspark.sql import types as T

# Flat yearly extract (one row per invoice line, all attributes repeated).
FLAT_EXTRACT = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

PRODUCTS_RAW = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
    ]
)

ORDERS_RAW = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

LINES_RAW = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
    ]
)

# Bronze orders carry the date parts used as partition columns.
DATE_PARTS = ["year", "month", "day"]

ORDERS_BRONZE = T.StructType(
    ORDERS_RAW.fields + [T.StructField(c, T.IntegerType()) for c in DATE_PARTS]
)

ORDERS_SILVER = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("CustomerID", T.IntegerType()),
        T.StructField("Country", T.StringType()),
        T.StructField("IsCancel", T.BooleanType(), False),
    ]
    + [T.StructField(c, T.IntegerType()) for c in DATE_PARTS]
)

PRODUCTS_SILVER = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
    ]
)

SALES_PER_COUNTRY = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("total_sales", T.DoubleType()),
        T.StructField("number_of_orders", T.LongType(), False),
        T.StructField("total_quantity", T.LongType()),
    ]
)

TOP_PRODUCTS = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("total_quantity_sold", T.LongType()),
        T.StructField("number_of_sales", T.LongType(), False),
    ]
)

RETURN_PRODUCTS = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("total_returned", T.LongType()),
        T.StructField("number_of_returns", T.LongType(), False),
        T.StructField("total_loss", T.DoubleType()),
    ]
)

SALES_BY_PERIOD = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in DATE_PARTS]
    + [
        T.StructField("total_sales", T.DoubleType()),
        T.StructField("number_of_orders", T.LongType(), False),
        T.StructField("total_quantity", T.LongType()),
    ]
)
