"""Silver cleaning and the gold marts on hand-written rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tillroll.functions import date_parts, parse_invoice_date
from tillroll.operators import cleaning, marts
from tillroll.plans.layers import RetailLayers
from tillroll.schemas import LINES_RAW, ORDERS_RAW, PRODUCTS_RAW


def test_parse_dates_bad_text_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("12/1/2009 7:45",), ("not a date",), (None,), ("1/13/2010 17:05",)], "d string")
    out = df.select(parse_invoice_date("d").alias("ts")).collect()
    assert out[0]["ts"] == dt.datetime(2009, 12, 1, 7, 45)
    assert out[1]["ts"] is None and out[2]["ts"] is None
    assert out[3]["ts"] == dt.datetime(2010, 1, 13, 17, 5)


def test_date_parts_keep_text(spark):
    df = spark.createDataFrame([("12/1/2009 7:45",), ("bad",)], "InvoiceDate string")
    rows = date_parts(df).collect()
    assert (rows[0]["InvoiceDate"], rows[0]["year"], rows[0]["month"], rows[0]["day"]) == ("12/1/2009 7:45", 2009, 12, 1)
    assert (rows[1]["year"], rows[1]["month"], rows[1]["day"]) == (None, None, None)


def test_customer_country_and_cancel_columns(spark):
    rows = [
        ("C536379", "12/1/2009 9:41", 14527.0, "Unspecified"),
        ("536380", "12/1/2009 9:41", None, "France"),
        ("536381", "12/1/2009 9:41", math.nan, "EIRE"),
        ("c536382", "12/1/2009 9:41", 1e12, "Unknown"),
        ("536383", "12/1/2009 9:41", 13085.7, "France"),
    ]
    layers = RetailLayers(
        spark.createDataFrame([], PRODUCTS_RAW), spark.createDataFrame(rows, ORDERS_RAW), spark.createDataFrame([], LINES_RAW)
    )
    out = {r["InvoiceNo"]: r for r in layers.orders.collect()}
    assert out["C536379"]["CustomerID"] == 14527 and out["C536379"]["Country"] == "Unknown"
    assert out["C536379"]["IsCancel"] is True
    assert out["536380"]["CustomerID"] == -1 and out["536380"]["IsCancel"] is False
    assert out["536381"]["CustomerID"] == -1  # NaN
    assert out["c536382"]["CustomerID"] == -1  # out of int range
    assert out["c536382"]["IsCancel"] is False  # case kept
    assert out["536383"]["CustomerID"] == 13085  # truncated, as an int cast does
    assert layers.orders.columns == ["InvoiceNo", "InvoiceDate", "CustomerID", "Country", "IsCancel", "year", "month", "day"]
    types = dict(layers.orders.dtypes)
    assert types["CustomerID"] == "int" and types["IsCancel"] == "boolean" and types["InvoiceDate"] == "timestamp"


def test_product_master_mean_and_min_description(spark):
    rows = [("A", "lamp", 2.0), ("A", "lamp", 3.0), ("A", "a lamp", 4.0), ("B", "cup", 1.5)]
    master = {r["StockCode"]: r for r in cleaning.product_master(spark.createDataFrame(rows, PRODUCTS_RAW)).collect()}
    assert master["A"]["UnitPrice"] == pytest.approx(3.0) and master["A"]["Description"] == "a lamp"
    assert master["B"]["UnitPrice"] == 1.5


def _tiny_layers(spark):
    products = [(" P1 ", "Lamp", 2.0), ("P1", "Lamp", 4.0), ("P2", "Cup", 1.0), ("POST", "Postage", 9.0)]
    orders = [
        ("1", "1/5/2010 10:00", 1.0, "France"),
        ("2", "1/6/2010 10:00", 2.0, "France"),
        ("2", "1/6/2010 10:00", 3.0, "Spain"),  # repeated invoice: its lines fan out
        ("C3", "1/6/2010 11:00", 1.0, "France"),
        ("4", "bad", 1.0, "France"),  # quarantined: its lines vanish
    ]
    lines = [
        ("1", "P1", 2),
        ("1", "P2", -1),  # negative line on a kept invoice
        ("2", "P2", 5),
        ("C3", "P1", -2),
        ("4", "P1", 7),
        ("1", " P1", 1),  # padded line code: matches no product
        ("1", "POST", 1),  # excluded product
    ]
    return RetailLayers(
        spark.createDataFrame(products, PRODUCTS_RAW),
        spark.createDataFrame(orders, ORDERS_RAW),
        spark.createDataFrame(lines, LINES_RAW),
    )


def test_sales_join_semantics(spark):
    layers = _tiny_layers(spark)
    sales = layers.sales.collect()
    # invoice 2 has two valid order rows -> its single line appears twice
    assert sum(1 for r in sales if r["InvoiceNo"] == "2") == 2
    assert {r["StockCode"] for r in sales} == {"P1", "P2"}
    assert not any(r["InvoiceNo"] == "4" for r in sales)
    p1 = next(r for r in sales if r["InvoiceNo"] == "1" and r["StockCode"] == "P1")
    assert p1["UnitPrice"] == 3.0 and p1["Amount"] == 6.0  # mean price costing
    assert layers.sales.columns == [
        "StockCode", "InvoiceNo", "Quantity", "InvoiceDate", "CustomerID", "Country",
        "IsCancel", "year", "month", "day", "Description", "UnitPrice", "Amount",
    ]


def test_marts_on_tiny_layers(spark):
    layers = _tiny_layers(spark)
    country = {r["Country"]: r for r in layers.mart("sales_per_country").collect()}
    # France: invoice 1 (P1 x2 @3, P2 x-1 @1) + invoice 2 as France (P2 x5 @1)
    assert country["France"]["total_sales"] == pytest.approx(6.0 - 1.0 + 5.0)
    assert country["France"]["number_of_orders"] == 3
    assert country["France"]["total_quantity"] == 6
    assert country["Spain"]["number_of_orders"] == 1
    returns = {r["StockCode"]: r for r in layers.mart("return_products").collect()}
    assert returns["P2"]["total_returned"] == -1 and returns["P2"]["total_loss"] == pytest.approx(-1.0)
    assert returns["P1"]["total_returned"] == -2 and returns["P1"]["number_of_returns"] == 1
    top = {r["StockCode"]: r for r in layers.mart("top_products").collect()}
    assert top["P2"]["total_quantity_sold"] == 5 - 1 + 5 and top["P2"]["number_of_sales"] == 3
    days = {(r["year"], r["month"], r["day"]): r for r in layers.mart("sales_by_period").collect()}
    assert set(days) == {(2010, 1, 5), (2010, 1, 6)}
    assert days[(2010, 1, 6)]["number_of_orders"] == 2


def test_mart_totals_agree(spark, sf_small):
    from __spark_entry__ import _layers

    layers = _layers(spark, sf_small)
    totals = {}
    for name, measure in [("sales_per_country", "total_sales"), ("top_products", "total_revenue"), ("sales_by_period", "total_sales")]:
        row = layers.mart(name).agg(F.sum(measure).alias("s"), F.sum("total_quantity" if name != "top_products" else "total_quantity_sold").alias("q")).first()
        totals[name] = (round(row["s"], 2), row["q"])
    assert len(set(totals.values())) == 1, totals


def test_mart_schemas(spark, sf_small):
    from __spark_entry__ import _layers
    from tillroll import schemas

    layers = _layers(spark, sf_small)
    expected = {
        "sales_per_country": schemas.SALES_PER_COUNTRY,
        "top_products": schemas.TOP_PRODUCTS,
        "return_products": schemas.RETURN_PRODUCTS,
        "sales_by_period": schemas.SALES_BY_PERIOD,
    }
    for name, schema in expected.items():
        got = [(f.name, f.dataType) for f in layers.mart(name).schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_mart_input_columns_cover_all_marts(spark, sf_small):
    from __spark_entry__ import _layers

    layers = _layers(spark, sf_small)
    narrow = layers.sales.select(*marts.MART_INPUT_COLUMNS)
    for name in marts.MART_BUILDERS:
        assert layers.mart(name, sales=narrow).count() == layers.mart(name).count()


def test_layer_schemas_match_declared(spark, sf_small):
    from __spark_entry__ import _layers
    from tillroll import schemas

    layers = _layers(spark, sf_small)

    def names_types(struct):
        return [(f.name, f.dataType) for f in struct.fields]

    assert names_types(layers.products_raw.schema) == names_types(schemas.PRODUCTS_RAW)
    assert names_types(layers.orders_raw.schema) == names_types(schemas.ORDERS_RAW)
    assert names_types(layers.lines_raw.schema) == names_types(schemas.LINES_RAW)
    assert names_types(layers.orders_bronze.schema) == names_types(schemas.ORDERS_BRONZE)
    assert names_types(layers.products.schema) == names_types(schemas.PRODUCTS_SILVER)
    assert names_types(layers.orders.schema) == names_types(schemas.ORDERS_SILVER)
    assert names_types(layers.lines.schema) == names_types(schemas.LINES_RAW)
    assert names_types(layers.orders_invalid.schema) == [
        ("InvoiceNo", schemas.T.StringType()),
        ("InvoiceDate", schemas.T.TimestampType()),
        ("CustomerID", schemas.T.DoubleType()),
        ("Country", schemas.T.StringType()),
    ] + [(c, schemas.T.IntegerType()) for c in schemas.DATE_PARTS]


def test_fixture_counts_documented_in_fixtures_md(spark, sf_small):
    """Counts listed for sf0.001 in FIXTURES.md (checked there in two engines)."""
    from __spark_entry__ import _layers

    layers = _layers(spark, sf_small)
    counts = {
        "products_invalid": layers.products_invalid.count(),
        "products_valid": layers.products_valid.count(),
        "orders_invalid": layers.orders_invalid.count(),
        "orders_valid": layers.orders.count(),
        "lines_invalid": layers.lines_invalid.count(),
        "lines_valid": layers.lines.count(),
        "product_master": layers.products.count(),
        "sales_lines": layers.sales.count(),
        "cancelled": layers.sales.filter("IsCancel").count(),
        "negative": layers.sales.filter("Quantity < 0").count(),
        "both": layers.sales.filter("IsCancel AND Quantity < 0").count(),
        "unknown_country": layers.orders.filter(F.col("Country") == "Unknown").count(),
        "long_descriptions": layers.products.filter(F.length("Description") > 25).count(),
        "repeated_invoices": layers.orders.groupBy("InvoiceNo").count().filter("count > 1").count(),
        "two_descriptions": layers.products_valid.groupBy("StockCode").agg(F.count_distinct("Description").alias("n")).filter("n > 1").count(),
        "padded_line_codes": layers.lines.withColumn("StockCode", F.trim("StockCode")).join(layers.products, "StockCode").count()
        - layers.lines.join(layers.products, "StockCode").count(),
    }
    assert counts == {
        "products_invalid": 18, "products_valid": 249, "orders_invalid": 18, "orders_valid": 1485,
        "lines_invalid": 109, "lines_valid": 5891, "product_master": 186, "sales_lines": 5480,
        "cancelled": 422, "negative": 907, "both": 71, "unknown_country": 56, "long_descriptions": 47,
        "repeated_invoices": 3, "two_descriptions": 32, "padded_line_codes": 4,
    }
    mart_rows = {name: layers.mart(name).count() for name in marts.MART_BUILDERS}
    assert mart_rows == {"sales_per_country": 25, "top_products": 186, "return_products": 186, "sales_by_period": 1014}
