"""Golden rows for every validation rule, plus the split's totality."""

import math

import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning, validation as V
from tillroll.schemas import LINES_RAW, PRODUCTS_RAW

GOOD_PRODUCT = ("85048", "15CM BALL, 20 LIGHTS", 6.95)

# One failing row per product rule (after trimming), with the rule it breaks.
PRODUCT_FAILURES = [
    ((None, "LIGHT", 1.0), "StockCode_not_null"),
    (("", "LIGHT", 1.0), "StockCode_not_empty"),
    (("post", "LIGHT", 1.0), "StockCode_is_product"),
    (("POSTAGE", "LIGHT", 1.0), "StockCode_is_product"),
    (("m", "LIGHT", 1.0), "StockCode_is_product"),
    (("D", "LIGHT", 1.0), "StockCode_is_product"),
    (("Bank Charges", "LIGHT", 1.0), "StockCode_is_product"),
    (("1", None, 1.0), "Description_not_null"),
    (("1", "", 1.0), "Description_not_empty"),
    (("1", "Bad debt adjustment", 1.0), "Description_not_bad_debt"),
    (("1", "stock ADJUSTED", 1.0), "Description_not_adjust"),
    (("1", "DOTCOM POSTAGE", 1.0), "Description_not_dotcom_postage"),
    (("1", "Amazon fee", 1.0), "Description_not_amazon_fee"),
    (("1", "LIGHT", None), "UnitPrice_not_null"),
    (("1", "LIGHT", 0.0), "UnitPrice_positive"),
    (("1", "LIGHT", -2.5), "UnitPrice_positive"),
]


def test_product_rules_each_fail(spark):
    rows = [GOOD_PRODUCT] + [r for r, _ in PRODUCT_FAILURES]
    df = spark.createDataFrame(rows, PRODUCTS_RAW)
    flagged = V.failed_rules(df, V.product_rules()).collect()
    assert flagged[0]["failed_rules"] == []
    for row, (_, rule) in zip(flagged[1:], PRODUCT_FAILURES):
        assert rule in row["failed_rules"], (row, rule)
    valid, invalid = V.validate_and_split(df, V.product_rules())
    assert valid.count() == 1 and invalid.count() == len(PRODUCT_FAILURES)


def test_product_rules_see_trimmed_values(spark):
    df = spark.createDataFrame([("  POST ", " x ", 1.0), (" 123 ", "  ", 1.0), ("\t7", "lamp", 1.0)], PRODUCTS_RAW)
    trimmed = cleaning.trim_products(df)
    rows = trimmed.collect()
    assert rows[0]["StockCode"] == "POST" and rows[1]["Description"] == ""
    # trim removes spaces only: a tab stays part of the code
    assert rows[2]["StockCode"] == "\t7"
    valid, invalid = V.validate_and_split(trimmed, V.product_rules())
    assert [r["StockCode"] for r in valid.collect()] == ["\t7"]
    assert invalid.count() == 2


def test_nan_price_passes_like_spark(spark):
    df = spark.createDataFrame([("1", "LIGHT", math.nan)], PRODUCTS_RAW)
    valid, _ = V.validate_and_split(df, V.product_rules())
    assert valid.count() == 1  # NaN > 0 is true in Spark


ORDER_SCHEMA = "InvoiceNo string, InvoiceDate string, CustomerID double, Country string"
ORDER_FAILURES = [
    ((None, "12/1/2009 7:45", 1.0, "France"), "InvoiceNo_not_null"),
    (("", "12/1/2009 7:45", 1.0, "France"), "InvoiceNo_not_empty"),
    (("5", None, 1.0, "France"), "InvoiceDate_not_null"),
    (("6", "31/31/2009 7:45", 1.0, "France"), "InvoiceDate_not_null"),
    (("7", "12/1/2009 7:45", 1.0, None), "Country_not_null"),
    (("8", "12/1/2009 7:45", 1.0, ""), "Country_not_empty"),
]


def test_order_rules_each_fail(spark):
    rows = [("1", "12/1/2009 7:45", 13085.0, "France")] + [r for r, _ in ORDER_FAILURES]
    parsed = cleaning.parse_order_dates(spark.createDataFrame(rows, ORDER_SCHEMA))
    flagged = V.failed_rules(parsed, V.order_rules()).collect()
    assert flagged[0]["failed_rules"] == []
    for row, (_, rule) in zip(flagged[1:], ORDER_FAILURES):
        assert rule in row["failed_rules"], (row, rule)


LINE_FAILURES = [
    ((None, "1", 1), "InvoiceNo_not_null"),
    (("", "1", 1), "InvoiceNo_not_empty"),
    (("1", None, 1), "StockCode_not_null"),
    (("1", "", 1), "StockCode_not_empty"),
    (("1", "1", None), "Quantity_not_null"),
    (("1", "1", 0), "Quantity_not_zero"),
]


def test_line_rules_each_fail(spark):
    rows = [("1", "85048", -3)] + [r for r, _ in LINE_FAILURES]
    df = spark.createDataFrame(rows, LINES_RAW)
    flagged = V.failed_rules(df, V.line_rules()).collect()
    assert flagged[0]["failed_rules"] == []
    for row, (_, rule) in zip(flagged[1:], LINE_FAILURES):
        assert rule in row["failed_rules"], (row, rule)


def test_rule_counts():
    # 11 product, 5 order and 6 line conjuncts
    assert (len(V.product_rules()), len(V.order_rules()), len(V.line_rules())) == (11, 5, 6)


def test_unguarded_null_rule_goes_to_quarantine(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "p double")
    rules = [V.Rule("p_positive", F.col("p") > 0)]
    valid, invalid = V.validate_and_split(df, rules)
    assert valid.count() + invalid.count() == df.count()
    assert sorted(r["p"] is None for r in invalid.collect()) == [False, True]


def test_empty_rule_list_accepts_all(spark):
    df = spark.range(5)
    valid, invalid = V.validate_and_split(df, [])
    assert valid.count() == 5 and invalid.count() == 0
    assert V.failed_rules(df, []).filter(F.size("failed_rules") > 0).count() == 0


@pytest.mark.parametrize("dataset", ["products", "orders", "orders_line"])
def test_split_counts_add_up(spark, sf_small, dataset):
    from __spark_entry__ import _layers

    layers = _layers(spark, sf_small)
    frames = {
        "products": (layers.products_trimmed, layers.products_valid, layers.products_invalid),
        "orders": (layers.orders_parsed, layers.orders_accepted, layers.orders_invalid),
        "orders_line": (layers.lines_raw, layers.lines, layers.lines_invalid),
    }[dataset]
    whole, valid, invalid = (f.count() for f in frames)
    assert valid + invalid == whole
    summary = {
        (r["dataset"], r["is_valid"]): r["n"] for r in layers.validation_counts().collect()
    }
    assert summary[(dataset, True)] == valid and summary[(dataset, False)] == invalid


def test_valid_side_pushes_rules_into_parquet_scan(spark):
    import tempfile

    out = tempfile.mkdtemp(prefix="tillroll-push-") + "/lines"
    spark.createDataFrame([("1", "A", 2), ("", "B", 1), ("3", None, 0)], LINES_RAW).write.parquet(out)
    valid, invalid = V.validate_and_split(spark.read.parquet(out), V.line_rules())
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(InvoiceNo), Not(EqualTo(InvoiceNo,))" in plan, plan
    assert valid.count() == 1 and invalid.count() == 2
