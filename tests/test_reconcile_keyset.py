"""Loss accounting, paging by cursor and rules counted while writing."""

import random

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare_frame, duckdb_connection
from tillroll.operators import keyset, marts, reconcile, validation
from tillroll.session import scratch_path

LINES = "InvoiceNo string, StockCode string, Quantity int"


def inputs(spark):
    lines = spark.createDataFrame([("1", "a", 2), ("1", "x", 1), ("2", "a", 3), ("3", "a", -1), ("3", "y", 1), ("9", "b", 7), ("9", "zz", 1)], LINES)
    orders = spark.createDataFrame([("1", "F", False, 2010, 1, 1), ("2", "F", False, 2010, 1, 1), ("2", "F", False, 2010, 1, 2), ("3", "F", True, 2010, 1, 1)], "InvoiceNo string, Country string, IsCancel boolean, year int, month int, day int")
    products = spark.createDataFrame([("a", "one", 1.0), ("b", "two", 1.0)], "StockCode string, Description string, UnitPrice double")
    return lines, orders, products


def test_every_line_has_one_outcome(spark):
    lines, orders, products = inputs(spark)
    got = {(r.InvoiceNo, r.StockCode): (r.outcome, r.order_rows) for r in reconcile.line_outcomes(lines, orders, products).collect()}
    assert got == {
        ("1", "a"): ("sold", 1), ("1", "x"): ("without_product", 1), ("2", "a"): ("fanned_out", 2), ("3", "a"): ("sold", 1),
        ("3", "y"): ("without_product", 1), ("9", "b"): ("without_order", 0), ("9", "zz"): ("without_order", 0),
    }
    report = {r.outcome: (r.n_lines, r.quantity, r.sales_rows) for r in reconcile.loss_report(lines, orders, products).collect()}
    assert report == {"sold": (2, 1, 2), "fanned_out": (1, 3, 2), "without_product": (2, 2, 0), "without_order": (2, 8, 0)}
    assert sum(r[0] for r in report.values()) == lines.count()
    assert sum(r[2] for r in report.values()) == marts.sales_lines(lines, orders, products).count()
    assert reconcile.lost_lines(lines, orders, products).count() == 4
    assert reconcile.loss_report(lines.limit(0), orders, products).collect() == []


def test_a_hot_invoice_is_split_in_the_order_join(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        lines = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
            (F.col("id") % 50).cast("string").alias("StockCode"), F.lit(1).alias("Quantity"),
        )
        orders = lines.select("InvoiceNo").distinct()
        products = lines.select("StockCode").distinct()
        report = reconcile.loss_report(lines, orders, products)
        assert [tuple(r) for r in report.collect()] == [("sold", n, n, n)]
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan or "isSkewJoin=true" in plan, plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def walk(view, size):
    rows, cursor, pages = [], None, 0
    while True:
        page = view.response(cursor, size)
        rows += [tuple(r.values()) for r in page["data"]]
        pages += 1
        cursor = page["next"]
        if cursor is None:
            return rows, pages


@pytest.mark.parametrize("order", [[("v", True), ("k", False)], [("v", False), ("k", True)]])
def test_walking_all_pages_gives_the_sorted_rows(spark, order):
    rng = random.Random(4)
    rows = [(rng.choice([None, -0.1, 0.1 + 0.2, 1e300, 7.0]), f"k{i:03d}" if i else None) for i in range(230)]
    df = spark.createDataFrame(rows, "v double, k string").repartition(3)
    want = [tuple(r) for r in df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in order]).collect()]
    for parts in (1, 7):
        view = keyset.keyset_view(df, order, partitions=parts)
        for size in (10, 23, 100):
            got, pages = walk(view, size)
            assert got == want
            assert pages == 230 // size + 1


def test_a_page_reads_one_or_two_folders(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("v"), F.col("id").alias("k"))
    view = keyset.keyset_view(df, [("v", True), ("k", False)], partitions=10)
    folders = view.rows.select("_part").distinct().count()
    assert folders >= 8
    cursor, seen = None, 0
    while True:
        assert len(view.folders(cursor, 50)) <= 3
        page = view.page(cursor, 50)
        plan = page._jdf.queryExecution().executedPlan().toString()
        if not view.folders(cursor, 50):  # after the last row
            assert page.count() == 0
            break
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
        if cursor:
            assert "PushedFilters: []" not in plan  # the range reaches the scan
        rows = page.collect()
        seen += len(rows)
        if len(rows) < 50:
            break
        cursor = view.cursor_of(rows[-1])
    assert seen == 1000


def test_cursors_are_checked(spark):
    view = keyset.keyset_view(spark.range(3).withColumnRenamed("id", "v"), [("v", False)])
    with pytest.raises(ValueError):
        view.page({"other": 1})
    with pytest.raises(ValueError):
        keyset.decode_cursor("not a cursor")
    empty = keyset.keyset_view(spark.range(0).withColumnRenamed("id", "v"), [("v", False)])
    assert empty.response() == {"page_size": 10, "data": [], "next": None}


def test_rules_are_counted_by_the_write_of_both_sides(spark):
    rows = [("1", "a", 1), (None, "a", 0), ("", "", None), ("2", "b", 0), ("3", None, 4)]
    lines = spark.createDataFrame(rows, LINES)
    split = validation.write_split(lines, validation.line_rules(), scratch_path(spark, "split"))
    assert split.valid.columns == lines.columns
    assert [tuple(r) for r in split.valid.collect()] == [("1", "a", 1)]
    assert split.invalid.count() == split.n_invalid == 4 and split.rows == 5
    assert split.failed == {
        "InvoiceNo_not_null": 1, "InvoiceNo_not_empty": 2, "StockCode_not_null": 1, "StockCode_not_empty": 2,
        "Quantity_not_null": 1, "Quantity_not_zero": 3,
    }
    empty = validation.write_split(lines.limit(0), validation.line_rules(), scratch_path(spark, "split"))
    assert empty.rows == 0 and empty.valid.count() == 0 and set(empty.failed.values()) == {0}


def test_writing_both_sides_reads_the_input_once(spark):
    path = scratch_path(spark, "input")
    spark.range(1000).select(F.col("id").cast("string").alias("InvoiceNo"), F.lit("a").alias("StockCode"), (F.col("id") % 3).cast("int").alias("Quantity")).write.parquet(path)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(q):
        calls.add(1)
        return q

    lines = spark.read.parquet(path).withColumn("Quantity", counted("Quantity"))
    split = validation.write_split(lines, validation.line_rules(), scratch_path(spark, "split"))
    assert split.n_invalid == 334 and calls.value == 1000


def test_counted_silver_tables(spark, sf_small):
    from __spark_entry__ import _layers
    from tillroll.plans import silver

    spark.sql("CREATE DATABASE IF NOT EXISTS counted")
    names = {f: f"counted.{f}" for f in ("products", "products_invalid", "orders", "orders_invalid", "lines", "lines_invalid")}
    layers = _layers(spark, sf_small)
    splits = silver.write_silver_counted(layers, scratch_path(spark, "staging"), silver.SilverTables(**names))
    summary = {(r.dataset, r.is_valid): r.n for r in layers.validation_counts().collect()}
    for name, split in splits.items():
        assert (split.rows - split.n_invalid, split.n_invalid) == (summary[name, True], summary[name, False])
    assert spark.table("counted.lines_invalid").count() == splits["orders_line"].n_invalid
    assert sorted(map(tuple, spark.table("counted.products").collect())) == sorted(map(tuple, layers.products.collect()))


@pytest.mark.parametrize("name", ["sales_loss_report", "sales_lost_lines", "line_outcomes", "keyset_top_products", "keyset_sales_per_country", "keyset_sales_by_period", "rule_counters", "written_lines_invalid"])
def test_registered_queries(spark, sf_small, name):
    import __spark_entry__ as entry

    assert compare_frame(entry.queries()[name](spark, sf_small), entry.oracle_sql()[name], duckdb_connection(sf_small)) == "ok"
