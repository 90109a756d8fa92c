"""End to end: CSV extracts -> bronze Parquet -> silver tables -> gold marts."""

import os
import tempfile

import pytest

from tillroll.operators import serving
from tillroll.plans import bronze, gold, silver
from tillroll.sources import tables

ORDERS_CSV = """InvoiceNo,InvoiceDate,CustomerID,Country
489434,12/1/2009 7:45,13085.0,United Kingdom
489435,12/1/2009 7:46,13085.0,United Kingdom
C489449,12/1/2009 10:33,16321.0,Australia
489450,not a date,,France
489451,12/2/2009 9:00,,Unspecified
"""
LINES_CSV = """InvoiceNo,StockCode,Quantity
489434,85048,12
489434,79323P,12
489435,85048,-2
C489449,85048,-12
489450,85048,1
489451,79323P,0
489451,22087,3
"""
PRODUCTS_CSV = """StockCode,Description,UnitPrice
85048 ,15CM BALL 20 LIGHTS,6.0
85048,15CM BALL 20 LIGHTS,8.0
79323P,PINK CHERRY LIGHTS,6.75
22087,PAPER BUNTING,2.95
POST,POSTAGE,18.0
"""


@pytest.fixture(scope="module")
def landed(spark):
    src = tempfile.mkdtemp(prefix="tillroll-csv-")
    for name, text in [("orders.csv", ORDERS_CSV), ("orders_line.csv", LINES_CSV), ("products.csv", PRODUCTS_CSV)]:
        with open(os.path.join(src, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    out = tempfile.mkdtemp(prefix="tillroll-bronze-")
    specs = bronze.standard_specs(src, out)
    bronze.ingest(spark, specs)
    return {s.name: s.output for s in specs}


def test_bronze_layout(landed, spark):
    assert "year=2009" in os.listdir(landed["orders"])
    orders = tables.read_parquet(spark, landed["orders"])
    assert orders.count() == 5
    assert orders.filter("year IS NULL").count() == 1  # the bad date
    lines_files = [f for f in os.listdir(landed["orders_line"]) if f.endswith(".parquet")]
    assert 1 <= len(lines_files) <= 8


def test_silver_and_gold(landed, spark):
    layers = silver.layers_from_bronze(spark, landed["products"], landed["orders"], landed["orders_line"])
    names = silver.SilverTables(
        products="default.s_products",
        products_invalid="default.s_products_invalid",
        orders="default.s_orders",
        orders_invalid="default.s_orders_invalid",
        lines="default.s_lines",
        lines_invalid="default.s_lines_invalid",
    )
    silver.write_silver(layers, names)
    assert tables.read_table(spark, names.products).count() == 3
    assert tables.read_table(spark, names.products_invalid).count() == 1
    assert tables.read_table(spark, names.orders).count() == 4
    assert tables.read_table(spark, names.orders_invalid).count() == 1
    assert tables.read_table(spark, names.lines_invalid).count() == 1

    lines, orders, products = gold.layers_from_silver(spark, names)
    built = gold.build_marts(lines, orders, products)
    gold.write_gold(built, lambda name, df: df.write.mode("overwrite").saveAsTable(f"default.g_{name}"))
    country = {r["Country"]: r for r in tables.read_table(spark, "default.g_sales_per_country").collect()}
    # UK: 489434 (12 x 7.0 + 12 x 6.75) + 489435 (-2 x 7.0); Unknown: 489451 (3 x 2.95)
    assert country["United Kingdom"]["total_sales"] == pytest.approx(12 * 7.0 + 12 * 6.75 - 14.0)
    assert country["United Kingdom"]["number_of_orders"] == 3
    assert country["Unknown"]["total_quantity"] == 3
    assert "Australia" not in country  # cancelled only
    returns = {r["StockCode"]: r for r in tables.read_table(spark, "default.g_return_products").collect()}
    assert returns["85048"]["total_returned"] == -14 and returns["85048"]["number_of_returns"] == 2

    for strategy in ("reuse_sales", "recompute"):
        other = gold.build_marts(lines, orders, products, strategy=strategy)
        for name, df in other.items():
            assert df.dtypes == built[name].dtypes, (strategy, name)
            assert sorted(map(tuple, df.collect())) == sorted(map(tuple, built[name].collect())), (strategy, name)
    written = {}
    for name, df in built.items():
        written[name] = [tuple(r) for r in serving.sorted_mart(df, name).collect()]
    assert [r[:3] for r in written["sales_by_period"]] == [(2009, 12, 1), (2009, 12, 2)]
    revenue = [r[2] for r in written["top_products"]]
    assert revenue == sorted(revenue, reverse=True)
    page, meta = serving.mart_page(built["sales_by_period"], "sales_by_period", 1, 10, year=2009, month=12)
    assert meta.first()["total"] == 2 and page.count() == 2


def test_streaming_ingest_matches_batch(landed, spark):
    from tillroll.streaming.ingest import ingest_stream

    src = tempfile.mkdtemp(prefix="tillroll-stream-in-")
    with open(os.path.join(src, "orders-1.csv"), "w") as fh:
        fh.write(ORDERS_CSV)
    out = tempfile.mkdtemp(prefix="tillroll-stream-out-")
    ckpt = tempfile.mkdtemp(prefix="tillroll-stream-ckpt-")
    spec = bronze.DatasetSpec("orders", src, out, partitioned=True)
    ingest_stream(spark, spec, checkpoint_location=ckpt).awaitTermination(120)
    landed_once = tables.read_parquet(spark, out)
    batch = tables.read_parquet(spark, landed["orders"])
    assert sorted(map(tuple, landed_once.select(*batch.columns).collect()), key=str) == sorted(
        map(tuple, batch.collect()), key=str
    )
    # a second file arrives; the restarted stream lands only the new file
    with open(os.path.join(src, "orders-2.csv"), "w") as fh:
        fh.write("InvoiceNo,InvoiceDate,CustomerID,Country\n489500,12/3/2009 8:00,1.0,France\n")
    ingest_stream(spark, spec, checkpoint_location=ckpt).awaitTermination(120)
    after = tables.read_parquet(spark, out)
    assert after.count() == 6
    assert after.filter("InvoiceNo = '489500' AND day = 3").count() == 1


def test_streaming_ingest_continuous_mode(spark):
    from tillroll.streaming.ingest import ingest_stream

    src = tempfile.mkdtemp(prefix="tillroll-stream-in-")
    with open(os.path.join(src, "lines-1.csv"), "w") as fh:
        fh.write(LINES_CSV + "489452,22087,4.0\n")
    out = tempfile.mkdtemp(prefix="tillroll-stream-out-")
    spec = bronze.DatasetSpec("orders_line", src, out)
    q = ingest_stream(spark, spec, checkpoint_location=tempfile.mkdtemp(prefix="tillroll-stream-ckpt-"), available_now=False, interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    landed_lines = tables.read_parquet(spark, out)
    assert landed_lines.count() == 8
    assert dict(landed_lines.dtypes)["Quantity"] == "int"
    assert landed_lines.filter("InvoiceNo = '489452'").first()["Quantity"] == 4


def test_mart_over_stored_silver_prunes_and_pushes(landed, spark):
    from tillroll.operators import marts as M

    layers = silver.layers_from_bronze(spark, landed["products"], landed["orders"], landed["orders_line"])
    names = silver.SilverTables(
        products="default.p_products",
        products_invalid="default.p_products_invalid",
        orders="default.p_orders",
        orders_invalid="default.p_orders_invalid",
        lines="default.p_lines",
        lines_invalid="default.p_lines_invalid",
    )
    silver.write_silver(layers, names)
    lines, orders, products = gold.layers_from_silver(spark, names)
    country = M.sales_per_country(M.sales_lines(lines, orders, products))
    plan = country._jdf.queryExecution().executedPlan().toString()
    orders_scan = [ln for ln in plan.splitlines() if "p_orders" in ln and "FileScan" in ln]
    assert orders_scan, plan
    scan = orders_scan[0]
    assert "ReadSchema: struct<InvoiceNo:string,Country:string,IsCancel:boolean>" in scan, scan
    assert "Not(EqualTo(IsCancel,true))" in scan or "EqualTo(IsCancel,false)" in scan, scan


def test_inferred_ingest_gives_the_same_marts(landed, spark):
    csv_dir = tempfile.mkdtemp(prefix="tillroll-csv-infer-")
    for name, text in [("orders.csv", ORDERS_CSV), ("orders_line.csv", LINES_CSV), ("products.csv", PRODUCTS_CSV)]:
        with open(os.path.join(csv_dir, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    out = tempfile.mkdtemp(prefix="tillroll-bronze-infer-")
    specs = bronze.standard_specs(csv_dir, out)
    bronze.ingest(spark, specs, infer=True)
    paths = {s.name: s.output for s in specs}
    inferred = silver.layers_from_bronze(spark, paths["products"], paths["orders"], paths["orders_line"])
    declared = silver.layers_from_bronze(spark, landed["products"], landed["orders"], landed["orders_line"])
    assert dict(inferred.orders_raw.dtypes)["CustomerID"] == "double"
    assert dict(inferred.lines_raw.dtypes)["Quantity"] == "int"
    for name in ("sales_per_country", "top_products", "return_products", "sales_by_period"):
        a = sorted(map(tuple, inferred.mart(name).collect()))
        b = sorted(map(tuple, declared.mart(name).collect()))
        assert a == b, name


def test_relanding_some_days_keeps_the_others(spark):
    src = tempfile.mkdtemp(prefix="tillroll-reland-")
    with open(os.path.join(src, "orders.csv"), "w") as fh:
        fh.write(ORDERS_CSV)
    out = tempfile.mkdtemp(prefix="tillroll-reland-out-") + "/orders"
    bronze.ingest_dataset(spark, bronze.DatasetSpec("orders", os.path.join(src, "orders.csv"), out, partitioned=True))
    fix = os.path.join(src, "fix.csv")
    with open(fix, "w") as fh:
        fh.write("InvoiceNo,InvoiceDate,CustomerID,Country\n489451,12/2/2009 9:00,1.0,France\n")
    spec = bronze.DatasetSpec("orders", fix, out, partitioned=True, replace_partitions_only=True)
    bronze.ingest_dataset(spark, spec)
    landed_orders = {r["InvoiceNo"]: r for r in tables.read_parquet(spark, out).collect()}
    assert len(landed_orders) == 5  # 12/1 and the bad-date rows kept, 12/2 replaced
    assert landed_orders["489451"]["Country"] == "France"
