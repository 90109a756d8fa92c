"""Scale paths: a hot invoice, the CLI over the layer jobs, API-shaped pages."""

import json
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tillroll.operators import marts, serving
from tillroll.plans.layers import RetailLayers
from tillroll.schemas import LINES_RAW, ORDERS_RAW, PRODUCTS_RAW
from tillroll.sources import extracts, retail_views

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_invoice_is_split_across_tasks(spark, skew_conf):
    n = 30_000
    # one invoice carries a third of all lines
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        (F.col("id") % 50).cast("string").alias("StockCode"),
        F.lit(1).alias("Quantity"),
    )
    orders = (
        spark.range(n)
        .select(F.col("id").cast("string").alias("InvoiceNo"))
        .union(spark.createDataFrame([("HOT",)], "InvoiceNo string"))
        .select(
            "InvoiceNo",
            F.lit("1/5/2010 10:00").alias("InvoiceDate"),
            F.lit(1.0).alias("CustomerID"),
            F.lit("France").alias("Country"),
        )
    )
    products = spark.range(50).select(
        F.col("id").cast("string").alias("StockCode"), F.lit("item").alias("Description"), F.lit(2.0).alias("UnitPrice")
    )
    layers = RetailLayers(products, orders, lines)
    country = layers.mart("sales_per_country")
    rows = country.collect()  # runs this Dataset's own adaptive plan to its final form
    assert len(rows) == 1
    row = rows[0]
    assert row["number_of_orders"] == n and row["total_sales"] == pytest.approx(2.0 * n)
    plan = country._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan or "isSkewJoin=true" in plan, plan


def test_keep_raw_dates_in_quarantine(spark):
    orders = spark.createDataFrame([("1", "not a date", 1.0, "France"), ("2", "1/5/2010 10:00", 1.0, "France")], ORDERS_RAW)
    layers = RetailLayers(
        spark.createDataFrame([], PRODUCTS_RAW), orders, spark.createDataFrame([], LINES_RAW), keep_raw_dates=True
    )
    bad = layers.orders_invalid.collect()
    assert len(bad) == 1 and bad[0]["InvoiceDate"] is None and bad[0]["InvoiceDateText"] == "not a date"
    assert "InvoiceDateText" not in layers.orders.columns


def test_page_response_shape(spark, sf_small):
    from __spark_entry__ import _layers

    mart = _layers(spark, sf_small).mart("sales_by_period")
    out = serving.page_response(mart, "sales_by_period", 2, 5, year=1997, month=None)
    assert set(out) == {"total", "page", "page_size", "total_pages", "filters", "data"}
    assert out["page"] == 2 and out["page_size"] == 5 and len(out["data"]) == 5
    assert out["filters"] == {"year": 1997, "month": None}
    assert all(r["year"] == 1997 for r in out["data"])
    assert out["total_pages"] == -(-out["total"] // 5)
    countries = serving.page_response(_layers(spark, sf_small).mart("sales_per_country"), "sales_per_country", 1, 100)
    assert "filters" not in countries and len(countries["data"]) == countries["total"] == 25


def test_cli_runs_every_layer(spark, capsys):
    from tillroll import cli

    work = tempfile.mkdtemp(prefix="tillroll-cli-")
    header = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    a = os.path.join(work, "a.csv")
    with open(a, "wb") as fh:
        fh.write(
            b"\xef\xbb\xbf"
            + (
                header
                + "1001,85048,LAMP,2,12/1/2009 7:45,3.0,13085.0,France\n"
                + "1001,22087,CUP,1,12/1/2009 7:45,1.5,13085.0,France\n"
                + "C1002,85048,LAMP,-1,12/2/2009 8:00,3.0,,Spain\n"
            ).encode("latin-1")
        )
    split_dir = os.path.join(work, "split")
    cli.main(["split", "--extract", a, "--output", split_dir])
    assert sorted(os.listdir(split_dir)) == ["orders.csv", "orders_line.csv", "products.csv"]
    bronze_dir = os.path.join(work, "bronze")
    cli.main(["bronze", "--input", split_dir, "--output", bronze_dir])
    spark.sql("CREATE DATABASE IF NOT EXISTS cli_db")
    cli.main(["silver", "--bronze", bronze_dir, "--database", "cli_db"])
    cli.main(["gold", "--database", "cli_db", "--strategy", "reuse_sales"])
    capsys.readouterr()
    cli.main(["page", "--mart", "sales_per_country", "--database", "cli_db"])
    out = json.loads(capsys.readouterr().out)
    assert out["total"] == 1 and out["data"][0]["Country"] == "France"
    assert out["data"][0]["total_sales"] == pytest.approx(2 * 3.0 + 1.5)
    returns = spark.table("cli_db.return_products").collect()
    assert len(returns) == 1 and returns[0]["total_returned"] == -1


def test_mart_builders_are_the_gold_marts():
    assert set(marts.MART_BUILDERS) == set(serving.MART_VIEWS)


def test_scratch_dir_without_checkpoint_setting():
    """A session with no checkpoint folder at all gets a private one through
    the SparkContext (the setting itself cannot change on a live session)."""
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from tillroll.session import scratch_dir, materialize\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.sparkContext.getCheckpointDir() is None\n"
        "d = scratch_dir(s); assert d == scratch_dir(s) and 'tillroll-ckpt-' in d\n"
        "assert materialize(s.range(5), 'probe').count() == 5\n"
        "print('OK')\n"
    ) % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="tillroll-noconf-"))
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("OK"), out.stderr[-2000:]


def test_one_pass_gold_plan_shape(spark, sf_small):
    """Static plan with broadcasts off (as for a large product master): lines
    are shuffled by invoice only and added up by country, day and code, with a
    map-side partial aggregate. These sums meet the products, and one expand
    for all three groupings stands above that join."""
    from __spark_entry__ import _layers

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        layers = _layers(spark, sf_small)
        measures = marts.mart_measures(layers.lines, layers.orders, layers.products)
        plan = measures._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plan.count("Expand [") == 1, plan
    assert plan.count("Exchange hashpartitioning(InvoiceNo") == 2, plan
    above_expand, below = plan.split("Expand [", 1)
    # the groups of the marts alone are shuffled above the expand
    assert above_expand.count("Exchange") == 1, above_expand
    by_code, of_lines = below.index("hashpartitioning(StockCode"), below.index("partial_sum(CASE WHEN NOT IsCancel")
    assert by_code < of_lines, below
    # between the lines' scan and their partial sums nothing is hashed by stock code
    lines_side = below[of_lines:].split("FileScan", 1)[0]
    assert "hashpartitioning(StockCode" not in lines_side, below


def test_hot_day_is_written_by_several_tasks(spark):
    """Rebalanced partitioned writes split a day holding most of the rows."""
    from tillroll.sources.sinks import write_parquet

    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        df = spark.range(n).select(
            F.lit(2010).alias("year"),
            F.lit(1).alias("month"),
            F.when(F.col("id") % 3 == 0, (F.col("id") % 28) + 2).otherwise(F.lit(1)).cast("int").alias("day"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        out = os.path.join(tempfile.mkdtemp(prefix="tillroll-hotday-"), "t")
        write_parquet(df, out, partition_by=["year", "month", "day"])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot = os.path.join(out, "year=2010", "month=1", "day=1")
    cold = os.path.join(out, "year=2010", "month=1", "day=5")
    hot_files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    cold_files = [f for f in os.listdir(cold) if f.endswith(".parquet")]
    assert len(hot_files) > 1 and len(cold_files) == 1, (len(hot_files), len(cold_files))
    assert spark.read.parquet(out).count() == n


def _line_tables(spark, root, n_lines):
    """The tables of the flat extract, with three lines an order and 40 parts."""
    n_orders = -(-n_lines // 3)
    k = F.col("id")
    tables = {
        "nation": spark.range(2).select(k.alias("n_nationkey"), F.concat(F.lit("NATION_"), k).alias("n_name")),
        "customer": spark.range(10).select(k.alias("c_custkey"), (k % 2).alias("c_nationkey")),
        "part": spark.range(40).select(
            k.alias("p_partkey"), F.concat(F.lit("part "), k).alias("p_name"), (k + 0.5).alias("p_retailprice")
        ),
        "orders": spark.range(n_orders).select(
            k.alias("o_orderkey"),
            (k % 10).alias("o_custkey"),
            F.lit("O").alias("o_orderstatus"),
            F.expr("timestamp'1998-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id % 150 AS INT))").alias("o_orderdate"),
        ),
        "lineitem": spark.range(n_lines).select(
            F.expr("id div 3").alias("l_orderkey"),
            (k % 37).alias("l_partkey"),
            (k % 3 + 1).cast("int").alias("l_linenumber"),
            F.lit(2.0).alias("l_quantity"),
            F.lit("N").alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"),
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")


def test_tasks_of_the_flat_extract_get_a_bounded_number_of_lines(spark, tmp_path, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    _line_tables(spark, tmp_path, 300 * cores)
    small = extracts.split_products(extracts.concat_extracts(*retail_views.yearly_extracts(spark, str(tmp_path))))
    expected = sorted(map(tuple, small.collect()))
    assert expected == sorted((str(p), f"part {p}", p + 0.5) for p in range(37))
    monkeypatch.setattr(retail_views, "LINES_PER_TASK", 50, raising=False)
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in thresholds}
    try:
        for k in thresholds:
            spark.conf.set(k, "-1")
        flat = retail_views.flat_extract(spark, str(tmp_path))
        assert len(flat.collect()) == 300 * cores
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    ran = flat._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Adaptive execution had merged these partitions into one, below both sorts.
    for key in ("l_orderkey", "o_orderkey"):
        assert re.search(rf"Sort \[{key}\b[^\n]*\n[ :|+-]*ShuffleQueryStage[^\n]*\n[ :|+-]*Exchange hashpartitioning\({key}#\w+, {6 * cores}\)", ran), ran
    split = extracts.split_products(extracts.concat_extracts(*retail_views.yearly_extracts(spark, str(tmp_path))))
    assert sorted(map(tuple, split.collect())) == expected


def test_lines_are_narrow_where_they_meet_the_orders(spark, tmp_path):
    _line_tables(spark, tmp_path, 300)
    lines = retail_views.lines_extract(spark, str(tmp_path))
    above = lines._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(l_orderkey")
    assert len(above) == 2
    for column in ("l_linenumber", "l_returnflag", "l_linestatus"):
        assert column not in above[0] and column in above[1]
    rows = lines.collect()
    assert len(rows) == 300
    got = {(r.StockCode, r.Quantity) for r in rows if r.InvoiceNo == "5"}  # lines 15 to 17; part 15 is padded on second lines
    assert got == {("15", 2), ("16", 2), ("17", 2)}
    assert [r.StockCode for r in rows if r.StockCode and r.StockCode.startswith(" ") and r.StockCode != " d "] == [
        " 15 " for i in range(300) if i % 37 == 15 and i % 3 == 1
    ]
