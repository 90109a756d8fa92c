"""

Each query reads the driver's test tables, derives the retail extracts from
them (``tillroll.sources.retail_views``) and runs the library's operators
over the whole of them. ``oracle_sql`` states the same result independently
in DuckDB SQL: the extract rules are written again as SQL views below.

Comparison conventions (both sides): money is ``decimal(18,2)`` rounded to
cents, integer sums are BIGINT, date parts INTEGER, and pages / top-k lists
order by their measure and then by the mart's grain keys ascending.
"""

from __future__ import annotations

import functools
import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import as_money
from tillroll.operators import keyset, marts, reconcile, serving, validation
from tillroll.plans import bronze, compact, gold, incremental, manifest, silver
from tillroll.plans.layers import RetailLayers
from tillroll.schemas import DATE_PARTS, FLAT_EXTRACT, LINES_RAW, PRODUCTS_RAW
from tillroll.session import materialize, run_actions, scratch_path
from tillroll.sources import clustered, extracts, retail_views
from tillroll.sources.broken import read_csv_checked
from tillroll.sources.sinks import INGEST_PARTITIONS, write_csv, write_parquet, write_table
from tillroll.sources.tables import read_parquet, read_table

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"

# Page requests exercised by the page queries (page number, page size): the
# API default size for countries, the dashboard's table size for the others.
COUNTRY_PAGE = (2, serving.DEFAULT_PAGE_SIZE)
PRODUCT_PAGE = (3, serving.TABLE_PAGE_SIZE)
RETURN_PAGE = (1, serving.TABLE_PAGE_SIZE)
PERIOD_PAGE = (2, serving.TABLE_PAGE_SIZE)
RANKED_PAGE = (15, 50)
DEEP_PAGE = (13, 100)
# Page size and number of the page that is reached by cursors.
KEYSET_WALKS = {"sales_per_country": (10, 3), "top_products": (20, 4), "return_products": (20, 2), "sales_by_period": (100, 3)}
PERIOD_YEAR = 1997
PERIOD_MONTH = None
SERIES_YEAR = 1998
SERIES_MONTH = 6

MONEY_COLUMNS = {
    "sales_per_country": ("total_sales",),
    "top_products": ("total_revenue",),
    "return_products": ("total_loss",),
    "sales_by_period": ("total_sales",),
}


def _layers(spark: SparkSession, sf_dir: str) -> RetailLayers:
    return RetailLayers(
        products_raw=retail_views.products_extract(spark, sf_dir),
        orders_raw=retail_views.orders_extract(spark, sf_dir),
        lines_raw=retail_views.lines_extract(spark, sf_dir),
    )


def _mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart with its money columns as cents-rounded decimals."""
    return as_money(_layers(spark, sf_dir).mart(name), *MONEY_COLUMNS[name])


# ---------------------------------------------------------------------------
# Spark side.


def q_scan_parquet(spark, d):
    return retail_views.lines_extract(spark, d)


def q_partition_roundtrip(spark, d):
    out = scratch_path(spark, "orders-bronze")
    write_parquet(_layers(spark, d).orders_bronze, out, partition_by=DATE_PARTS)
    return read_parquet(spark, out).select("InvoiceNo", "InvoiceDate", "CustomerID", "Country", *DATE_PARTS)


def q_products_trimmed(spark, d):
    return _layers(spark, d).products_trimmed


def q_orders_date_parts(spark, d):
    return _layers(spark, d).orders_bronze


def q_orders_parsed(spark, d):
    return _layers(spark, d).orders_parsed


def q_orders_customer_default(spark, d):
    return _layers(spark, d).orders.select("InvoiceNo", "CustomerID")


def q_orders_country_norm(spark, d):
    return _layers(spark, d).orders.select("InvoiceNo", "Country")


def q_orders_cancel_flag(spark, d):
    return _layers(spark, d).orders.select("InvoiceNo", "IsCancel")


def q_products_valid(spark, d):
    return _layers(spark, d).products_valid


def q_products_invalid(spark, d):
    return _layers(spark, d).products_invalid


def q_orders_valid(spark, d):
    return _layers(spark, d).orders


def q_orders_invalid(spark, d):
    return _layers(spark, d).orders_invalid


def q_lines_valid(spark, d):
    return _layers(spark, d).lines


def q_lines_invalid(spark, d):
    return _layers(spark, d).lines_invalid


def q_validation_summary(spark, d):
    return _layers(spark, d).validation_counts()


def q_products_master(spark, d):
    return as_money(_layers(spark, d).products, "UnitPrice")


def q_sales_lines(spark, d):
    return as_money(_layers(spark, d).sales, "UnitPrice", "Amount")


def q_sales_per_country(spark, d):
    return _mart(spark, d, "sales_per_country")


def q_top_products(spark, d):
    return _mart(spark, d, "top_products")


def q_return_products(spark, d):
    return _mart(spark, d, "return_products")


def q_sales_by_period(spark, d):
    return _mart(spark, d, "sales_by_period")


def _page(spark, d, name, page_no, size, **filters):
    rows, _ = serving.mart_page(_mart(spark, d, name), name, page_no, size, **filters)
    return rows


def q_page_sales_per_country(spark, d):
    return _page(spark, d, "sales_per_country", *COUNTRY_PAGE)


def q_page_top_products(spark, d):
    return _page(spark, d, "top_products", *PRODUCT_PAGE)


def q_page_return_products(spark, d):
    return _page(spark, d, "return_products", *RETURN_PAGE)


def q_page_periodic(spark, d):
    return _page(spark, d, "sales_by_period", *PERIOD_PAGE, year=PERIOD_YEAR, month=PERIOD_MONTH)


def q_page_periodic_ranked(spark, d):
    """A page served through the distributed ranking path: the day mart is
    range-sorted across tasks once and only the partitions holding ranks
    700-749 are read."""
    mart = _mart(spark, d, "sales_by_period")
    view = serving.ranked_view(mart, serving.MART_VIEWS["sales_by_period"].page_order())
    return view.page(*RANKED_PAGE)


def q_period_filtered(spark, d):
    return serving.period_filter(_mart(spark, d, "sales_by_period"), SERIES_YEAR, SERIES_MONTH)


def _measures(spark, d):
    """All four marts' measures from one pass over the lines, stored once."""
    layers = _layers(spark, d)
    return materialize(marts.mart_measures(layers.lines, layers.orders, layers.products), "measures")


def _ordered(spark, d, name):
    """A mart in its batch order, with each row's place in it."""
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in serving.MART_SORT[name]]
    return serving.ranked_view(_mart(spark, d, name), order, f"ordered-{name}").ranked()


def q_page_top_products_deep(spark, d):
    view = serving.ranked_view(_mart(spark, d, "top_products"), serving.MART_VIEWS["top_products"].page_order())
    return serving.page(view, [], *DEEP_PAGE)


def q_period_series_all(spark, d):
    return serving.period_series(_mart(spark, d, "sales_by_period"))


def _display(spark, d, name):
    return serving.display_rows(_layers(spark, d).mart(name), name)


def q_silver_orders_table(spark, d):
    """Valid orders through a catalog table in day folders."""
    return _through_table(_layers(spark, d).orders, DATE_PARTS)


def q_silver_invalid_products_table(spark, d):
    """Quarantined products through a catalog table."""
    return _through_table(_layers(spark, d).products_invalid)


def _through_table(df, partition_by=None):
    name = f"default.q_{uuid.uuid4().hex[:16]}"
    write_table(df, name, partition_by=partition_by)
    return read_table(df.sparkSession, name)


def q_page_meta(spark, d):
    requests = [
        ("sales_per_country", COUNTRY_PAGE, {}),
        ("top_products", PRODUCT_PAGE, {}),
        ("return_products", RETURN_PAGE, {}),
        ("sales_by_period", PERIOD_PAGE, {"year": PERIOD_YEAR, "month": PERIOD_MONTH}),
    ]
    measures = _measures(spark, d)
    counts = marts.mart_counts(measures)
    metas = []
    for name, (page_no, size), filters in requests:
        if filters:
            mart = marts.marts_from_measures(measures)[name]
            meta = serving.page_meta(serving.period_filter(mart, **filters), page_no, size)
        else:
            meta = serving.page_meta_from_counts(counts, name, page_no, size)
        metas.append(meta.select(F.lit(name).alias("mart"), "*"))
    return functools.reduce(DataFrame.unionByName, metas)


def q_overview_kpis(spark, d):
    layers = _layers(spark, d)
    return serving.kpis_from_counts(marts.mart_counts(marts.mart_measures(layers.lines, layers.orders, layers.products)))


def q_country_series(spark, d):
    return serving.country_series(_mart(spark, d, "sales_per_country"))


def q_top_products_series(spark, d):
    return serving.top_products_series(_mart(spark, d, "top_products"))


def q_returns_series(spark, d):
    return serving.returns_series(_mart(spark, d, "return_products"))


def q_period_series(spark, d):
    return serving.period_series(_mart(spark, d, "sales_by_period"), SERIES_YEAR, SERIES_MONTH)


def q_country_display(spark, d):
    return _display(spark, d, "sales_per_country")


def q_landed_sales_by_period(spark, d):
    """The whole flow through storage: the three extracts as CSV datasets,
    landed by the bronze ingest, cleaned from the landed Parquet and turned
    into marts by the (one-pass) gold job."""
    root = scratch_path(spark, "landed")
    layers = _layers(spark, d)
    datasets = {"products": layers.products_raw, "orders": layers.orders_raw, "orders_line": layers.lines_raw}
    run_actions([lambda n=n, df=df: write_csv(df, f"{root}/csv/{n}.csv") for n, df in datasets.items()])
    bronze.ingest(spark, bronze.standard_specs(f"{root}/csv", f"{root}/bronze"))
    landed = silver.layers_from_bronze(
        spark, f"{root}/bronze/products_partitioned", f"{root}/bronze/orders_partitioned", f"{root}/bronze/orders_line"
    )
    return as_money(gold.build_marts_from_layers(landed)["sales_by_period"], "total_sales")


def _extract_parts(spark, d):
    a, b = retail_views.yearly_extracts(spark, d)
    return extracts.concat_extracts(a, b)


def q_split_union(spark, d):
    return _extract_parts(spark, d)


def q_extract_csv_roundtrip(spark, d):
    """Both yearly extracts written as Latin-1 CSV and read back with the
    declared schema, then concatenated. As with any CSV extract, empty text
    reads back as NULL."""
    root = scratch_path(spark, "extracts-csv")
    parts = dict(zip([f"{root}/a", f"{root}/b"], retail_views.yearly_extracts(spark, d)))
    run_actions([lambda p=p, df=df: write_csv(df, p, encoding=extracts.LATIN_1) for p, df in parts.items()])
    back = [extracts.read_latin1_csv(spark, p, schema=FLAT_EXTRACT) for p in parts]
    return extracts.concat_extracts(*back)


def q_split_products(spark, d):
    return extracts.split_products(_extract_parts(spark, d))


def q_split_orders(spark, d):
    return extracts.split_orders(_extract_parts(spark, d))


def q_split_lines(spark, d):
    return extracts.split_lines(_extract_parts(spark, d))


def _measured_mart(spark, d, name):
    """A mart as the gold job builds it by default: from daily sums."""
    return as_money(gold.build_marts_from_layers(_layers(spark, d))[name], *MONEY_COLUMNS[name])


# Per mart: key, amount, lines and quantity, for reports over all four.
STACKED = {
    "sales_per_country": (["Country"], "total_sales", "number_of_orders", "total_quantity"),
    "top_products": (["StockCode", "Description"], "total_revenue", "number_of_sales", "total_quantity_sold"),
    "return_products": (["StockCode", "Description"], "total_loss", "number_of_returns", "total_returned"),
    "sales_by_period": (DATE_PARTS, "total_sales", "number_of_orders", "total_quantity"),
}


def _stacked(built: dict[str, DataFrame], amount_type: str | None = None) -> DataFrame:
    """All four marts as rows ``mart, key, amount, n_lines, quantity``."""
    parts = [
        built[name].select(
            F.lit(name).alias("mart"),
            F.concat_ws("|", *keys).alias("key"),
            (F.col(amount).cast(amount_type) if amount_type else F.round(amount, 2).cast("decimal(18,2)")).alias("amount"),
            F.col(lines).alias("n_lines"),
            F.col(quantity).alias("quantity"),
        )
        for name, (keys, amount, lines, quantity) in STACKED.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def q_incremental_marts(spark, d):
    """All marts from stored daily sums, after a first delivery of everything
    in which the first and the last day were wrong, and a second one of these
    two days alone."""
    layers = _layers(spark, d)
    orders = materialize(layers.orders.select("InvoiceNo", "Country", "IsCancel", *DATE_PARTS), "orders-delivered")
    edge = orders.agg(*[f(F.struct(*DATE_PARTS)).alias(f.__name__) for f in (F.min, F.max)]).first()
    days = [tuple(x) for x in edge if x is not None]
    wrong = F.struct(*DATE_PARTS).isin(*[F.struct(*[F.lit(p) for p in day]) for day in days]) if days else F.lit(False)
    store = incremental.DailySums(spark, scratch_path(spark, "daily-sums"))
    store.deliver(layers.lines, orders.withColumn("Country", F.when(wrong, F.lit("Wrong")).otherwise(F.col("Country"))))
    store.deliver(layers.lines, incremental.of_days(orders, days))
    return _stacked(store.marts(layers.products))


def q_incremental_product_master(spark, d):
    """The product master with both yearly extracts in, and after the first
    one was withdrawn."""
    a, b = retail_views.yearly_extracts(spark, d)
    store = incremental.ProductCounts(spark, scratch_path(spark, "product-counts"))
    store.add("A", a)
    store.add("B", b)
    both = materialize(store.master(), "master-of-both")
    store.withdraw("A")
    states = {"both": both, "second": store.master()}
    return functools.reduce(
        DataFrame.unionByName, [as_money(df, "UnitPrice").select(F.lit(name).alias("state"), "*") for name, df in states.items()]
    )


def q_exact_marts(spark, d):
    """All marts in exact decimals."""
    layers = _layers(spark, d)
    return _stacked(gold.build_marts(layers.lines, layers.orders, layers.exact_products), "decimal(28,6)")


def _joined(spark, d, build):
    """A report over the three inputs of the sales lines."""
    layers = _layers(spark, d)
    return build(layers.lines, layers.orders, layers.products)


def _keyset_walk(spark, d, name, page_size, pages):
    """Pages of a mart, each asked for with the cursor that ends the page
    before it, as a client does. The last one is returned."""
    view = keyset.keyset_view(_mart(spark, d, name), keyset.mart_order(name), f"keyset-{name}")
    cursor = None
    for _ in range(pages - 1):
        rows = view.page(cursor, page_size).collect()  # a page
        cursor = keyset.decode_cursor(keyset.encode_cursor(view.cursor_of(rows[-1])))
    return view.page(cursor, page_size)


def q_rule_counters(spark, d):
    """Failures of each rule, counted by the writes of both sides."""
    _, splits = _layers(spark, d).written(scratch_path(spark, "splits"))
    return validation.rule_counts(splits, spark)


def q_written_lines_invalid(spark, d):
    """Quarantined lines from the one write of both sides."""
    lines = _layers(spark, d).lines_raw
    return validation.write_split(lines, validation.line_rules(), scratch_path(spark, "split-lines")).invalid


LINES_HEADER = "InvoiceNo,StockCode,Quantity"


def _damaged_lines(spark, d):
    """The lines as CSV records, some of them damaged: without their last
    field, with one more, or with a quantity that is no number."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("InvoiceNo", "StockCode", "Quantity")]
    q = F.col("Quantity")
    record = (
        F.when(q == 13, F.concat_ws(",", *text[:2]))
        .when(q == 17, F.concat_ws(",", *text, F.lit("extra")))
        .when(q == 19, F.concat(F.concat_ws(",", *text), F.lit(" pcs")))
        .when(q == 23, F.concat(F.concat_ws(",", *text), F.lit(".0")))
        .otherwise(F.concat_ws(",", *text))
    )
    return retail_views.lines_extract(spark, d).select(record.alias(LINES_HEADER))


def _checked_lines(spark, d):
    path = scratch_path(spark, "damaged-lines")
    # One text column under the whole header: records are written as they are.
    writer = _damaged_lines(spark, d).write.option("header", True).option("sep", "\x01").option("quote", "").option("emptyValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv_checked(spark, path, LINES_RAW, multi_line=False)


def q_csv_good_lines(spark, d):
    return _checked_lines(spark, d).good


def q_csv_broken_lines(spark, d):
    return _checked_lines(spark, d).broken.select("record", "reason")


def q_manifest_lines(spark, d):
    """Lines landed by four runs over a growing inbox, one of them repeated."""
    root = scratch_path(spark, "inbox")
    landed = manifest.LandedFiles(spark, f"{root}/landed", bronze.DatasetSpec("orders_line", f"{root}/csv", "", multi_line=False))
    lines = retail_views.lines_extract(spark, d).withColumn("_part", F.pmod(F.xxhash64("InvoiceNo", "StockCode"), F.lit(3)))
    lines = materialize(lines, "lines-delivered")
    for part in range(3):
        write_csv(lines.filter(F.col("_part") == part).drop("_part"), f"{root}/csv/{part}")
        landed.run()
    landed.run()
    return landed.rows().drop(manifest.FILE_COLUMN)


def _clustered_lines(spark, d):
    path = scratch_path(spark, "clustered-lines")
    clustered.write_clustered(retail_views.lines_extract(spark, d), path, ("InvoiceNo", "StockCode"), files=64)
    return path


def q_clustered_lines(spark, d):
    return read_parquet(spark, _clustered_lines(spark, d))


def q_clustered_point_reads(spark, d):
    """Lines of one invoice and lines of one product, each from the few files
    that may have them."""
    path = _clustered_lines(spark, d)
    invoice, code = read_parquet(spark, path).agg(F.max("InvoiceNo"), F.max("StockCode")).first()
    reads = {"invoice": {"InvoiceNo": invoice}, "product": {"StockCode": code}, "no invoice": {"InvoiceNo": None}}
    parts = [clustered.read_where(spark, path, **equals).select(F.lit(name).alias("read_by"), "*") for name, equals in reads.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def q_compacted_months(spark, d):
    """Orders landed by month in two deliveries, then compacted: rows and
    files of every month."""
    path, parts = scratch_path(spark, "orders-compacted"), ("year", "month")
    orders = materialize(_layers(spark, d).orders_bronze, "orders-to-land")
    second = F.coalesce(F.pmod(F.xxhash64("InvoiceNo"), F.lit(2)), F.lit(0)) == 1
    write_parquet(orders.filter(~second), path, partition_by=parts)
    write_parquet(orders.filter(second), path, partition_by=parts, mode="append")
    compact.compact(spark, path, parts)
    stored = read_parquet(spark, path).withColumn("_file", F.col("_metadata.file_path"))
    return stored.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("_file").alias("n_files"),
        F.count("CustomerID").alias("n_customers"),
        F.count_distinct("day").alias("n_days"),
    )


def q_landed_in_eight_files(spark, d):
    """Lines landed in the fixed number of files: rows and files."""
    path = scratch_path(spark, "eight-files")
    write_parquet(retail_views.lines_extract(spark, d), path, num_partitions=INGEST_PARTITIONS)
    stored = read_parquet(spark, path).withColumn("_file", F.col("_metadata.file_path"))
    return stored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_file").alias("n_files"), F.sum("Quantity").alias("quantity")
    )


def q_headers_cleaned(spark, d):
    """Products from a CSV whose header has a byte order mark and blanks."""
    path = scratch_path(spark, "marked-header")
    write_csv(retail_views.products_extract(spark, d).toDF("\ufeffStockCode", " Description ", "UnitPrice "), path)
    return extracts.read_csv(spark, path, schema=PRODUCTS_RAW, multi_line=False)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_parquet": q_scan_parquet,
    "partition_roundtrip": q_partition_roundtrip,
    "products_trimmed": q_products_trimmed,
    "orders_date_parts": q_orders_date_parts,
    "orders_parsed": q_orders_parsed,
    "orders_customer_default": q_orders_customer_default,
    "orders_country_norm": q_orders_country_norm,
    "orders_cancel_flag": q_orders_cancel_flag,
    "products_valid": q_products_valid,
    "products_invalid": q_products_invalid,
    "orders_valid": q_orders_valid,
    "orders_invalid": q_orders_invalid,
    "lines_valid": q_lines_valid,
    "lines_invalid": q_lines_invalid,
    "validation_summary": q_validation_summary,
    "products_master": q_products_master,
    "sales_lines": q_sales_lines,
    "sales_per_country": q_sales_per_country,
    "top_products": q_top_products,
    "return_products": q_return_products,
    "sales_by_period": q_sales_by_period,
    "page_sales_per_country": q_page_sales_per_country,
    "page_top_products": q_page_top_products,
    "page_return_products": q_page_return_products,
    "page_periodic": q_page_periodic,
    "page_periodic_ranked": q_page_periodic_ranked,
    "period_filtered": q_period_filtered,
    "page_meta": q_page_meta,
    "overview_kpis": q_overview_kpis,
    "country_series": q_country_series,
    "top_products_series": q_top_products_series,
    "returns_series": q_returns_series,
    "period_series": q_period_series,
    "country_display": q_country_display,
    **{f"ordered_{n}": functools.partial(_ordered, name=n) for n in serving.MART_SORT},
    "page_top_products_deep": q_page_top_products_deep,
    "period_series_all": q_period_series_all,
    "product_display": functools.partial(_display, name="top_products"),
    "return_display": functools.partial(_display, name="return_products"),
    "period_display": functools.partial(_display, name="sales_by_period"),
    "silver_orders_table": q_silver_orders_table,
    "silver_invalid_products_table": q_silver_invalid_products_table,
    "landed_sales_by_period": q_landed_sales_by_period,
    "split_union": q_split_union,
    "extract_csv_roundtrip": q_extract_csv_roundtrip,
    "split_products": q_split_products,
    "split_orders": q_split_orders,
    "split_lines": q_split_lines,
    **{f"measured_{n}": functools.partial(_measured_mart, name=n) for n in marts.MART_BUILDERS},
    "incremental_marts": q_incremental_marts,
    "incremental_product_master": q_incremental_product_master,
    "exact_marts": q_exact_marts,
    "sales_loss_report": functools.partial(_joined, build=reconcile.loss_report),
    "sales_lost_lines": functools.partial(_joined, build=reconcile.lost_lines),
    "line_outcomes": functools.partial(_joined, build=reconcile.line_outcomes),
    **{f"keyset_{n}": functools.partial(_keyset_walk, name=n, page_size=size, pages=pages) for n, (size, pages) in KEYSET_WALKS.items()},
    "rule_counters": q_rule_counters,
    "written_lines_invalid": q_written_lines_invalid,
    "csv_good_lines": q_csv_good_lines,
    "csv_broken_lines": q_csv_broken_lines,
    "manifest_lines": q_manifest_lines,
    "clustered_lines": q_clustered_lines,
    "clustered_point_reads": q_clustered_point_reads,
    "compacted_months": q_compacted_months,
    "landed_in_eight_files": q_landed_in_eight_files,
    "headers_cleaned": q_headers_cleaned,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: sales per country over the sf0.001 tables (25 rows)."""
    return q_sales_per_country(spark, FLAGSHIP_SF_DIR)


def _optional() -> tuple[dict, dict]:
    """Queries and SQL of the optional operator subpackage and its pipeline;
    nothing where these are not installed. A dependency that they lack is an
    error."""
    if not (importlib.util.find_spec("tillroll.llm") and importlib.util.find_spec("corpus_pipeline")):
        return {}, {}
    import corpus_pipeline
    from tillroll.llm import queries as operators

    found, sql = dict(operators.QUERIES), dict(operators.ORACLE_SQL)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_optional()[0]}


# ---------------------------------------------------------------------------
# DuckDB side: the extract rules and every query, written as SQL.

_CUSTOMER_NATION = """
cust_nation AS (
  SELECT c.c_custkey, n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

_ORDERS_RAW = """
orders_raw AS (
  SELECT
    CASE WHEN o.o_orderkey % 500 = 1 THEN NULL
         WHEN o.o_orderkey % 500 = 2 THEN ''
         WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 = 0 THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
         ELSE CAST(o.o_orderkey AS VARCHAR) END AS InvoiceNo,
    CASE WHEN o.o_orderkey % 500 = 3 THEN NULL
         WHEN o.o_orderkey % 500 = 4 THEN 'not a date'
         ELSE strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') END AS InvoiceDate,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS CustomerID,
    CASE WHEN o.o_orderkey % 500 = 5 THEN NULL
         WHEN o.o_orderkey % 500 = 6 THEN ''
         WHEN cn.n_name = 'NATION_24' THEN 'Unspecified'
         ELSE cn.n_name END AS Country
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 500 = 7) o
  LEFT JOIN cust_nation cn ON o.o_custkey = cn.c_custkey
),
orders_bronze AS (
  SELECT InvoiceNo, InvoiceDate, CustomerID, Country,
    CAST(year(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS INTEGER) AS "year",
    CAST(month(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS INTEGER) AS "month",
    CAST(day(try_strptime(InvoiceDate, '%m/%d/%Y %H:%M')) AS INTEGER) AS "day"
  FROM orders_raw
),
orders_parsed AS (
  SELECT InvoiceNo, try_strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS InvoiceDate,
         CustomerID, Country, "year", "month", "day"
  FROM orders_bronze
),
orders_ok AS (
  SELECT *, COALESCE(InvoiceNo IS NOT NULL AND InvoiceNo <> '' AND InvoiceDate IS NOT NULL
                     AND Country IS NOT NULL AND Country <> '', FALSE) AS ok
  FROM orders_parsed
),
orders_silver AS (
  SELECT InvoiceNo, InvoiceDate,
    COALESCE(TRY_CAST(trunc(CustomerID) AS INTEGER), -1) AS CustomerID,
    CASE WHEN Country IS NULL OR Country = 'Unspecified' THEN 'Unknown' ELSE Country END AS Country,
    COALESCE(starts_with(InvoiceNo, 'C'), FALSE) AS IsCancel,
    "year", "month", "day"
  FROM orders_ok WHERE ok
)"""

_PRODUCT_OK = """COALESCE(
      StockCode IS NOT NULL AND StockCode <> ''
      AND upper(StockCode) NOT IN ('POST', 'POSTAGE', 'M', 'D', 'BANK CHARGES')
      AND Description IS NOT NULL AND Description <> ''
      AND NOT contains(lower(Description), 'bad debt')
      AND NOT contains(lower(Description), 'adjust')
      AND NOT contains(lower(Description), 'dotcom postage')
      AND NOT contains(lower(Description), 'amazon fee')
      AND UnitPrice IS NOT NULL AND UnitPrice > 0, FALSE)"""

_PRODUCTS_RAW = """
part_rows AS (
  SELECT p_partkey, p_name, p_retailprice FROM part
  UNION ALL
  SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'A ' || p_name ELSE p_name END, p_retailprice + 1.0
  FROM part WHERE p_partkey % 3 = 0
),
products_raw AS (
  SELECT
    CASE WHEN p_partkey % 200 = 1 THEN 'POST'
         WHEN p_partkey % 200 = 2 THEN 'M'
         WHEN p_partkey % 200 = 3 THEN ' d '
         WHEN p_partkey % 200 = 4 THEN ''
         WHEN p_partkey % 200 = 5 THEN NULL
         ELSE ' ' || CAST(p_partkey AS VARCHAR) || ' ' END AS StockCode,
    CASE WHEN p_partkey % 200 = 6 THEN 'Bad Debt x'
         WHEN p_partkey % 200 = 7 THEN 'ADJUST bad'
         WHEN p_partkey % 200 = 8 THEN 'Dotcom Postage'
         WHEN p_partkey % 200 = 9 THEN 'AMAZON FEE'
         WHEN p_partkey % 200 = 10 THEN NULL
         WHEN p_partkey % 200 = 11 THEN '   '
         ELSE ' ' || p_name || CASE WHEN p_partkey % 4 = 0 THEN ' deluxe edition in gift box' ELSE '' END || ' '
    END AS Description,
    CASE WHEN p_partkey % 200 = 12 THEN NULL
         WHEN p_partkey % 200 = 13 THEN 0.0
         WHEN p_partkey % 200 = 14 THEN -5.0
         ELSE p_retailprice END::DOUBLE AS UnitPrice
  FROM part_rows
),
products_trimmed AS (
  SELECT trim(StockCode) AS StockCode, trim(Description) AS Description, UnitPrice FROM products_raw
),
products_ok AS (
  SELECT *, """ + _PRODUCT_OK + """ AS ok
  FROM products_trimmed
),
products_master AS (
  SELECT StockCode, min(Description) AS Description, avg(UnitPrice) AS UnitPrice
  FROM products_ok WHERE ok GROUP BY StockCode
)"""

_LINES_RAW = """
lines_raw AS (
  SELECT
    CASE WHEN l.l_orderkey % 500 = 1 THEN NULL
         WHEN l.l_orderkey % 500 = 2 THEN ''
         WHEN o.o_orderstatus = 'F' AND l.l_orderkey % 5 = 0 THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
         ELSE CAST(l.l_orderkey AS VARCHAR) END AS InvoiceNo,
    CASE WHEN l.l_partkey % 200 = 1 THEN 'POST'
         WHEN l.l_partkey % 200 = 2 THEN 'M'
         WHEN l.l_partkey % 200 = 3 THEN ' d '
         WHEN l.l_partkey % 200 = 4 THEN ''
         WHEN l.l_partkey % 200 = 5 THEN NULL
         WHEN l.l_partkey % 200 = 15 AND l.l_linenumber = 2 THEN ' ' || CAST(l.l_partkey AS VARCHAR) || ' '
         ELSE CAST(l.l_partkey AS VARCHAR) END AS StockCode,
    CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 1000 = 1 THEN NULL
         WHEN (l.l_orderkey * 7 + l.l_linenumber) % 1000 = 2 THEN 0
         WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN CAST(trunc(-l.l_quantity) AS INTEGER)
         ELSE CAST(trunc(l.l_quantity) AS INTEGER) END AS Quantity
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
lines_ok AS (
  SELECT *, COALESCE(InvoiceNo IS NOT NULL AND InvoiceNo <> '' AND StockCode IS NOT NULL
                     AND StockCode <> '' AND Quantity IS NOT NULL AND Quantity <> 0, FALSE) AS ok
  FROM lines_raw
)"""

_SALES = """
sales AS (
  SELECT l.StockCode, l.InvoiceNo, l.Quantity, o.InvoiceDate, o.CustomerID, o.Country, o.IsCancel,
         o."year", o."month", o."day", p.Description, p.UnitPrice, l.Quantity * p.UnitPrice AS Amount
  FROM lines_ok l
  JOIN orders_silver o ON l.InvoiceNo = o.InvoiceNo
  JOIN products_master p ON l.StockCode = p.StockCode
  WHERE l.ok
)"""

_MARTS = """
m_country AS (
  SELECT Country, sum(Amount) AS total_sales, count(InvoiceNo) AS number_of_orders,
         CAST(sum(Quantity) AS BIGINT) AS total_quantity
  FROM sales WHERE NOT IsCancel GROUP BY Country
),
m_products AS (
  SELECT StockCode, Description, sum(Amount) AS total_revenue,
         CAST(sum(Quantity) AS BIGINT) AS total_quantity_sold, count(InvoiceNo) AS number_of_sales
  FROM sales WHERE NOT IsCancel GROUP BY StockCode, Description
),
m_returns AS (
  SELECT StockCode, Description, CAST(sum(Quantity) AS BIGINT) AS total_returned,
         count(InvoiceNo) AS number_of_returns, sum(Amount) AS total_loss
  FROM sales WHERE Quantity < 0 OR IsCancel GROUP BY StockCode, Description
),
m_period AS (
  SELECT "year", "month", "day", sum(Amount) AS total_sales, count(InvoiceNo) AS number_of_orders,
         CAST(sum(Quantity) AS BIGINT) AS total_quantity
  FROM sales WHERE NOT IsCancel GROUP BY "year", "month", "day"
),
country AS (
  SELECT Country, CAST(round(total_sales, 2) AS DECIMAL(18,2)) AS total_sales, number_of_orders, total_quantity
  FROM m_country
),
products AS (
  SELECT StockCode, Description, CAST(round(total_revenue, 2) AS DECIMAL(18,2)) AS total_revenue,
         total_quantity_sold, number_of_sales
  FROM m_products
),
returns AS (
  SELECT StockCode, Description, total_returned, number_of_returns,
         CAST(round(total_loss, 2) AS DECIMAL(18,2)) AS total_loss
  FROM m_returns
),
period AS (
  SELECT "year", "month", "day", CAST(round(total_sales, 2) AS DECIMAL(18,2)) AS total_sales,
         number_of_orders, total_quantity
  FROM m_period
)"""

_FLAT = """
flat AS (
  SELECT
    CASE WHEN o.o_orderkey % 500 = 1 THEN NULL
         WHEN o.o_orderkey % 500 = 2 THEN ''
         WHEN o.o_orderstatus = 'F' AND o.o_orderkey % 5 = 0 THEN 'C' || CAST(o.o_orderkey AS VARCHAR)
         ELSE CAST(o.o_orderkey AS VARCHAR) END AS InvoiceNo,
    CAST(l.l_partkey AS VARCHAR) AS StockCode,
    p.p_name AS Description,
    CAST(trunc(l.l_quantity) AS INTEGER) AS Quantity,
    strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') AS InvoiceDate,
    p.p_retailprice AS UnitPrice,
    CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS CustomerID,
    cn.n_name AS Country,
    CAST(o.o_orderdate AS DATE) AS odate
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN cust_nation cn ON o.o_custkey = cn.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
merged AS (
  SELECT * EXCLUDE (odate) FROM flat WHERE odate < DATE '1998-04-01'
  UNION ALL
  SELECT * EXCLUDE (odate) FROM flat WHERE odate >= DATE '1998-03-01'
)"""

# Prices as integers of 1/10000, mean prices and amounts as integers of 1/1000000.
_EXACT = """
products_exact AS (
  SELECT StockCode, min(Description) AS Description,
         (200 * sum(CAST(round(UnitPrice * 10000) AS HUGEINT)) + count(*)) // (2 * count(*)) AS units
  FROM products_ok WHERE ok GROUP BY StockCode
),
sales_exact AS (
  SELECT l.StockCode, l.Quantity, o.Country, o.IsCancel, o."year", o."month", o."day", p.Description, l.Quantity * p.units AS units
  FROM lines_ok l
  JOIN orders_silver o ON l.InvoiceNo = o.InvoiceNo
  JOIN products_exact p ON l.StockCode = p.StockCode
  WHERE l.ok
),
exact_marts AS (
  SELECT 'sales_per_country' AS mart, Country AS key, sum(units) AS units, count(*) AS n_lines, sum(Quantity) AS quantity
  FROM sales_exact WHERE NOT IsCancel GROUP BY Country
  UNION ALL SELECT 'top_products', StockCode || '|' || Description, sum(units), count(*), sum(Quantity)
  FROM sales_exact WHERE NOT IsCancel GROUP BY StockCode, Description
  UNION ALL SELECT 'return_products', StockCode || '|' || Description, sum(units), count(*), sum(Quantity)
  FROM sales_exact WHERE Quantity < 0 OR IsCancel GROUP BY StockCode, Description
  UNION ALL SELECT 'sales_by_period', concat_ws('|', "year", "month", "day"), sum(units), count(*), sum(Quantity)
  FROM sales_exact WHERE NOT IsCancel GROUP BY "year", "month", "day"
)"""

_OUTCOMES = """
order_rows AS (SELECT InvoiceNo, count(*) AS order_rows FROM orders_silver GROUP BY InvoiceNo),
outcomes AS (
  SELECT l.InvoiceNo, l.StockCode, l.Quantity, coalesce(order_rows, 0) AS order_rows,
    CASE WHEN order_rows IS NULL THEN 'without_order' WHEN p.StockCode IS NULL THEN 'without_product'
         WHEN order_rows > 1 THEN 'fanned_out' ELSE 'sold' END AS outcome
  FROM lines_ok l LEFT JOIN order_rows USING (InvoiceNo) LEFT JOIN products_master p ON l.StockCode = p.StockCode
  WHERE l.ok
)"""

_VIEWS = {
    "outcomes": _OUTCOMES,
    "exact": _EXACT,
    "cust": _CUSTOMER_NATION,
    "orders": _ORDERS_RAW,
    "products": _PRODUCTS_RAW,
    "lines": _LINES_RAW,
    "sales": _SALES,
    "marts": _MARTS,
    "flat": _FLAT,
}
_DEPENDS = {
    "orders": ["cust"],
    "lines": [],
    "products": [],
    "sales": ["orders", "products", "lines"],
    "marts": ["sales"],
    "flat": ["cust"],
    "cust": [],
    "exact": ["orders", "products", "lines"],
    "outcomes": ["orders", "products", "lines"],
}


def _with(*names: str) -> str:
    """``WITH`` clause holding the named views and what they depend on."""
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in _DEPENDS[n]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",".join(_VIEWS[n] for n in order) + "\n"


def _money(col: str) -> str:
    return f"CAST(round({col}, 2) AS DECIMAL(18,2))"


_MART_SELECT = {
    "sales_per_country": "SELECT * FROM country",
    "top_products": "SELECT * FROM products",
    "return_products": "SELECT * FROM returns",
    "sales_by_period": "SELECT * FROM period",
}


def _page_sql(source: str, order: str, page_no: int, size: int, where: str = "") -> str:
    return f"SELECT * FROM {source} {where} ORDER BY {order} LIMIT {size} OFFSET {(page_no - 1) * size}"


def _period_where(year, month) -> str:
    conds = []
    if year is not None:
        conds.append(f'"year" = {int(year)}')
    if month is not None:
        conds.append(f'"month" = {int(month)}')
    return ("WHERE " + " AND ".join(conds)) if conds else ""


_ORDER = {
    "sales_per_country": "total_sales DESC, Country ASC",
    "top_products": "total_revenue DESC, StockCode ASC, Description ASC",
    "return_products": "total_loss ASC, StockCode ASC, Description ASC",
    "sales_by_period": 'total_sales DESC, "year" ASC, "month" ASC, "day" ASC',
}


def _meta_sql(mart: str, source: str, page_no: int, size: int, where: str = "") -> str:
    return (
        f"SELECT '{mart}' AS mart, count(*) AS total, {page_no} AS page, {size} AS page_size, "
        f"CAST((count(*) + {size - 1}) // {size} AS BIGINT) AS total_pages FROM {source} {where}"
    )


def _shown_money(col: str) -> str:
    shown = f"translate(format('{{:,.2f}}', round({col}, 2) + 0.0), ',.', chr(8239) || ',')"
    return f"{shown} || ' ' || chr(8364) AS {col}"


def _shown_integer(col: str) -> str:
    return f"translate(format('{{:,}}', {col}), ',', chr(8239)) AS {col}"


def _present_sql(*columns: str) -> dict[str, str]:
    found = {}
    for c in columns:
        found |= {f"{c}_not_null": f"{c} IS NOT NULL", f"{c}_not_empty": f"{c} <> ''"}
    return found


_RULES_SQL = [
    (
        "products",
        "products_trimmed",
        _present_sql("StockCode", "Description")
        | {"StockCode_is_product": "upper(StockCode) NOT IN ('POST', 'POSTAGE', 'M', 'D', 'BANK CHARGES')"}
        | {f"Description_not_{x.replace(' ', '_')}": f"NOT contains(lower(Description), '{x}')" for x in ("bad debt", "adjust", "dotcom postage", "amazon fee")}
        | {"UnitPrice_not_null": "UnitPrice IS NOT NULL", "UnitPrice_positive": "UnitPrice > 0"},
    ),
    ("orders", "orders_parsed", _present_sql("InvoiceNo", "Country") | {"InvoiceDate_not_null": "InvoiceDate IS NOT NULL"}),
    (
        "orders_line",
        "lines_raw",
        _present_sql("InvoiceNo", "StockCode") | {"Quantity_not_null": "Quantity IS NOT NULL", "Quantity_not_zero": "Quantity <> 0"},
    ),
]


def _build_oracle() -> dict[str, str]:
    o, p, l, m, f = _with("orders"), _with("products"), _with("lines"), _with("marts"), _with("flat")
    sql = {
        "scan_parquet": l + "SELECT InvoiceNo, StockCode, Quantity FROM lines_raw",
        "partition_roundtrip": o + "SELECT * FROM orders_bronze",
        "products_trimmed": p + "SELECT * FROM products_trimmed",
        "orders_date_parts": o + "SELECT * FROM orders_bronze",
        "orders_parsed": o + "SELECT * FROM orders_parsed",
        "orders_customer_default": o + "SELECT InvoiceNo, CustomerID FROM orders_silver",
        "orders_country_norm": o + "SELECT InvoiceNo, Country FROM orders_silver",
        "orders_cancel_flag": o + "SELECT InvoiceNo, IsCancel FROM orders_silver",
        "products_valid": p + "SELECT StockCode, Description, UnitPrice FROM products_ok WHERE ok",
        "products_invalid": p + "SELECT StockCode, Description, UnitPrice FROM products_ok WHERE NOT ok",
        "orders_valid": o + "SELECT * FROM orders_silver",
        "orders_invalid": o
        + 'SELECT InvoiceNo, InvoiceDate, CustomerID, Country, "year", "month", "day" FROM orders_ok WHERE NOT ok',
        "lines_valid": l + "SELECT InvoiceNo, StockCode, Quantity FROM lines_ok WHERE ok",
        "lines_invalid": l + "SELECT InvoiceNo, StockCode, Quantity FROM lines_ok WHERE NOT ok",
        "validation_summary": _with("orders", "products", "lines")
        + """SELECT dataset, is_valid, count(*) AS n FROM (
  SELECT 'products' AS dataset, ok AS is_valid FROM products_ok
  UNION ALL SELECT 'orders', ok FROM orders_ok
  UNION ALL SELECT 'orders_line', ok FROM lines_ok) GROUP BY dataset, is_valid""",
        "products_master": p
        + f"SELECT StockCode, Description, {_money('UnitPrice')} AS UnitPrice FROM products_master",
        "sales_lines": _with("sales")
        + "SELECT StockCode, InvoiceNo, Quantity, InvoiceDate, CustomerID, Country, IsCancel, "
        + f'"year", "month", "day", Description, {_money("UnitPrice")} AS UnitPrice, '
        + f"{_money('Amount')} AS Amount FROM sales",
        "page_sales_per_country": m + _page_sql("country", _ORDER["sales_per_country"], *COUNTRY_PAGE),
        "page_top_products": m + _page_sql("products", _ORDER["top_products"], *PRODUCT_PAGE),
        "page_return_products": m + _page_sql("returns", _ORDER["return_products"], *RETURN_PAGE),
        "page_periodic": m
        + _page_sql("period", _ORDER["sales_by_period"], *PERIOD_PAGE, _period_where(PERIOD_YEAR, PERIOD_MONTH)),
        "page_periodic_ranked": m + _page_sql("period", _ORDER["sales_by_period"], *RANKED_PAGE),
        "period_filtered": m + f"SELECT * FROM period {_period_where(SERIES_YEAR, SERIES_MONTH)}",
        "page_meta": m
        + " UNION ALL ".join(
            [
                _meta_sql("sales_per_country", "country", *COUNTRY_PAGE),
                _meta_sql("top_products", "products", *PRODUCT_PAGE),
                _meta_sql("return_products", "returns", *RETURN_PAGE),
                _meta_sql("sales_by_period", "period", *PERIOD_PAGE, _period_where(PERIOD_YEAR, PERIOD_MONTH)),
            ]
        ),
        "overview_kpis": m
        + """SELECT (SELECT count(*) FROM m_country) AS countries,
       (SELECT count(*) FROM m_products) AS products,
       (SELECT count(*) FROM m_returns) AS returned_products,
       (SELECT count(*) FROM m_period) AS active_days""",
        "country_series": m
        + f"SELECT Country, total_sales FROM country ORDER BY {_ORDER['sales_per_country']} LIMIT 15",
        "top_products_series": m
        + """SELECT StockCode, Description,
       CASE WHEN length(Description) > 25 THEN substring(Description, 1, 25) || '...' ELSE Description END AS label,
       total_revenue FROM products ORDER BY """
        + _ORDER["top_products"]
        + " LIMIT 15",
        "returns_series": m
        + """SELECT StockCode, Description,
       CASE WHEN length(Description) > 25 THEN substring(Description, 1, 25) || '...' ELSE Description END AS label,
       abs(total_loss) AS loss FROM returns ORDER BY """
        + _ORDER["return_products"]
        + " LIMIT 15",
        "period_series": m
        + """SELECT "year", "month", "day",
       CAST("year" AS VARCHAR) || '-' || lpad(CAST("month" AS VARCHAR), 2, '0') || '-'
         || lpad(CAST("day" AS VARCHAR), 2, '0') AS day_label,
       total_sales FROM period """
        + _period_where(SERIES_YEAR, SERIES_MONTH)
        + " ORDER BY "
        + _ORDER["sales_by_period"]
        + " LIMIT 30",
        "country_display": m
        + """SELECT Country,
       translate(format('{:,.2f}', round(total_sales, 2) + 0.0), ',.', chr(8239) || ',') || ' ' || chr(8364) AS total_sales,
       translate(format('{:,}', number_of_orders), ',', chr(8239)) AS number_of_orders,
       translate(format('{:,}', total_quantity), ',', chr(8239)) AS total_quantity
FROM m_country""",
        "split_union": f + "SELECT * FROM merged",
        # CSV keeps no difference between an empty and a missing text value:
        # both read back as NULL.
        "extract_csv_roundtrip": f
        + """SELECT NULLIF(InvoiceNo, '') AS InvoiceNo, NULLIF(StockCode, '') AS StockCode,
       NULLIF(Description, '') AS Description, Quantity, NULLIF(InvoiceDate, '') AS InvoiceDate,
       UnitPrice, CustomerID, NULLIF(Country, '') AS Country FROM merged""",
        "split_products": f + "SELECT DISTINCT StockCode, Description, UnitPrice FROM merged",
        "split_orders": f + "SELECT DISTINCT InvoiceNo, InvoiceDate, CustomerID, Country FROM merged",
        "split_lines": f + "SELECT InvoiceNo, StockCode, Quantity FROM merged",
    }
    for name, select in _MART_SELECT.items():
        sql[name] = m + select
    for name, columns in serving.MART_SORT.items():
        order = ", ".join(f'"{c}" {"DESC" if down else "ASC"}' for c, down in columns)
        sql[f"ordered_{name}"] = m + f"SELECT *, row_number() OVER (ORDER BY {order}) AS rank FROM ({_MART_SELECT[name]})"
    sql["page_top_products_deep"] = m + _page_sql("products", _ORDER["top_products"], *DEEP_PAGE)
    day = """CAST("year" AS VARCHAR) || '-' || lpad(CAST("month" AS VARCHAR), 2, '0') || '-' || lpad(CAST("day" AS VARCHAR), 2, '0') AS day_label"""
    sql["period_series_all"] = (
        m + f'SELECT "year", "month", "day", {day}, total_sales FROM period ORDER BY {_ORDER["sales_by_period"]} LIMIT 30'
    )
    sql["product_display"] = m + f"""SELECT StockCode, Description, {_shown_money("total_revenue")},
       {_shown_integer("total_quantity_sold")}, {_shown_integer("number_of_sales")} FROM m_products"""
    sql["return_display"] = m + f"""SELECT StockCode, Description, {_shown_integer("total_returned")},
       {_shown_integer("number_of_returns")}, {_shown_money("total_loss")} FROM m_returns"""
    sql["period_display"] = m + f"""SELECT {day}, {_shown_money("total_sales")}, {_shown_integer("number_of_orders")},
       {_shown_integer("total_quantity")} FROM m_period"""
    for name, select in _MART_SELECT.items():
        sql[f"measured_{name}"] = sql[name]
    sql["incremental_marts"] = m + """SELECT 'sales_per_country' AS mart, Country AS key, total_sales AS amount,
       number_of_orders AS n_lines, total_quantity AS quantity FROM country
UNION ALL SELECT 'top_products', StockCode || '|' || Description, total_revenue, number_of_sales, total_quantity_sold FROM products
UNION ALL SELECT 'return_products', StockCode || '|' || Description, total_loss, number_of_returns, total_returned FROM returns
UNION ALL SELECT 'sales_by_period', concat_ws('|', "year", "month", "day"), total_sales, number_of_orders, total_quantity FROM period"""
    sql["exact_marts"] = _with("exact") + """SELECT mart, key, CAST(CAST(units AS DECIMAL(30,0)) * 0.000001::DECIMAL(7,6) AS DECIMAL(28,6)) AS amount,
       n_lines, CAST(quantity AS BIGINT) AS quantity FROM exact_marts"""
    rows = {"both": "merged", "second": "(SELECT * FROM flat WHERE odate >= DATE '1998-03-01')"}
    sql["incremental_product_master"] = f + " UNION ALL ".join(
        f"""SELECT '{state}' AS state, StockCode, min(Description) AS Description, {_money("avg(UnitPrice)")} AS UnitPrice
FROM (SELECT trim(StockCode) AS StockCode, trim(Description) AS Description, UnitPrice FROM (SELECT DISTINCT StockCode, Description, UnitPrice FROM {source}))
WHERE {_PRODUCT_OK} GROUP BY StockCode"""
        for state, source in rows.items()
    )
    out = _with("outcomes")
    sql["line_outcomes"] = out + "SELECT * FROM outcomes"
    sql["sales_lost_lines"] = out + "SELECT InvoiceNo, StockCode, Quantity, outcome FROM outcomes WHERE starts_with(outcome, 'without')"
    sql["sales_loss_report"] = out + """SELECT outcome, count(*) AS n_lines, CAST(sum(Quantity) AS BIGINT) AS quantity,
       CAST(sum(CASE WHEN outcome IN ('sold', 'fanned_out') THEN order_rows ELSE 0 END) AS BIGINT) AS sales_rows
FROM outcomes GROUP BY outcome"""
    for name, (size, pages) in KEYSET_WALKS.items():
        source = _MART_SELECT[name].removeprefix("SELECT * FROM ")
        sql[f"keyset_{name}"] = m + _page_sql(source, _ORDER[name], pages, size)
    sql["rule_counters"] = _with("orders", "products", "lines") + " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{rule}' AS rule_id, count(*) FILTER (NOT coalesce({check}, FALSE)) AS n_failed FROM {source}"
        for dataset, source, checks in _RULES_SQL
        for rule, check in checks.items()
    )
    l_text = "coalesce(InvoiceNo, '') || ',' || coalesce(StockCode, '')"
    read_back = "NULLIF(InvoiceNo, '') AS InvoiceNo, NULLIF(StockCode, '') AS StockCode, Quantity"
    sql["csv_good_lines"] = l + f"SELECT {read_back} FROM lines_raw WHERE Quantity IS NULL OR Quantity NOT IN (13, 17, 19)"
    sql["csv_broken_lines"] = l + f"""SELECT {l_text} || CASE Quantity WHEN 13 THEN '' WHEN 17 THEN ',17,extra' ELSE ',19 pcs' END AS record,
       CASE Quantity WHEN 19 THEN 'type:Quantity' ELSE 'fields' END AS reason FROM lines_raw WHERE Quantity IN (13, 17, 19)"""
    sql["manifest_lines"] = l + f"SELECT {read_back} FROM lines_raw"
    sql["clustered_lines"] = l + "SELECT InvoiceNo, StockCode, Quantity FROM lines_raw"
    sql["clustered_point_reads"] = l + """SELECT 'invoice' AS read_by, * FROM lines_raw WHERE InvoiceNo = (SELECT max(InvoiceNo) FROM lines_raw)
UNION ALL SELECT 'product', * FROM lines_raw WHERE StockCode = (SELECT max(StockCode) FROM lines_raw)
UNION ALL SELECT 'no invoice', * FROM lines_raw WHERE InvoiceNo IS NULL"""
    sql["compacted_months"] = o + """SELECT "year", "month", count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files,
       count(CustomerID) AS n_customers, count(DISTINCT "day") AS n_days FROM orders_bronze GROUP BY "year", "month\""""
    sql["landed_in_eight_files"] = l + "SELECT count(*) AS n_rows, CAST(8 AS BIGINT) AS n_files, CAST(sum(Quantity) AS BIGINT) AS quantity FROM lines_raw"
    sql["headers_cleaned"] = p + "SELECT NULLIF(StockCode, '') AS StockCode, NULLIF(Description, '') AS Description, UnitPrice FROM products_raw"
    sql["written_lines_invalid"] = sql["lines_invalid"]
    sql["silver_orders_table"] = sql["orders_valid"]
    sql["silver_invalid_products_table"] = sql["products_invalid"]
    sql["landed_sales_by_period"] = sql["sales_by_period"]
    return sql


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every registered query that SQL can express."""
    return {**_build_oracle(), **_optional()[1]}
