"""Retail extracts derived from the TPC-H-like test tables.

The original flow reads CSV extracts of an online shop. For tests and
benchmarks the same shapes are derived, with plain column expressions, from
``orders``, ``lineitem``, ``part``, ``customer`` and ``nation``; the key
arithmetic below plants rows that fail each validation rule. The rules are
listed in FIXTURES.md and are written a second time, as DuckDB SQL, in the
oracle of ``__spark_entry__.py``.

All of it is lazy DataFrame code: scans prune to the needed columns, the
small tables are broadcast where Spark measures them as such, other joins are
left to the planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture rules (see FIXTURES.md, part B).
ORDER_MOD = 500
PART_MOD = 200
QUANTITY_MOD = 1000
CUSTOMER_NULL_MOD = 7
CANCEL_MOD = 5
REPEATED_INVOICE = 7
PADDED_LINE_CODE = 15
DUPLICATE_PRICE_MOD = 3
OTHER_DESCRIPTION_MOD = 6
LONG_DESCRIPTION_MOD = 4
LONG_DESCRIPTION_SUFFIX = " deluxe edition in gift box"
UNSPECIFIED_NATION = "NATION_24"
SPLIT_A_BEFORE = "1998-04-01"
SPLIT_B_FROM = "1998-03-01"

# Lines a task sorts and adds up where the joins of the flat extract are large.
LINES_PER_TASK = 1_000_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _invoice_no(orderkey: Column, status: Column) -> Column:
    r = orderkey % ORDER_MOD
    return (
        F.when(r == 1, F.lit(None).cast("string"))
        .when(r == 2, F.lit(""))
        .when((status == "F") & (orderkey % CANCEL_MOD == 0), F.concat(F.lit("C"), orderkey.cast("string")))
        .otherwise(orderkey.cast("string"))
    )


def _date_text(orderkey: Column, orderdate: Column, with_bad_dates: bool = True) -> Column:
    text = F.date_format(orderdate, "M/d/yyyy H:mm")
    if not with_bad_dates:
        return text
    r = orderkey % ORDER_MOD
    return F.when(r == 3, F.lit(None).cast("string")).when(r == 4, F.lit("not a date")).otherwise(text)


def _customer_id(orderkey: Column, custkey: Column) -> Column:
    return F.when(orderkey % CUSTOMER_NULL_MOD == 0, F.lit(None).cast("double")).otherwise(
        custkey.cast("double")
    )


def _country(orderkey: Column, nation_name: Column) -> Column:
    r = orderkey % ORDER_MOD
    return (
        F.when(r == 5, F.lit(None).cast("string"))
        .when(r == 6, F.lit(""))
        .when(nation_name == UNSPECIFIED_NATION, F.lit("Unspecified"))
        .otherwise(nation_name)
    )


def _special_code(partkey: Column) -> Column:
    """The planted non-product / malformed codes, NULL when none applies."""
    r = partkey % PART_MOD
    return (
        F.when(r == 1, F.lit("POST"))
        .when(r == 2, F.lit("M"))
        .when(r == 3, F.lit(" d "))
        .when(r == 4, F.lit(""))
    )


def _stock_code(partkey: Column, padded: bool) -> Column:
    r = partkey % PART_MOD
    plain = partkey.cast("string")
    normal = F.concat(F.lit(" "), plain, F.lit(" ")) if padded else plain
    return F.when(r == 5, F.lit(None).cast("string")).otherwise(F.coalesce(_special_code(partkey), normal))


def _description(partkey: Column, name: Column) -> Column:
    r = partkey % PART_MOD
    suffix = F.when(partkey % LONG_DESCRIPTION_MOD == 0, F.lit(LONG_DESCRIPTION_SUFFIX)).otherwise(F.lit(""))
    return (
        F.when(r == 6, F.lit("Bad Debt x"))
        .when(r == 7, F.lit("ADJUST bad"))
        .when(r == 8, F.lit("Dotcom Postage"))
        .when(r == 9, F.lit("AMAZON FEE"))
        .when(r == 10, F.lit(None).cast("string"))
        .when(r == 11, F.lit("   "))
        .otherwise(F.concat(F.lit(" "), name, suffix, F.lit(" ")))
    )


def _unit_price(partkey: Column, price: Column) -> Column:
    r = partkey % PART_MOD
    return (
        F.when(r == 12, F.lit(None).cast("double"))
        .when(r == 13, F.lit(0.0))
        .when(r == 14, F.lit(-5.0))
        .otherwise(price)
    )


def _quantity(orderkey: Column, linenumber: Column, qty: Column, flag: Column, status: Column) -> Column:
    r = (orderkey * 7 + linenumber) % QUANTITY_MOD
    signed = F.when((flag == "R") & (status == "O"), -qty).otherwise(qty)
    return F.when(r == 1, F.lit(None).cast("int")).when(r == 2, F.lit(0)).otherwise(signed.cast("int"))


def _customer_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        _table(spark, sf_dir, "customer")
        .select("c_custkey", "c_nationkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "n_name")
    )


def _orders_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return orders.join(
        _customer_nations(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left"
    )


def products_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """StockCode, Description, UnitPrice; parts with key % 3 == 0 get a second
    row with the list price one unit higher (the planted bad prices apply to
    both rows), so the product master's mean matters. For keys % 6 == 0 that
    row has another description, so its choice matters too."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    k = F.col("p_partkey")
    other_name = F.when(k % OTHER_DESCRIPTION_MOD == 0, F.concat(F.lit("A "), F.col("p_name"))).otherwise(F.col("p_name"))
    second = part.filter(k % DUPLICATE_PRICE_MOD == 0).withColumns(
        {"p_retailprice": F.col("p_retailprice") + 1.0, "p_name": other_name}
    )
    return part.unionByName(second).select(
        _stock_code(k, padded=True).alias("StockCode"),
        _description(k, F.col("p_name")).alias("Description"),
        _unit_price(k, F.col("p_retailprice")).alias("UnitPrice"),
    )


def orders_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """InvoiceNo, InvoiceDate (text), CustomerID (double), Country; orders with
    key % 500 == 7 come twice, so their lines fan out."""
    o = F.col("o_orderkey")
    copies = F.when(o % ORDER_MOD == REPEATED_INVOICE, F.lit(2)).otherwise(F.lit(1))
    orders = _orders_with_nation(spark, sf_dir).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return orders.select(
        _invoice_no(o, F.col("o_orderstatus")).alias("InvoiceNo"),
        _date_text(o, F.col("o_orderdate")).alias("InvoiceDate"),
        _customer_id(o, F.col("o_custkey")).alias("CustomerID"),
        _country(o, F.col("n_name")).alias("Country"),
    )


def lines_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """InvoiceNo, StockCode, Quantity (int). Codes are not padded but for second
    lines of parts with key % 200 == 15; these match no product.

    What a line alone decides is made before the lines meet the orders' states,
    so that a shuffle there carries a key, a code and a quantity.
    """
    o = F.col("l_orderkey")
    code = _stock_code(F.col("l_partkey"), padded=False)
    padded = (F.col("l_partkey") % PART_MOD == PADDED_LINE_CODE) & (F.col("l_linenumber") == 2)
    line = _table(spark, sf_dir, "lineitem").select(
        o,
        F.when(padded, F.concat(F.lit(" "), code, F.lit(" "))).otherwise(code).alias("StockCode"),
        _quantity(
            o, F.col("l_linenumber"), F.col("l_quantity"), F.col("l_returnflag"), F.col("l_linestatus")
        ).alias("Quantity"),
    )
    status = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    joined = line.join(status, o == F.col("o_orderkey"), "left")
    return joined.select(_invoice_no(o, F.col("o_orderstatus")).alias("InvoiceNo"), "StockCode", "Quantity")


def _dealt(line: DataFrame, key: str) -> DataFrame:
    """Lines dealt by ``key`` in so many partitions that each has at most about
    ``LINES_PER_TASK`` (the planner may take ``spark.sql.shuffle.partitions``
    where that is more); as they are when a partition a core is enough.
    Adaptive execution sizes the tasks of a join by compressed bytes, of which
    narrow lines need few: millions of them met in one task, with its sorts and
    sums. Partitions of a given number are not merged.
    """
    n = -(-line.count() // LINES_PER_TASK)
    return line.repartition(n, key) if n > line.sparkSession.sparkContext.defaultParallelism else line


def flat_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line with all attributes (the yearly-extract shape), plus
    the order date used to cut the two extracts."""
    line = _dealt(_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    orders = _orders_with_nation(spark, sf_dir)
    o = F.col("o_orderkey")
    return (
        line.join(orders, F.col("l_orderkey") == o)
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            _invoice_no(o, F.col("o_orderstatus")).alias("InvoiceNo"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            _date_text(o, F.col("o_orderdate"), with_bad_dates=False).alias("InvoiceDate"),
            F.col("p_retailprice").alias("UnitPrice"),
            _customer_id(o, F.col("o_custkey")).alias("CustomerID"),
            F.col("n_name").alias("Country"),
            F.col("o_orderdate").alias("_orderdate"),
        )
    )


def yearly_extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping extracts: A before 1998-04-01, B from 1998-03-01."""
    flat = flat_extract(spark, sf_dir)
    day = F.to_date("_orderdate")
    a = flat.filter(day < F.lit(SPLIT_A_BEFORE).cast("date")).drop("_orderdate")
    b = flat.filter(day >= F.lit(SPLIT_B_FROM).cast("date")).drop("_orderdate")
    return a, b
