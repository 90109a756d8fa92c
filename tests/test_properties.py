"""Property tests: the validation split is total and pages tile the order."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.operators import cleaning, serving
from tillroll.operators import validation as V
from tillroll.schemas import LINES_RAW, PRODUCTS_RAW

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

codes = st.one_of(st.none(), st.sampled_from(["", " ", "POST", "m", " d ", "85048", "C1", "\t7"]))
texts = st.one_of(st.none(), st.sampled_from(["", "   ", "lamp", "Bad Debt", "x adjust", "AMAZON FEE", "cup"]))
prices = st.one_of(st.none(), st.floats(min_value=-5, max_value=50, allow_nan=False))
quantities = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))


@SETTINGS
@given(st.lists(st.tuples(codes, texts, prices), max_size=25))
def test_product_split_is_total_and_exact(spark, rows):
    df = cleaning.trim_products(spark.createDataFrame(rows, PRODUCTS_RAW))
    valid, invalid = V.validate_and_split(df, V.product_rules())
    flagged = V.failed_rules(df, V.product_rules()).collect()
    expected_valid = sum(1 for r in flagged if not r["failed_rules"])
    assert valid.count() == expected_valid
    assert invalid.count() == len(rows) - expected_valid


@SETTINGS
@given(st.lists(st.tuples(codes, codes, quantities), max_size=25))
def test_line_split_is_total(spark, rows):
    df = spark.createDataFrame(rows, LINES_RAW)
    valid, invalid = V.validate_and_split(df, V.line_rules())
    assert valid.count() + invalid.count() == len(rows)
    assert valid.filter(F.col("Quantity").isNull() | (F.col("Quantity") == 0)).count() == 0


@SETTINGS
@given(
    st.lists(st.integers(min_value=0, max_value=5), min_size=0, max_size=60),
    st.integers(min_value=1, max_value=17),
)
def test_pages_tile_the_ordered_frame(spark, measures, size):
    df = spark.createDataFrame([(f"k{i:03d}", m) for i, m in enumerate(measures)], "key string, m int")
    order = [F.col("m").desc(), F.col("key").asc()]
    full = [tuple(r) for r in df.orderBy(*order).collect()]
    pages = []
    for p in range(1, len(full) // size + 2):
        pages += [tuple(r) for r in serving.page(df, order, p, size).collect()]
    assert pages == full
    meta = serving.page_meta(df, 1, size).first()
    assert meta["total"] == len(full) and meta["total_pages"] == -(-len(full) // size)


sales_rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C"]),  # StockCode (Description follows it)
        st.integers(min_value=-3, max_value=3),  # Quantity
        st.booleans(),  # IsCancel
        st.sampled_from(["France", "Spain"]),  # Country
        st.integers(min_value=1, max_value=3),  # day
    ),
    max_size=30,
)


@SETTINGS
@given(sales_rows)
def test_one_pass_marts_equal_per_mart_aggregations(spark, rows):
    from tillroll.operators import marts

    lines = spark.createDataFrame(
        [(str(i), code, q) for i, (code, q, *_) in enumerate(rows)], "InvoiceNo string, StockCode string, Quantity int"
    )
    orders = spark.createDataFrame(
        [(str(i), country, cancel, 2010, 1, day) for i, (_, _, cancel, country, day) in enumerate(rows)],
        "InvoiceNo string, Country string, IsCancel boolean, year int, month int, day int",
    )
    products = spark.createDataFrame(
        [("A", "item A", 1.5), ("B", "item B", 2.25), ("C", "item C", 4.0)],
        "StockCode string, Description string, UnitPrice double",
    )
    one_pass = marts.marts_from_measures(marts.mart_measures(lines, orders, products))
    per_mart = marts.all_marts(marts.sales_lines(lines, orders, products))

    def rounded(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())

    for name in marts.MART_BUILDERS:
        assert one_pass[name].columns == per_mart[name].columns, name
        assert rounded(one_pass[name]) == rounded(per_mart[name]), name
