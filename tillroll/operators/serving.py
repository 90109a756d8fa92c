"""Read side over the marts: ordered pages, page metadata, filters, top-k
series and key figures.

Every order ends with the mart's grain keys ascending, so pages and top-k
lists are deterministic even when measures tie.

Pages. The kind of input chooses the way, never its size. A plain frame gives
``orderBy().offset().limit()``, lazily. To serve many pages, or deep ones, build a
``RankedView`` once: the mart range-sorted across tasks and stored with each
row's sorted partition and position and one starting rank per partition; every
page then reads only the partitions that overlap its ranks.
"""

from __future__ import annotations

import numbers
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.dates import day_label
from tillroll.functions.display import fr_integer, fr_money
from tillroll.functions.text import short_label
from tillroll.schemas import DATE_PARTS
from tillroll.session import materialize, scratch_path

# Page defaults and bounds of the read API.
DEFAULT_PAGE = 1
DEFAULT_PAGE_SIZE = 10
MAX_PAGE_SIZE = 100
# Rows per table page and per chart series in the dashboard.
TABLE_PAGE_SIZE = 20
SERIES_SIZE = 15
PERIOD_SERIES_SIZE = 30

@dataclass(frozen=True)
class MartView:
    name: str
    keys: tuple[str, ...]
    measure: str
    descending: bool

    def page_order(self) -> list[Column]:
        m = F.col(self.measure)
        return [m.desc() if self.descending else m.asc()] + [F.col(k).asc() for k in self.keys]


# How each mart is read: by sales / revenue descending, returns by loss
# ascending (largest loss first), days by sales descending.
MART_VIEWS = {
    "sales_per_country": MartView("sales_per_country", ("Country",), "total_sales", True),
    "top_products": MartView("top_products", ("StockCode", "Description"), "total_revenue", True),
    "return_products": MartView("return_products", ("StockCode", "Description"), "total_loss", False),
    "sales_by_period": MartView("sales_by_period", tuple(DATE_PARTS), "total_sales", True),
}

# Order in which the batch job sorts each mart: (column, descending).
MART_SORT = {
    "sales_per_country": [("total_sales", True), ("Country", False)],
    "top_products": [("total_revenue", True), ("StockCode", False), ("Description", False)],
    "return_products": [("total_returned", True), ("StockCode", False), ("Description", False)],
    "sales_by_period": [(c, False) for c in DATE_PARTS],
}


def sorted_mart(df: DataFrame, name: str) -> DataFrame:
    """The mart in its batch-job order (a range-partitioned global sort)."""
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in MART_SORT[name]])


def _is_int(value) -> bool:
    return isinstance(value, numbers.Integral) and not isinstance(value, bool)


def check_page_args(page: int, page_size: int) -> None:
    if not _is_int(page) or page < 1:
        raise ValueError(f"page must be an integer >= 1, got {page!r}")
    if not _is_int(page_size) or not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be an integer in [1, {MAX_PAGE_SIZE}], got {page_size!r}")


def check_month(month: int | None) -> None:
    if month is not None and (not _is_int(month) or not 1 <= month <= 12):
        raise ValueError(f"month must be an integer in [1, 12], got {month!r}")


def period_filter(df: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """Equality filters on ``year`` / ``month``, each applied only when given.

    ``None`` means no filter; ``0`` is a value like any other.
    """
    check_month(month)
    if year is not None:
        df = df.filter(F.col("year") == F.lit(int(year)))
    if month is not None:
        df = df.filter(F.col("month") == F.lit(int(month)))
    return df


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``, lazily (a per-task top-k). A large
    ``k`` is better read from a ``RankedView`` (``first``), where rows stay
    distributed."""
    if not _is_int(k) or k < 0:
        raise ValueError(f"k must be a non-negative integer, got {k!r}")
    return df.orderBy(*order).limit(int(k))


@dataclass(frozen=True)
class RankedView:
    """A frame sorted once and stored with each row's place, for any number of
    pages.

    ``rows`` is Parquet partitioned by ``_part`` (the sorted partition a row
    landed in) with ``_pos`` (its position inside that partition); ``starts``
    holds one row per sorted partition with its first global rank ``_first``
    and row count ``_n``. A page joins the few ``starts`` rows that overlap its
    rank range; as a broadcast join on the partition column this lets dynamic
    partition pruning skip every other folder, so a page reads one or two
    partitions whatever its depth.
    """

    rows: DataFrame
    starts: DataFrame

    def total(self) -> DataFrame:
        return self.starts.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total"))

    def ranked(self) -> DataFrame:
        """All rows with their global ``rank`` from 1, distributed."""
        return (
            self.rows.join(self.starts, "_part")
            .withColumn("rank", (F.col("_first") + F.col("_pos") + F.lit(1)).cast("bigint"))
            .drop("_part", "_pos", "_first", "_n")
        )

    def first(self, k: int) -> DataFrame:
        """The ``k`` first rows, as a distributed frame sorted by rank."""
        wanted = self.starts.filter(F.col("_first") < k)
        return (
            self.rows.join(F.broadcast(wanted), "_part")
            .withColumn("_rank", F.col("_first") + F.col("_pos"))
            .filter(F.col("_rank") < k)
            .orderBy("_rank")
            .drop("_part", "_pos", "_first", "_n", "_rank")
        )

    def page(self, page_no: int = DEFAULT_PAGE, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
        check_page_args(page_no, page_size)
        page_no, page_size = int(page_no), int(page_size)
        start = (page_no - 1) * page_size
        stop = start + page_size
        wanted = self.starts.filter((F.col("_first") < stop) & (F.col("_first") + F.col("_n") > start))
        return (
            self.rows.join(F.broadcast(wanted), "_part")
            .withColumn("_rank", F.col("_first") + F.col("_pos"))
            .filter((F.col("_rank") >= start) & (F.col("_rank") < stop))
            # At most ``page_size`` rows remain: gather them in one task and
            # sort there, instead of a sampled range sort of a few rows.
            .repartition(1)
            .sortWithinPartitions("_rank")
            .drop("_part", "_pos", "_first", "_n", "_rank")
        )


def ranked_view(df: DataFrame, order: Sequence[Column], name: str = "ranked") -> RankedView:
    """Sort ``df`` across tasks once and store it as a ``RankedView``.

    The position inside a sorted partition is the low 33 bits of
    ``monotonically_increasing_id`` (the documented layout: partition index
    above, record number below); both columns are computed in the task that
    produced the sorted partition and then stored, so later reads agree.
    """
    spark = df.sparkSession
    tagged = df.orderBy(*order).withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    rows_path = scratch_path(spark, f"{name}-rows")
    tagged.write.mode("overwrite").partitionBy("_part").parquet(rows_path)
    # Give the schema: an empty frame writes no files to infer it from.
    rows = spark.read.schema(tagged.schema).parquet(rows_path)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("bigint"))
    return RankedView(rows, materialize(starts, f"{name}-starts"))


def page(
    df: DataFrame | RankedView,
    order: Sequence[Column],
    page: int = DEFAULT_PAGE,
    page_size: int = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """Rows ``(page-1)*page_size`` .. ``page*page_size - 1`` of ``df`` in
    ``order``; a ``RankedView`` is served in its own order."""
    check_page_args(page, page_size)
    if isinstance(df, RankedView):
        return df.page(page, page_size)
    page, page_size = int(page), int(page_size)
    return df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


def page_meta(df: DataFrame, page: int = DEFAULT_PAGE, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
    """One row: ``total``, ``page``, ``page_size``, ``total_pages``.

    ``total_pages`` is the integer ceiling of ``total / page_size``.
    """
    check_page_args(page, page_size)
    page, page_size = int(page), int(page_size)
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"),
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        F.ceil(total / F.lit(page_size)).cast("bigint").alias("total_pages"),
    )


def page_meta_from_counts(counts: DataFrame, name: str, page: int, page_size: int) -> DataFrame:
    """``page_meta`` of a mart from ``marts.mart_counts``."""
    check_page_args(page, page_size)
    total = F.col(name)
    return counts.select(
        total.alias("total"),
        F.lit(int(page)).alias("page"),
        F.lit(int(page_size)).alias("page_size"),
        F.ceil(total / F.lit(int(page_size))).cast("bigint").alias("total_pages"),
    )


def mart_page(
    mart: DataFrame,
    name: str,
    page_no: int = DEFAULT_PAGE,
    page_size: int = DEFAULT_PAGE_SIZE,
    year: int | None = None,
    month: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, meta)`` for a page of a named mart (period filters for days)."""
    view = MART_VIEWS[name]
    if name == "sales_by_period":
        mart = period_filter(mart, year, month)
    elif year is not None or month is not None:
        raise ValueError("year/month filters apply to sales_by_period only")
    return page(mart, view.page_order(), page_no, page_size), page_meta(mart, page_no, page_size)


def page_response(
    mart: DataFrame,
    name: str,
    page_no: int = DEFAULT_PAGE,
    page_size: int = DEFAULT_PAGE_SIZE,
    year: int | None = None,
    month: int | None = None,
) -> dict:
    """A page as a plain dict: ``total``, ``page``, ``page_size``,
    ``total_pages``, ``filters`` (days only) and ``data`` (list of dicts).

    Only the page (at most ``MAX_PAGE_SIZE`` rows) and the one meta row reach
    the driver.
    """
    rows, meta = mart_page(mart, name, page_no, page_size, year=year, month=month)
    out = meta.first().asDict()
    if name == "sales_by_period":
        out["filters"] = {"year": year, "month": month}
    out["data"] = [r.asDict() for r in rows.collect()]
    return out


# --------------------------------------------------------------------------
# Dashboard series and figures.


def country_series(countries: DataFrame, k: int = SERIES_SIZE) -> DataFrame:
    view = MART_VIEWS["sales_per_country"]
    return top_k(countries, view.page_order(), k).select("Country", "total_sales")


def top_products_series(products: DataFrame, k: int = SERIES_SIZE) -> DataFrame:
    view = MART_VIEWS["top_products"]
    return top_k(products, view.page_order(), k).select(
        "StockCode", "Description", short_label("Description").alias("label"), "total_revenue"
    )


def returns_series(returns: DataFrame, k: int = SERIES_SIZE) -> DataFrame:
    """The largest losses, with the loss as a positive magnitude."""
    view = MART_VIEWS["return_products"]
    return top_k(returns, view.page_order(), k).select(
        "StockCode",
        "Description",
        short_label("Description").alias("label"),
        F.abs("total_loss").alias("loss"),
    )


def period_series(
    periods: DataFrame,
    year: int | None = None,
    month: int | None = None,
    k: int = PERIOD_SERIES_SIZE,
) -> DataFrame:
    """Best days by sales (not chronological), labelled ``YYYY-MM-DD``."""
    view = MART_VIEWS["sales_by_period"]
    return top_k(period_filter(periods, year, month), view.page_order(), k).select(
        *DATE_PARTS, day_label().alias("day_label"), "total_sales"
    )


def kpis_from_counts(counts: DataFrame) -> DataFrame:
    """``overview_kpis`` from ``marts.mart_counts``: one pass over the lines."""
    return counts.select(
        F.col("sales_per_country").alias("countries"),
        F.col("top_products").alias("products"),
        F.col("return_products").alias("returned_products"),
        F.col("sales_by_period").alias("active_days"),
    )


# Columns of each dashboard table: text, money and whole numbers.
_DISPLAY = {
    "sales_per_country": (("Country",), {"total_sales"}, ("total_sales", "number_of_orders", "total_quantity")),
    "top_products": (("StockCode", "Description"), {"total_revenue"}, ("total_revenue", "total_quantity_sold", "number_of_sales")),
    "return_products": (("StockCode", "Description"), {"total_loss"}, ("total_returned", "number_of_returns", "total_loss")),
    "sales_by_period": ((), {"total_sales"}, ("total_sales", "number_of_orders", "total_quantity")),
}


def display_rows(mart: DataFrame, name: str) -> DataFrame:
    """A mart's rows as the dashboard's tables show them, all as text."""
    texts, money, columns = _DISPLAY[name]
    shown = [(fr_money(c) if c in money else fr_integer(c)).alias(c) for c in columns]
    head = [day_label().alias("day_label")] if name == "sales_by_period" else list(texts)
    return mart.select(*head, *shown)


def overview_kpis(
    countries: DataFrame, products: DataFrame, returns: DataFrame, periods: DataFrame
) -> DataFrame:
    """One row with the row counts of the four marts.

    Each mart contributes one partial count per task; the four counts meet in
    a single tiny aggregate, with no join between the marts.
    """
    parts = {
        "countries": countries,
        "products": products,
        "returned_products": returns,
        "active_days": periods,
    }
    tagged = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("figure"))
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.agg(
        *[F.count_if(F.col("figure") == F.lit(name)).alias(name) for name in parts]
    )
