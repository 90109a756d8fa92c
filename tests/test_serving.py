"""Pages, metadata, filters, series, key figures and display formatting."""

import pytest
from pyspark.sql import functions as F

from tillroll.functions import fr_integer, fr_money, short_label
from tillroll.operators import serving


@pytest.fixture(scope="module")
def marts(spark, sf_small):
    from __spark_entry__ import _mart
    from tillroll.session import materialize

    return {name: materialize(_mart(spark, sf_small, name), name) for name in serving.MART_VIEWS}


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_numpy_integers_are_valid_page_args(spark):
    import numpy as np

    assert serving.page(spark.range(30), [F.col("id")], np.int64(2), np.int32(10)).count() == 10


@pytest.mark.parametrize("page_no,size", [(0, 10), (1, 0), (1, 101), (-1, 5), (True, 10), (1.0, 10)])
def test_page_argument_bounds(spark, page_no, size):
    with pytest.raises(ValueError):
        serving.page(spark.range(3), [F.col("id")], page_no, size)


def test_month_bounds(spark):
    with pytest.raises(ValueError):
        serving.period_filter(spark.range(1), month=13)


def test_pages_concatenate_to_ordered_mart(marts):
    name = "top_products"
    mart, order = marts[name], serving.MART_VIEWS[name].page_order()
    full = _rows(mart.orderBy(*order))
    size = 37
    pages = []
    for p in range(1, len(full) // size + 2):
        pages += _rows(serving.page(mart, order, p, size))
    assert pages == full


def test_deep_page_path_matches_top_k_path(marts, monkeypatch):
    name = "sales_by_period"
    mart, order = marts[name], serving.MART_VIEWS[name].page_order()
    shallow = [_rows(serving.page(mart, order, p, 50)) for p in (1, 4, 21)]
    view = serving.ranked_view(mart, order)
    deep = [_rows(serving.page(view, order, p, 50)) for p in (1, 4, 21)]
    assert deep == shallow
    assert len(deep[2]) == 1014 - 20 * 50


def test_page_meta(marts):
    meta = serving.page_meta(marts["sales_per_country"], 2, 10).first().asDict()
    assert meta == {"total": 25, "page": 2, "page_size": 10, "total_pages": 3}
    empty = serving.page_meta(serving.period_filter(marts["sales_by_period"], year=0), 1, 10).first()
    assert empty["total"] == 0 and empty["total_pages"] == 0


def test_period_filter_zero_is_a_value(marts):
    assert serving.period_filter(marts["sales_by_period"], year=0).count() == 0
    assert serving.period_filter(marts["sales_by_period"]).count() == 1014
    one_month = serving.period_filter(marts["sales_by_period"], 1997, 3)
    assert {(r["year"], r["month"]) for r in one_month.collect()} == {(1997, 3)}


def test_mart_page_rejects_filters_on_other_marts(marts):
    with pytest.raises(ValueError):
        serving.mart_page(marts["top_products"], "top_products", year=1997)


def test_series(marts):
    top = serving.top_products_series(marts["top_products"]).collect()
    assert len(top) == 15
    for r in top:
        d = r["Description"]
        assert r["label"] == (d[:25] + "..." if len(d) > 25 else d)
    rev = [r["total_revenue"] for r in top]
    assert rev == sorted(rev, reverse=True)
    ret = serving.returns_series(marts["return_products"]).collect()
    assert all(r["loss"] >= 0 for r in ret)
    assert [r["loss"] for r in ret] == sorted((r["loss"] for r in ret), reverse=True)
    days = serving.period_series(marts["sales_by_period"], 1998).collect()
    assert len(days) == 30
    r = days[0]
    assert r["day_label"] == f"{r['year']:04d}-{r['month']:02d}-{r['day']:02d}"


def test_kpis(marts):
    row = serving.overview_kpis(*(marts[n] for n in serving.MART_VIEWS)).first().asDict()
    assert row == {"countries": 25, "products": 186, "returned_products": 186, "active_days": 1014}


def test_sorted_mart_write_order(marts):
    rows = serving.sorted_mart(marts["sales_by_period"], "sales_by_period").collect()
    keys = [(r["year"], r["month"], r["day"]) for r in rows]
    assert keys == sorted(keys)


def test_label_and_display_formatting(spark):
    df = spark.createDataFrame(
        [("x" * 25, 1234567.891, 1234567), ("y" * 26, -0.004, 0), (None, 12.5, 999)],
        "d string, m double, n bigint",
    )
    out = df.select(short_label("d").alias("l"), fr_money("m").alias("m"), fr_integer("n").alias("n")).collect()
    assert out[0]["l"] == "x" * 25 and out[1]["l"] == "y" * 25 + "..." and out[2]["l"] is None
    assert out[0]["m"] == "1\u202f234\u202f567,89 \u20ac"
    assert out[0]["n"] == "1\u202f234\u202f567"
    assert out[2]["m"] == "12,50 \u20ac" and out[2]["n"] == "999"


def test_deep_pages_across_many_sorted_partitions(spark, marts, monkeypatch):
    """With coalescing off the range sort really spreads over 8 partitions,
    so page ranks must be stitched across partition boundaries."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        name = "top_products"
        mart, order = marts[name], serving.MART_VIEWS[name].page_order()
        full = _rows(mart.orderBy(*order))
        view = serving.ranked_view(mart, order)
        sorted_parts = mart.orderBy(*order).rdd.getNumPartitions()
        assert sorted_parts > 1
        size = 40
        got = []
        for p in range(1, len(full) // size + 2):
            got += _rows(serving.page(view, order, p, size))
        assert got == full
        assert [r[:-1] for r in sorted(_rows(view.ranked()), key=lambda r: r[-1])] == full
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranked_view_serves_pages_with_partition_pruning(spark, marts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        name = "sales_by_period"
        mart, order = marts[name], serving.MART_VIEWS[name].page_order()
        view = serving.ranked_view(mart, order)
        full = _rows(mart.orderBy(*order))
        assert view.total().first()["total"] == len(full)
        for p in (1, 7, 20, 21, 22):
            assert _rows(view.page(p, 50)) == full[(p - 1) * 50 : p * 50]
        deep = view.page(20, 50)
        deep.collect()
        plan = deep._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruningexpression" in plan, plan
        empty = serving.ranked_view(mart.filter("year = 0"), order)
        assert empty.page(3, 10).count() == 0 and empty.total().first()["total"] == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_plain_pages_are_lazy_and_large_top_k_comes_from_a_view(spark, marts):
    import os

    from tillroll.session import scratch_dir

    name = "sales_by_period"
    mart, order = marts[name], serving.MART_VIEWS[name].page_order()
    root = os.path.join(scratch_dir(spark).removeprefix("file:"), "tillroll")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    deep = _rows(serving.page(mart, order, 11, 100))
    assert (set(os.listdir(root)) if os.path.isdir(root) else set()) == before
    view = serving.ranked_view(mart, order)
    assert _rows(view.page(11, 100)) == deep and len(deep) == 14
    assert _rows(view.first(300)) == _rows(serving.top_k(mart, order, 300))
