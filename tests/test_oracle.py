"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, compare_frame, duckdb_connection
from tillroll.functions import as_money
from tillroll.plans import gold


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


def test_every_query_has_an_oracle_or_a_reason():
    assert set(E._QUERIES) - set(E.oracle_sql()) == set()
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E._QUERIES))
def test_query_matches_oracle(spark, sf_small, con, name):
    result = compare(spark, sf_small, name, con)
    assert result["status"] in ("ok", "no-oracle"), result


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == ["Country", "total_sales", "number_of_orders", "total_quantity"]
    assert df.count() == 25


@pytest.mark.parametrize("strategy", ["one_pass", "reuse_sales"])
def test_gold_strategies_match_mart_oracles(spark, sf_small, con, strategy):
    built = gold.build_marts_from_layers(E._layers(spark, sf_small), strategy=strategy)
    for name, df in built.items():
        status = compare_frame(as_money(df, *E.MONEY_COLUMNS[name]), E.oracle_sql()[name], con)
        assert status == "ok", (strategy, name, status)


@pytest.mark.parametrize("name", ["page_top_products", "page_periodic_ranked", "top_products", "overview_kpis"])
def test_results_do_not_depend_on_adaptive_execution(spark, sf_small, con, name):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        result = compare(spark, sf_small, name, con)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert result["status"] == "ok", result
