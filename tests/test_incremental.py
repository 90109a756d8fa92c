"""Incremental marts and product master against full rebuilds; exact money."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import duckdb_connection, compare_frame
from tillroll.operators import cleaning, marts
from tillroll.plans import gold, incremental
from tillroll.schemas import DATE_PARTS
from tillroll.session import path_exists, scratch_path
from tillroll.sources.sinks import write_parquet

ORDERS = "InvoiceNo string, Country string, IsCancel boolean, year int, month int, day int"
LINES = "InvoiceNo string, StockCode string, Quantity int"
PRODUCTS = "StockCode string, Description string, UnitPrice double"


def delivery(rng, days, start):
    orders, lines = [], []
    for i in range(start, start + 40):
        y, m, d = rng.choice(days)
        orders.append((str(i), rng.choice(["France", "Spain"]), rng.random() < 0.2, y, m, d))
        lines += [(str(i), rng.choice("abcx"), rng.choice([-2, 1, 5])) for _ in range(rng.randint(1, 4))]
    return orders, lines


def collected(built):
    return {n: sorted(map(tuple, df.collect())) for n, df in built.items()}


def test_relanded_days_give_the_marts_of_a_full_rebuild(spark):
    rng = random.Random(1)
    days = [(2010, 1, d) for d in range(1, 8)]
    products = spark.createDataFrame([("a", "one", 1.5), ("b", "two", 2.25), ("c", "three", 0.5)], PRODUCTS)
    store = incremental.DailySums(spark, scratch_path(spark, "sums"))
    state = {}
    for n, changed in enumerate([days, days[:2], [days[3]], [days[0], days[6]]]):
        orders, lines = delivery(rng, changed, 1000 * n)
        for day in changed:
            state[day] = ([o for o in orders if tuple(o[3:]) == day], [])
            names = {o[0] for o in state[day][0]}
            state[day] = (state[day][0], [x for x in lines if x[0] in names])
        assert store.deliver(spark.createDataFrame(lines, LINES), spark.createDataFrame(orders, ORDERS), changed) == n + 1
        all_orders = spark.createDataFrame([o for s in state.values() for o in s[0]], ORDERS)
        all_lines = spark.createDataFrame([x for s in state.values() for x in s[1]], LINES)
        full = collected(gold.build_marts(all_lines, all_orders, products, strategy="recompute"))
        assert collected(store.marts(products)) == full
    assert store.compact() == 5
    assert collected(store.marts(products)) == full
    assert not path_exists(spark, f"{store.path}/sums/batch=1")


def test_a_day_without_orders_is_emptied_and_a_stopped_delivery_does_not_count(spark):
    products = spark.createDataFrame([("a", "one", 1.0)], PRODUCTS)
    orders = spark.createDataFrame([("1", "France", False, 2010, 1, 1), ("2", "France", False, 2010, 1, 2)], ORDERS)
    lines = spark.createDataFrame([("1", "a", 1), ("2", "a", 10)], LINES)
    store = incremental.DailySums(spark, scratch_path(spark, "sums"))
    assert store.marts(products)["sales_per_country"].collect() == []
    store.deliver(lines, orders)
    stopped = marts.daily_sums(lines, orders).drop("batch")
    stopped.write.parquet(f"{store.path}/sums/batch=2")  # its list of days was never written
    assert store.marts(products)["sales_per_country"].first().total_sales == 11.0
    store.deliver(lines.limit(0), orders.limit(0), [(2010, 1, 1)])
    assert [tuple(r) for r in store.marts(products)["sales_by_period"].collect()] == [(2010, 1, 2, 10.0, 1, 10)]


def test_marts_meet_the_sums_once(spark):
    products = spark.createDataFrame([("a", "one", 1.5), ("b", "two", 2.0)], PRODUCTS)
    orders = spark.createDataFrame([("1", "France", False, 2010, 1, 1), ("2", "Spain", True, 2010, 1, 2)], ORDERS)
    lines = spark.createDataFrame([("1", "a", 2), ("1", "b", -1), ("2", "b", 4)], LINES)
    store = incremental.DailySums(spark, scratch_path(spark, "sums"))
    store.deliver(lines, orders)
    built = store.marts(products)
    for name, df in built.items():
        files = df.inputFiles()
        assert files and not any(f"{store.path}/" in f for f in files), name
    assert collected(built) == collected(gold.build_marts(lines, orders, products, strategy="recompute"))


def test_a_delivery_reads_the_changed_days_only(spark):
    rng = random.Random(2)
    orders, _ = delivery(rng, [(2010, m, d) for m in (1, 2) for d in range(1, 5)], 0)
    path = scratch_path(spark, "orders")
    write_parquet(spark.createDataFrame(orders, ORDERS), path, partition_by=DATE_PARTS)
    part = incremental.of_days(spark.read.parquet(path), [(2010, 1, 2), (2010, 2, 3)])
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    read = {f.split("/year=")[1].rsplit("/", 1)[0] for (f,) in part.select(F.input_file_name()).distinct().collect()}
    assert read <= {"2010/month=1/day=2", "2010/month=2/day=3"}
    assert incremental.of_days(spark.read.parquet(path), []).count() == 0


def test_product_counts_follow_extracts_in_and_out(spark):
    rng = random.Random(3)
    extracts = {
        n: [(f" {rng.choice('abce')} ", rng.choice(["x", "y ", None]), rng.choice([1.0, 2.5, 4.25, None])) for _ in range(30)] for n in "PQR"
    }
    store = incremental.ProductCounts(spark, scratch_path(spark, "counts"))
    inside = []

    def expected():
        found = {}
        for code, text, price in {r for n in inside for r in extracts[n]}:
            if text is not None and price is not None:
                found.setdefault(code.strip(), []).append((text.strip(), price))
        return {c: (min(t for t, _ in v), sum(p for _, p in v) / len(v)) for c, v in found.items()}

    for step in ("+P", "+Q", "-P", "+R", "+P", "-Q", "-R", "-P"):
        if step[0] == "+":
            store.add(step[1], spark.createDataFrame(extracts[step[1]], PRODUCTS))
            inside.append(step[1])
        else:
            store.withdraw(step[1])
            inside.remove(step[1])
        got = {r.StockCode: (r.Description, r.UnitPrice) for r in store.master().collect()}
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected().items()}, step
        assert {k: v[1] for k, v in got.items()} == pytest.approx({k: v[1] for k, v in expected().items()})
    with pytest.raises(ValueError):
        store.withdraw("P")
    store.add("P", spark.createDataFrame(extracts["P"], PRODUCTS))
    with pytest.raises(ValueError):
        store.add("P", spark.createDataFrame(extracts["P"], PRODUCTS))


def test_exact_mean_price_is_rounded_half_up_once(spark):
    prices = {"a": [1.0, 1.0, 1.0001], "b": [0.1, 0.2], "c": [2.00005], "d": [1.0, 2.0, 2.0], "e": [0.0001, 0.0002]}
    rows = [(c, "d", p) for c, ps in prices.items() for p in ps]
    got = {r.StockCode: r.UnitPrice for r in cleaning.exact_product_master(spark.createDataFrame(rows, PRODUCTS)).collect()}
    for code, ps in prices.items():
        cents = [Decimal(repr(p)).quantize(Decimal("0.0001"), ROUND_HALF_UP) for p in ps]
        assert got[code] == (sum(cents) / len(cents)).quantize(Decimal("0.000001"), ROUND_HALF_UP), code


def test_exact_marts_do_not_depend_on_partitions(spark):
    rng = random.Random(5)
    orders, lines = delivery(rng, [(2011, 1, d) for d in (1, 2)], 0)
    rows = [(c, f"item {c}", rng.choice([0.1, 0.7, 1.3, 2.9])) for c in "abc" for _ in range(7)]
    runs = []
    for n in (1, 2, 5):
        products = cleaning.exact_product_master(spark.createDataFrame(rows, PRODUCTS).repartition(n))
        frames = [spark.createDataFrame(x, k).repartition(n) for x, k in ((lines, LINES), (orders, ORDERS))]
        runs.append(collected(gold.build_marts(*frames, products)))
    assert runs[0] == runs[1] == runs[2]
    assert all(isinstance(r[1], Decimal) for r in runs[0]["sales_per_country"])


def test_daily_sums_shuffle_no_expanded_lines(spark):
    orders = spark.createDataFrame([("1", "France", False, 2010, 1, 1)], ORDERS)
    lines = spark.createDataFrame([("1", "a", 1)], LINES)
    products = spark.createDataFrame([("a", "one", 1.0)], PRODUCTS)
    plan = marts.mart_measures(lines, orders, products)._jdf.queryExecution().executedPlan().toString()
    first_sums = plan.index("sold_quantity")
    assert plan.count("Expand") == 1 and plan.index("Expand") < plan.rindex("SortMergeJoin" if "SortMergeJoin" in plan else "Join")
    assert first_sums > 0


@pytest.mark.parametrize("name", ["incremental_marts", "incremental_product_master", "exact_marts", "measured_top_products"])
def test_registered_queries(spark, sf_small, name):
    import __spark_entry__ as entry

    assert compare_frame(entry.queries()[name](spark, sf_small), entry.oracle_sql()[name], duckdb_connection(sf_small)) == "ok"
