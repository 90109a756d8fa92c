"""The three layers as lazy frames over the three bronze datasets.

``RetailLayers`` wires the operators together without running anything:
each attribute is a DataFrame whose plan starts at the bronze inputs, so a
caller that asks for one mart gets one optimised plan (pruned scans, pushed
filters) and a caller that writes everything uses the jobs in
``tillroll.plans.silver`` / ``tillroll.plans.gold``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tillroll.functions.dates import date_parts
from tillroll.operators import cleaning, marts, validation
from tillroll.session import run_actions


@dataclass
class RetailLayers:
    products_raw: DataFrame
    orders_raw: DataFrame
    lines_raw: DataFrame
    orders_have_date_parts: bool = False
    keep_raw_dates: bool = False

    # ---- bronze ---------------------------------------------------------
    @cached_property
    def orders_bronze(self) -> DataFrame:
        return self.orders_raw if self.orders_have_date_parts else date_parts(self.orders_raw)

    # ---- silver: products -----------------------------------------------
    @cached_property
    def products_trimmed(self) -> DataFrame:
        return cleaning.trim_products(self.products_raw)

    @cached_property
    def _products_split(self) -> tuple[DataFrame, DataFrame]:
        return validation.validate_and_split(self.products_trimmed, validation.product_rules())

    @property
    def products_valid(self) -> DataFrame:
        return self._products_split[0]

    @property
    def products_invalid(self) -> DataFrame:
        return self._products_split[1]

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.product_master(self.products_valid)

    @cached_property
    def exact_products(self) -> DataFrame:
        return cleaning.exact_product_master(self.products_valid)

    # ---- silver: orders -------------------------------------------------
    @cached_property
    def orders_parsed(self) -> DataFrame:
        return cleaning.parse_order_dates(self.orders_bronze, keep_raw=self.keep_raw_dates)

    @cached_property
    def _orders_split(self) -> tuple[DataFrame, DataFrame]:
        return validation.validate_and_split(self.orders_parsed, validation.order_rules())

    @property
    def orders_accepted(self) -> DataFrame:
        return self._orders_split[0]

    @property
    def orders_invalid(self) -> DataFrame:
        return self._orders_split[1]

    @cached_property
    def orders(self) -> DataFrame:
        return cleaning.clean_orders(self.orders_accepted)

    # ---- silver: lines --------------------------------------------------
    @cached_property
    def _lines_split(self) -> tuple[DataFrame, DataFrame]:
        return validation.validate_and_split(self.lines_raw, validation.line_rules())

    @property
    def lines(self) -> DataFrame:
        return self._lines_split[0]

    @property
    def lines_invalid(self) -> DataFrame:
        return self._lines_split[1]

    def validation_counts(self) -> DataFrame:
        return validation.split_counts(
            {
                "products": (self.products_trimmed, validation.product_rules()),
                "orders": (self.orders_parsed, validation.order_rules()),
                "orders_line": (self.lines_raw, validation.line_rules()),
            }
        )

    def written(self, path: str) -> tuple[RetailLayers, dict[str, validation.SplitWrite]]:
        """The same layers over both sides of all three splits as written under
        ``path``, and the counts of those writes. Each dataset is read once."""
        jobs = {
            "products": (self.products_trimmed, validation.product_rules()),
            "orders": (self.orders_parsed, validation.order_rules()),
            "orders_line": (self.lines_raw, validation.line_rules()),
        }
        done = run_actions(
            [lambda n=n, df=df, rules=rules: validation.write_split(df, rules, f"{path}/{n}", n) for n, (df, rules) in jobs.items()]
        )
        splits = dict(zip(jobs, done))
        layers = RetailLayers(self.products_raw, self.orders_raw, self.lines_raw, self.orders_have_date_parts, self.keep_raw_dates)
        layers._products_split = (splits["products"].valid, splits["products"].invalid)
        layers._orders_split = (splits["orders"].valid, splits["orders"].invalid)
        layers._lines_split = (splits["orders_line"].valid, splits["orders_line"].invalid)
        return layers, splits

    # ---- gold -----------------------------------------------------------
    @cached_property
    def sales(self) -> DataFrame:
        return marts.sales_lines(self.lines, self.orders, self.products)

    def mart(self, name: str, sales: DataFrame | None = None) -> DataFrame:
        return marts.MART_BUILDERS[name](self.sales if sales is None else sales)
