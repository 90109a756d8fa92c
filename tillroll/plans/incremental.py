"""Marts and product master kept up to date by deliveries.

Both stores only ever add folders. A delivery writes its rows under its own
batch number and then a small list that makes them count; a run that stops in
between leaves a folder without a list, which readers ignore and the next run
writes again. No stored file is changed, so readers never see half a delivery.

* ``DailySums`` - the sums of ``marts.daily_sums``, of which a delivery
  replaces whole days: a day's rows are those of the last batch that lists it.
  The marts follow from the current rows, so a correction of two days costs
  those two days' lines, not a rebuild.
* ``ProductCounts`` - how often each (code, description, price) came in the
  extracts received and not withdrawn. Withdrawing an extract subtracts what it
  brought; mean price and description follow from the rows that are left.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import cleaning, marts, validation
from tillroll.schemas import DATE_PARTS
from tillroll.session import delete_path, materialize, path_exists
from tillroll.sources.extracts import PRODUCT_COLUMNS

Day = tuple[int, int, int]

DAYS_SCHEMA = T.StructType([T.StructField(c, T.IntegerType()) for c in DATE_PARTS] + [T.StructField("batch", T.LongType())])
SUMS_SCHEMA = T.StructType(
    [T.StructField("Country", T.StringType())]
    + [T.StructField(c, T.IntegerType()) for c in DATE_PARTS]
    + [T.StructField("StockCode", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("sold_lines", "sold_quantity", "returned_lines", "returned_quantity")]
    + [T.StructField("batch", T.LongType())]
)
COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("n", T.LongType()),
        T.StructField("batch", T.LongType()),
    ]
)
DELIVERIES_SCHEMA = T.StructType(
    [T.StructField("extract", T.StringType()), T.StructField("sign", T.IntegerType()), T.StructField("batch", T.LongType())]
)


def of_days(df: DataFrame, days: Sequence[Day]) -> DataFrame:
    """Rows of some days, by plain comparisons of the date parts, so that a
    table in day folders is read in those folders only."""
    if not days:
        return df.filter(F.lit(False))
    same = [(F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d) for y, m, d in days]
    return df.filter(functools.reduce(lambda a, b: a | b, same))


@dataclass(frozen=True)
class _BatchedStore:
    spark: SparkSession
    path: str

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        where = f"{self.path}/{part}"
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(where)

    def _write(self, df: DataFrame, part: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch}")

    def _next(self, listed: DataFrame) -> int:
        return (listed.agg(F.max("batch")).first()[0] or 0) + 1


class DailySums(_BatchedStore):
    """Stored sums by day; ``sums/batch=N`` has the rows, ``days/batch=N`` the days it replaces."""

    def days(self) -> DataFrame:
        """The batch that counts for each day (one row a day)."""
        return self._read("days", DAYS_SCHEMA).groupBy(*DATE_PARTS).agg(F.max("batch").alias("batch"))

    def deliver(self, lines: DataFrame, orders: DataFrame, days: Sequence[Day] = ()) -> int:
        """Replace whole days by a delivery: cleaned orders and all lines of
        these orders. Its days are those of its orders and ``days``, which also
        names days that have no order left. Returns the batch number.

        An order that moves to another day changes two days; both must be
        delivered.
        """
        batch = self._next(self._read("days", DAYS_SCHEMA))
        self._write(marts.daily_sums(lines, orders).select([f.name for f in SUMS_SCHEMA.fields[:-1]]), "sums", batch)
        named = self.spark.createDataFrame(list(days), T.StructType(DAYS_SCHEMA.fields[:-1]))
        self._write(orders.select(*DATE_PARTS).unionByName(named).distinct(), "days", batch)
        return batch

    def sums(self) -> DataFrame:
        """The rows that count: one per country, day and stock code."""
        rows = self._read("sums", SUMS_SCHEMA)
        return rows.join(self.days(), [*DATE_PARTS, "batch"]).drop("batch")

    def marts(self, products: DataFrame) -> dict[str, DataFrame]:
        """The four marts, cut from one stored copy of their measures (a row per
        country, product and day): the sums meet the products once, not once a mart."""
        return marts.marts_from_measures(materialize(marts.measures_from_sums(self.sums(), products), "mart-measures"))

    def compact(self) -> int:
        """Write what counts as one batch and delete the others. Readers that
        started earlier may still read these, so run it between jobs."""
        listed = self._read("days", DAYS_SCHEMA)
        old = [r[0] for r in listed.select("batch").distinct().collect()]  # one row a delivery
        batch = self._next(listed)
        self._write(self.sums(), "sums", batch)
        self._write(self.days().drop("batch"), "days", batch)
        for number in old:
            delete_path(self.spark, f"{self.path}/days/batch={number}")
            delete_path(self.spark, f"{self.path}/sums/batch={number}")
        return batch


class ProductCounts(_BatchedStore):
    """Stored multiset of product rows; ``rows/batch=N`` has counts, which
    ``deliveries/batch=N`` adds or subtracts under the extract's name."""

    def _deliveries(self) -> DataFrame:
        return self._read("deliveries", DELIVERIES_SCHEMA)

    def _standing(self) -> dict[str, int]:
        """Batch of each extract that is in (one entry a delivery)."""
        found: dict[str, int] = {}
        for extract, sign, batch in sorted(self._deliveries().collect(), key=lambda r: r["batch"]):
            if sign > 0:
                found[extract] = batch
            else:
                found.pop(extract, None)
        return found

    def _commit(self, rows: DataFrame, extract: str, sign: int) -> int:
        batch = self._next(self._deliveries())
        self._write(rows, "rows", batch)
        self._write(self.spark.createDataFrame([(extract, sign)], T.StructType(DELIVERIES_SCHEMA.fields[:-1])), "deliveries", batch)
        return batch

    def add(self, extract: str, rows: DataFrame) -> int:
        """Add an extract's rows (every line, or distinct ones: a row counts as
        long as it came more often than it was withdrawn). An extract that is
        already in is refused; withdraw it first."""
        if extract in self._standing():
            raise ValueError(f"extract {extract!r} is already in")
        counted = rows.select(*[F.col(c).cast(COUNTS_SCHEMA[c].dataType) for c in PRODUCT_COLUMNS]).groupBy(*PRODUCT_COLUMNS)
        return self._commit(counted.agg(F.count(F.lit(1)).alias("n")), extract, 1)

    def withdraw(self, extract: str) -> int:
        """Subtract what an extract brought; only that extract's rows are read."""
        batch = self._standing().get(extract)
        if batch is None:
            raise ValueError(f"extract {extract!r} is not in")
        rows = self._read("rows", COUNTS_SCHEMA).filter(F.col("batch") == batch)
        return self._commit(rows.select(*PRODUCT_COLUMNS, (-F.col("n")).alias("n")), extract, -1)

    def rows(self) -> DataFrame:
        """The distinct product rows of the extracts that are in. Counts are
        added map-side, so a code that comes very often costs a row a task."""
        listed = self._deliveries().select("batch")
        counts = self._read("rows", COUNTS_SCHEMA).join(listed, "batch", "left_semi")
        return counts.groupBy(*PRODUCT_COLUMNS).agg(F.sum("n").alias("n")).filter("n > 0").drop("n")

    def master(self, exact: bool = False) -> DataFrame:
        """The product master of the rows that are in."""
        valid, _ = validation.validate_and_split(cleaning.trim_products(self.rows()), validation.product_rules())
        return cleaning.exact_product_master(valid) if exact else cleaning.product_master(valid)
